"""Every queries() key against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from statlake.plans.oracle import ORACLE
from statlake.plans.queries import QUERIES

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["country", "value", "indicator", "frequency", "period"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_module.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    idx = [rel.columns.index(c) for c in cols]
    drows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows
