import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statlake.layout import STATS_YEARS, year_headers
from statlake.operators.dims import conform_dim, extract_dim
from statlake.operators.joins import denormalize, join_dim
from statlake.operators.keys import (
    anti_members, count_by, duplicate_keys, keep_first, key_except, key_intersect, key_union, row_count, semi_members,
    sort_desc,
)
from statlake.operators.shape import (
    align_union, common_columns, normalize_period, unpivot_entities, unpivot_matching, with_literals,
)


def test_unpivot_entities_keeps_nulls_and_odd_names(spark):
    df = spark.createDataFrame(
        [("1987M01", 1.0, None, 3.0)], "Year string, `St. Lucia` double, `Cote d'Ivoire` double, `Korea, Rep.` double"
    )
    rows = unpivot_entities(df, "Year", "country", "value").collect()
    assert [(r.country, r.value) for r in rows] == [("St. Lucia", 1.0), ("Cote d'Ivoire", None), ("Korea, Rep.", 3.0)]


def test_unpivot_entities_text_cells_become_null(spark):
    df = spark.createDataFrame([("1990", "1.5", "n/a")], "Year string, A string, B string")
    rows = unpivot_entities(df, "Year").collect()
    assert [(r.country, r.value) for r in rows] == [("A", 1.5), ("B", None)]


def test_unpivot_prefixed(spark):
    df = spark.createDataFrame([("x", "1", "2", "m")], "name string, yr1999 string, YR2000 string, note string")
    out = unpivot_matching(df, r"yr\d{4}", strip_prefix=2)
    assert out.columns == ["name", "note", "year", "value"]
    assert [(r.year, r.value) for r in out.collect()] == [("1999", "1"), ("2000", "2")]


def test_unpivot_plain_years(spark):
    df = spark.createDataFrame([("c", "x", "1", "2", "3", "e")], "`Country Code` string, extra string, `1959` string, `1960` string, `2029` string, `2030` string")
    out = unpivot_matching(df, year_headers(*STATS_YEARS), ids=["Country Code"], full_match=True)
    assert out.columns == ["Country Code", "year", "value"]
    assert [(r.year, r.value) for r in out.collect()] == [("1960", "2"), ("2029", "3")]


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 6), st.integers(1, 5))
def test_unpivot_row_count_property(spark, n_rows, n_cols):
    cols = [f"c{i}" for i in range(n_cols)]
    data = [(f"r{r}", *[float(r * c) if (r + c) % 3 else None for c in range(n_cols)]) for r in range(n_rows)]
    df = spark.createDataFrame(data, ", ".join(["Year string"] + [f"{c} double" for c in cols]))
    long = unpivot_entities(df, "Year")
    assert long.count() == n_rows * n_cols
    back = long.groupBy("Year").pivot("country", cols).agg(F.first("value"))
    assert sorted(map(tuple, back.select("Year", *cols).collect())) == sorted(data)


def test_common_columns_and_union(spark):
    a = spark.createDataFrame([(1, "a", 0.5)], "k int, name string, x double")
    b = spark.createDataFrame([("b", 2)], "name string, k int")
    assert common_columns(a, b) == ["k", "name"]
    assert [tuple(r) for r in align_union([a, b], common=True).collect()] == [(1, "a"), (2, "b")]
    got = align_union([a, b], allow_missing=True).collect()
    assert [tuple(r) for r in got] == [(1, "a", 0.5), (2, "b", None)]


def test_literals_and_normalize(spark):
    df = spark.createDataFrame([("1987Q2", "X", 1.0)], "year string, country string, value double")
    df = with_literals(df, {"indicator": "gdp"}).withColumn("insert_timestamp", F.current_timestamp())
    out = normalize_period(df, "quarterly")
    assert out.columns == ["country", "value", "indicator", "frequency", "period"]
    r = out.first()
    assert (r.frequency, str(r.period)) == ("quarterly", "1987-04-01")


def test_keep_first_deterministic(spark):
    df = spark.createDataFrame([("A", "b", 1), ("A", "a", 2), ("A", "a", 1), ("B", None, 5), (None, "z", 0)], "k string, name string, x int")
    got = sorted((r.k or "", r.name, r.x) for r in keep_first(df, ["k"], ["name"]).collect())
    assert got == [("", "z", 0), ("A", "a", 1), ("B", None, 5)]


def test_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(map(tuple, count_by(df, "k").collect())) == [(1, 2), (2, 1)]
    assert [tuple(r) for r in duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert row_count(df).first().n == 3


def test_membership_null_handling(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "code int, v string")
    other = spark.createDataFrame([(1,), (None,)], "code int")
    assert [r.v for r in semi_members(df, other, "code").collect()] == ["a"]
    assert [r.v for r in anti_members(df, other, "code").collect()] == ["b"]


def test_key_sets_null_safe(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "key int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "key int")
    keys = lambda d: sorted((r.key if r.key is not None else -1) for r in d.collect())
    assert keys(key_union(a, b)) == [-1, 1, 2, 3]
    assert keys(key_intersect(a, b)) == [-1, 2]
    assert keys(key_except(a, b)) == [1]


def test_join_dim_and_denormalize(spark):
    fact = spark.createDataFrame([("AFG", "I1", 2000, 1.0), ("XXX", "I1", 2000, 2.0)], "country_code string, indicator_code string, year int, value float")
    dc = spark.createDataFrame([("AFG", "Afghanistan")], "country_code string, country_name string")
    di = spark.createDataFrame([("I1", "Indicator one")], "indicator_code string, indicator_name string")
    inner = join_dim(fact, dc, "country_code", columns={"country_name": "country_name"})
    assert inner.count() == 1
    left = join_dim(fact, dc, "country_code", columns={"country_name": "country_name"}, how="left")
    assert sorted((r.country_code, r.country_name) for r in left.collect()) == [("AFG", "Afghanistan"), ("XXX", None)]
    out = denormalize(fact, [(dc, "country_code", "country_code", {"country_name": "country_name"}),
                             (di, "indicator_code", "indicator_code", {"indicator_name": "indicator_name"})])
    assert out.columns == ["year", "value", "country_name", "indicator_name"]
    assert [tuple(r) for r in out.collect()] == [(2000, 1.0, "Afghanistan", "Indicator one")]


def test_extract_dim(spark):
    df = spark.createDataFrame([("I1", "b"), ("I1", "a"), ("I2", "c"), ("I1", "a")], "code string, name string")
    assert extract_dim(df, "code", ["name"]).count() == 3
    assert sorted(map(tuple, extract_dim(df, "code", ["name"], one_per_key=True).collect())) == [("I1", "a"), ("I2", "c")]


def test_conform_dim(spark):
    wb = spark.createDataFrame(
        [("AFG", "Afghanistan"), ("AFG", "Afghanistan, IS"), ("ALB", None), ("BEL", "Belgium")],
        "country_code string, country_name string",
    )
    un = spark.createDataFrame(
        [("AFG", "Afgh.", "Asia", "South"), ("XKX", "Kosovo", "Europe", "South"), ("XKX", "Kosovo", "Europe", "East"),
         (None, "Nowhere", "X", "Y")],
        "country_code string, country string, region string, subregion string",
    )
    got = sorted(map(tuple, conform_dim(wb, un).collect()))
    assert got == [
        ("AFG", "Afghanistan", "Asia", "South"),
        ("BEL", "Belgium", None, None),
        ("XKX", "Kosovo", "Europe", "East"),
    ]


def test_sort_desc_splits_a_hot_value(spark):
    rows = [(7, i) for i in range(3000)] + [(i, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "price int, id int").repartition(4)
    out = sort_desc(df, "price")
    got = [tuple(r) for r in out.collect()]
    assert got == sorted(rows, key=lambda t: (-t[0], t[1]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sort_desc(df, "price").rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 3000  # the 3000 rows of price 7 are not all in one task


def test_unpivot_labels_that_collide(spark):
    # two headers whose labels collide once the prefix is stripped
    df = spark.createDataFrame([("x", "1", "2")], "name string, yr1999 string, zz1999 string")
    out = unpivot_matching(df, r"[a-z]{2}\d{4}", strip_prefix=2)
    assert out.columns == ["name", "year", "value"]
    assert [(r.year, r.value) for r in out.collect()] == [("1999", "1"), ("1999", "2")]


def test_null_names_never_win(spark):
    df = spark.createDataFrame([("A", None), ("A", "Pop"), ("B", None), ("B", None)], "code string, name string")
    got = dict(map(tuple, extract_dim(df, "code", ["name"], one_per_key=True).collect()))
    assert got == {"A": "Pop", "B": None}
    primary = spark.createDataFrame([("AFG", "Afghanistan"), ("BEL", None)], "country_code string, country_name string")
    secondary = spark.createDataFrame(
        [("XKX", None, None, None), ("XKX", "Kosovo", "Europe", "South"), ("AFG", None, None, None)],
        "country_code string, country string, region string, subregion string",
    )
    out = sorted(map(tuple, conform_dim(primary, secondary).collect()))
    # a code whose only name is NULL, and which the secondary lacks, has no row
    assert out == [("AFG", "Afghanistan", None, None), ("XKX", "Kosovo", "Europe", "South")]


def test_year_headers_are_an_inclusive_range(spark):
    df = spark.createDataFrame([("c", "1", "2", "3")], "id string, `1999` string, `2000` string, `2001` string")
    out = unpivot_matching(df, year_headers(2000, 2000), ids=["id"], full_match=True)
    assert [(r.year, r.value) for r in out.collect()] == [("2000", "2")]


def test_wide_checks_hold_every_row(spark):
    """The cells of the derived wide tables count all rows of their table."""
    from statlake.plans.queries import q_unpivot_entities, q_unpivot_years_plain, q_unpivot_years_prefixed, table

    from .conftest import SF_SMALL

    total = lambda df: df.agg(F.sum("value")).first()[0]
    assert total(q_unpivot_years_prefixed(spark, SF_SMALL)) == table(spark, SF_SMALL, "orders").count()
    assert total(q_unpivot_years_plain(spark, SF_SMALL)) == table(spark, SF_SMALL, "lineitem").count()
    value = table(spark, SF_SMALL, "orders").agg(F.sum("o_totalprice")).first()[0]
    assert abs(total(q_unpivot_entities(spark, SF_SMALL)) - value) < 1e-6 * value


def test_unpivot_cells(spark):
    """Headers that differ per row set, NULL cells, odd names; one narrow stage without a shuffle."""
    from statlake.operators.shape import as_cells, unpivot_cells

    a = spark.createDataFrame([("x", "1", None, "n"), ("y", None, "4", "n")], "id string, YR1999 string, yr2000 string, `No. of 'rows'` string")
    b = spark.createDataFrame([("z", 5, 6)], "id string, `2001` int, `12001` int")
    rows = as_cells(a, ["id"]).unionByName(as_cells(b, ["id"]))
    assert rows.columns == ["id", "cells"]
    assert rows.filter("id = 'x'").first().cells == {"YR1999": "1", "No. of 'rows'": "n"}
    long = unpivot_cells(rows, r"(?:yr)?\d{4}", strip_prefix=0)
    assert sorted(map(tuple, long.collect())) == [("x", "YR1999", "1"), ("y", "yr2000", "4"), ("z", "2001", "5")]
    assert "Exchange" not in long._jdf.queryExecution().toString()
    only = unpivot_cells(rows, r"YR\d{4}", strip_prefix=2, ignore_case=False)
    assert [tuple(r) for r in only.collect()] == [("x", "1999", "1")]
    assert as_cells(a.select("id"), ["id"]).first().cells == {}
    assert unpivot_cells(as_cells(a.select("id"), ["id"]), ".*").collect() == []


def test_survivorship(spark):
    """Any number of lists, missing columns, NULL codes, ties; one shuffle."""
    from statlake.operators.dims import survivorship

    one = spark.createDataFrame([("A", "a1"), ("A", "a0"), ("B", None), (None, "x")], "code string, name string")
    two = spark.createDataFrame([("A", "zz", "r2"), ("B", "b", None), ("C", None, None)], "iso string, label string, region string")
    three = spark.createDataFrame([("B", "late", "r3"), ("D", "d", "r4")], "code string, name string, region string")
    lists = [("one", one, {}), ("two", two, {"code": "iso", "name": "label"}), ("three", three, {})]
    out = survivorship(lists, "code", ["name", "region"])
    assert out.columns == ["code", "name", "name_source", "region", "region_source"]
    assert sorted(map(tuple, out.collect())) == [
        ("A", "a0", "one", "r2", "two"), ("B", "b", "two", "r3", "three"), ("C", None, None, None, None), ("D", "d", "three", "r4", "three"),
    ]
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    plain = survivorship(lists[::-1], "code", ["name"], provenance=False)
    assert {r.code: r.name for r in plain.collect()} == {"A": "zz", "B": "late", "C": None, "D": "d"}
    for wrong in ([], [("two", two, {})]):
        with pytest.raises(ValueError):
            survivorship(wrong, "code", ["name"])
