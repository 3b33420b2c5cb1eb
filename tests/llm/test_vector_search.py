import math

import duckdb
import numpy as np
import pytest

from statlake.llm.queries import op13_vector_search
from statlake.llm.vector_search import ORACLE, exact_top_k, segment_stats

from ..conftest import SF_CHECK


def brute(rows, every, k):
    whole = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, seen = [], set()
    for n, (i, v) in enumerate(whole):
        if i is None or i % every or (i, tuple(v)) in seen:
            continue
        seen.add((i, tuple(v)))
        others = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for m, (j, w) in enumerate(whole) if m != n and len(w) == len(v)]
        others.sort(key=lambda t: (t[0], t[1], t[2] or 0))
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(others[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_CHECK}/embeddings.parquet')")
    got = op13_vector_search(spark, SF_CHECK)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == sorted(con.sql(ORACLE).fetchall(), key=repr)


def test_many_tiles_ties_and_copies(spark, monkeypatch):
    """Several tiles, a third of all rows one vector, near copies of it, clusters, equal scores."""
    import statlake.llm.vector_search as m

    monkeypatch.setattr(m, "MIN_TILE_ROWS", 64)
    rng = np.random.default_rng(5)
    hot = rng.normal(size=10)
    rows = []
    for i in range(1500):
        x = hot if i % 3 == 0 else hot + rng.normal(size=10) * 0.01 if i % 7 == 0 else rng.normal(size=10) * rng.choice([0.1, 1, 3])
        rows.append((i, [float(c) for c in x]))
    got = rows_of(exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=5))
    assert got == brute(rows, 20, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.001]), (0, [0.5, -0.25, 0.001]), (0, [1.0, 1.0, 1.0]), (50, [0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0]),
        (None, [9.0, 9.0, 9.0]), (1, None), (2, [1.0, None, 2.0]), (3, [nan, 1.0, 1.0]), (4, [inf, 1.0, 1.0]), (100, []), (101, []),
        (150, [1.0]), (151, [-2.0]), (-50, [1.0, 2.0, 3.0]), (7, [-1.0, -1.0, 0.0]), (8, [-0.001, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<double>, score string, own int")
    for k in (1, 3, 5):
        assert rows_of(exact_top_k(df, every=50, k=k)) == brute(rows, 50, k)
    assert exact_top_k(df.limit(0)).collect() == []
    assert exact_top_k(df.filter("vec_id = 7")).collect() == []
    assert exact_top_k(df.filter("vec_id = 50")).collect() == []  # a query without another row


def test_too_large_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\^31"):
        exact_top_k(df).collect()


def test_bounds_hold():
    """A distance of statistics is never above the distance of the vectors, at any level and length."""
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 64, 100):
        a, b = rng.integers(-300, 300, (2, 50, d)).astype(float)
        true = np.square(a - b).sum(axis=1)
        last = np.zeros(50)
        for parts in (1, 4, 16, 64):
            lower = np.square(segment_stats(a, parts) - segment_stats(b, parts)).sum(axis=1)
            assert (lower <= true + 1e-6).all()
            last = lower
        assert d > 64 or np.allclose(last, true)  # one component each: exact
