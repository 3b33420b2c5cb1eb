"""Property tests (hypothesis) for the operators' contracts."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.functions.measures import clean_measure
from statlake.operators.dims import conform_dim
from statlake.operators.keys import keep_first

codes = st.sampled_from(["AFG", "BEL", "XKX", "ZZZ", None])
names = st.sampled_from(["a", "b", "Zed", "", None])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(codes, names), max_size=12), st.lists(st.tuples(codes, names, names, names), max_size=12))
def test_conform_dim_every_code_once(spark, primary, secondary):
    p = spark.createDataFrame(primary, "country_code string, country_name string")
    s = spark.createDataFrame(secondary, "country_code string, country string, region string, subregion string")
    out = conform_dim(p, s).collect()
    got = [r.country_code for r in out]
    expected = {c for c, n in primary if c is not None and n is not None} | {c for c, *_ in secondary if c is not None}
    assert sorted(got) == sorted(expected)  # every non-NULL code exactly once


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.none() | st.text(max_size=3), st.integers(-5, 5)), max_size=25))
def test_keep_first_one_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, name string, x int")
    out = keep_first(df, ["k"], ["name"]).collect()
    keys = [r.k for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})
    for r in out:
        group = [t for t in rows if t[0] == r.k]
        assert r.name == min((t[1] for t in group if t[1] is not None), default=None)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789.-+eENA x", max_size=8)), max_size=25))
def test_clean_measure_never_nan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    for r in clean_measure(df).collect():
        assert r.value is None or not math.isnan(r.value)
