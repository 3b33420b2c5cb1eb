import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.functions.measures import cast_by_name, clean_measure, drop_incomplete, is_numeric_text, recode
from statlake.functions.names import sanitize_columns, sanitize_name, sanitized_names
from statlake.functions.periods import parse_period


def test_sanitize_name_rule():
    assert sanitize_name("Country Name") == "country_name"
    assert sanitize_name("PPP (survey), year;\t=x\n") == "ppp_survey_yearx"
    assert sanitize_name("a{b}") == "ab"


def test_sanitize_collisions_and_idempotence(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Part Key", "part_key", "PART KEY"])
    out = sanitize_columns(df)
    assert out.columns == ["part_key", "part_key_2", "part_key_3"]
    assert sanitize_columns(out).columns == out.columns


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aA b,;()\t=_{}1", min_size=1, max_size=8), min_size=1, max_size=8))
def test_sanitize_property(names):
    out = sanitized_names(names)
    assert len(out) == len(set(out)) == len(names)  # collision-free
    assert sanitized_names(out) == out  # idempotent
    for n in names:
        assert sanitize_name(sanitize_name(n)) == sanitize_name(n)


def _periods(spark, labels, freq):
    df = spark.createDataFrame([(x,) for x in labels], "t string")
    return [r[0] for r in df.select(parse_period("t", freq)).collect()]


def test_monthly(spark):
    got = _periods(spark, ["1987M01", "1987M1", "1987M12", "2000M13", "2000M0", "2000M", "x", None, "M05"], "monthly")
    assert got == [dt.date(1987, 1, 1), dt.date(1987, 1, 1), dt.date(1987, 12, 1)] + [None] * 6


def test_quarterly(spark):
    got = _periods(spark, ["1987Q1", "1987Q2", "1987Q3", "1987Q4", "1987Q5", "1987", None], "quarterly")
    assert got == [dt.date(1987, 1, 1), dt.date(1987, 4, 1), dt.date(1987, 7, 1), dt.date(1987, 10, 1), None, None, None]


def test_annual(spark):
    got = _periods(spark, ["1987", "1987.0", "1987.9", " 1990 ", "abc", "", None, "87", "12.0", "5", "0", "999", "10000"], "annual")
    assert got == [dt.date(1987, 1, 1)] * 3 + [dt.date(1990, 1, 1)] + [None] * 9


def test_annual_numeric_input(spark):
    df = spark.createDataFrame([(1987.0,), (None,)], "y double")
    assert [r[0] for r in df.select(parse_period("y", "annual")).collect()] == [dt.date(1987, 1, 1), None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=10), min_size=1, max_size=20))
def test_parse_period_never_throws(spark, labels):
    df = spark.createDataFrame([(x,) for x in labels], "t string")
    df.select(*[parse_period("t", f).alias(f) for f in ("annual", "quarterly", "monthly")]).collect()


def test_clean_measure(spark):
    raw = ["1", "1.", ".5", "-3e2", "+1", "abc", "NA", None, "-999.999", "", "1,5"]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, value string")
    got = {r.id: r.value for r in clean_measure(df).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.5, 3: -300.0, 6: None, 8: -999.999}


def test_numeric_gate(spark):
    df = spark.createDataFrame([("12",), ("1e5",), ("e5",), (None,)], "t string")
    assert [r[0] for r in df.select(is_numeric_text("t")).collect()] == [True, True, False, None]


def test_recode(spark):
    df = spark.createDataFrame([("_T", "_T", "_t"), ("F", None, "_T")], "sex string, urb string, age string")
    got = [tuple(r) for r in recode(df, ["sex", "urb", "age"]).collect()]
    assert got == [("T", "T", "_t"), ("F", None, "T")]


def test_cast_by_name(spark):
    df = spark.createDataFrame([("1.5", "1999", 7, "x"), ("n/a", "1999.0", 8, None)], "value string, year string, k int, s string")
    out = cast_by_name(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["float", "int", "string", "string"]
    assert [tuple(r) for r in out.collect()] == [(1.5, 1999, "7", "x"), (None, None, "8", None)]


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "a int, b string")
    assert drop_incomplete(df).count() == 1
    assert drop_incomplete(df, ["a"]).count() == 2


def test_numeric_labels_at_every_frequency(spark):
    df = spark.createDataFrame([(1987.0,), (None,)], "y double")
    got = df.select(*[parse_period("y", f).alias(f) for f in ("annual", "quarterly", "monthly")]).collect()
    assert [tuple(r) for r in got] == [(dt.date(1987, 1, 1), None, None), (None, None, None)]
