"""Operators 5 and 8: native, against plain Python and (8) SQL."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from statlake.llm.queries import ORACLE, QUERIES, op5_quality_rules, op8_url_filters
from statlake.llm.rules import POLICIES, RULES, ablation, mask, passes, quality_rules, rule_ledger
from statlake.llm.urls import host_and_path, judge_urls, longest_rule

from ..conftest import SF_SMALL
from .conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(rows, texts):
    got = sorted((tuple(r[c] for c in BASE) for r in rows))
    assert got == sorted(counted(t) for t in texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_whole_table(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    check(op5_quality_rules(spark, SF_SMALL).collect(), texts)


def test_rules_repeated_windows(spark):
    texts = ["a b c d e f g h " * 3, "x " * 40, "x " * 8, "x " * 9, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(5, 16))), "p q\np q\n\n \np q"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(quality_rules(df).collect(), texts)


def test_rules_odd_rows(spark, odd, empty):
    check(quality_rules(odd).collect(), [r[1] for r in odd_rows()])
    assert quality_rules(empty).count() == 0


def test_rules_use_no_python(spark):
    plan = op5_quality_rules(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_ablation_equals_counting_again(spark):
    ledger = rule_ledger(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).cache()
    for policy, rules in POLICIES.items():
        got = {r.rule: r for r in ablation(ledger, policy).collect()}
        assert set(got) == set(rules)
        for rule in rules:
            others = [r for r in rules if r != rule]
            assert got[rule].failing == ledger.filter(RULES[rule]).count()
            kept = ledger.filter(" AND ".join(f"NOT ({RULES[r]})" for r in others)).count()
            assert got[rule].kept == kept
            assert got[rule].alone == kept - ledger.filter(passes(policy)).count()
    assert mask(["few_words"]) == 1 and mask(list(RULES)) == 2 ** len(RULES) - 1


def test_planted_junk_fails_and_clean_text_passes(spark):
    clean = " ".join(f"clean{i} words" for i in range(60)) + ".\nA second line of it."
    junk = [
        " ".join(f"w{i}$$$" for i in range(40)), " | ".join(f"menu{i}" for i in range(40)), " ".join(f"SHOUT{i}!!" for i in range(40)),
        "again and again and " * 30, "\n".join(["the same line of this text once more"] * 6), "short text",
    ]
    rows = quality_rules(spark.createDataFrame(list(enumerate([clean, *junk])), "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.kept} == {0}


URLS = [
    ("https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/"),
    ("http://example.net/de/1", "example.net", "/de/1", "net/"),
    ("ftp://xexample.net/en/1", "xexample.net", "/en/1", "net/"),
    ("https://m.example.com/de/5#t", "m.example.com", "/de/5", "example.com/de/"),
    ("https://example.com/dex", "example.com", "/dex", None),
    ("https://w.org/fr/", "w.org", "/fr/", "org/fr/"),
    ("https://w.org/fr", "w.org", "/fr", None),
    ("https://a.net", "a.net", "", None),
    ("https://a.net?/q", "a.net", "", None),
    ("a://b://c/d", "b:", "//c/d", None),
    ("no url", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("://", "", "", None),
    ("https://ÄB.net/Ö/a//b/", "Äb.net", "/Ö/a//b/", "net/"),
    ("http://h.org/" + "x/" * 3000, "h.org", "/" + "x/" * 3000, None),
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(u,) for u, *_ in URLS], "url string")
    host, path = host_and_path(F.col("url"))
    rows = df.select("url", host.alias("host"), path.alias("path")).withColumn("rule", longest_rule(F.col("host"), F.col("path"))["rule"])
    assert [tuple(r) for r in rows.collect()] == URLS


def test_url_odd_rows(spark):
    pages = spark.createDataFrame(
        [(i, u, "x", 1) for i, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0], "x", 1), (None, "http://q.org/a", None, None)],
        "page_id long, url string, verdict string, n int",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0)], "page_id long, bad int")
    got = judge_urls(pages, labels).collect()
    assert len(got) == len(URLS) + 2
    by = {r.page_id: r for r in got}
    for i, (_, host, path, rule) in enumerate(URLS):
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule)
        assert by[i].verdict in ("allow", "block")
    none = judge_urls(pages.limit(0), labels)
    assert none.count() == 0
    assert {r.verdict for r in judge_urls(pages, labels.limit(0)).collect() if r.rule is None} == {"allow"}


def test_bad_templates_are_told_apart(spark):
    """One branch of a host is bad, its siblings are not; numbers are one template."""
    rows, labels = [], []
    for i in range(400):
        part = ("spam", "news", "blog", "shop")[i % 4]
        rows.append((i, f"https://one.test/{part}/{i * 7}.html"))
        if i % 3:
            labels.append((i, int(part == "spam")))
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad long")).collect()
    for r in got:
        assert r.verdict == ("block" if "/spam/" in r.path else "allow"), r
    assert len({r.template for r in got}) == 4 and all(r.template.endswith("/#.html") for r in got)


def deep_pages():
    """Branches that part at the seventh segment, two nested traps, and a path of 3000 segments."""
    rows, labels = [], []
    for i in range(300):
        part = ("spam", "news", "blog")[i % 3]
        rows.append((i, f"https://deep.test/a/b/c/d/e/f/{part}/x{i}/{i}.html"))
        labels.append((i, int(part == "spam")))
    for i in range(12):
        rows.append((1000 + i, "https://trap.test" + "/in/out" * (i % 6 + 1) + f"/{i}"))
    rows.append((2000, "https://long.test" + "/x" * 3000))
    return rows, labels


def test_deep_branches_are_told_apart(spark):
    rows, labels = deep_pages()
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad long")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.verdict == ("block" if "/spam/" in r.path else "allow"), r
    assert {r.template for r in got if r.host == "long.test"} == {"long.test" + "/x" * 3000}
    assert sum(r.template.startswith("deep.test/a/b/c/d/e/f/spam/") for r in got) == 100


def test_deep_oracle(spark, tmp_path):
    """The recursive SQL on pages as deep, whose labels come through their documents."""
    rows, labels = deep_pages()
    rows = [(i, u) for i, u in rows if i != 2000]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    docs = spark.createDataFrame([(i, 1 - bad, 0) for i, bad in labels], "doc_id long, quality long, toxic long")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    docs.write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = op8_url_filters(spark, str(tmp_path))
    want = con.sql(ORACLE["op8_url_filters"])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.sql(ORACLE[name])
    assert sorted(want.columns) == sorted(got.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_urls_use_no_python(spark):
    plan = op8_url_filters(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
