import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa

from statlake.llm.divergence import ORACLE, Skyband, divergence_audit, heads, skyband
from statlake.llm.queries import op12_divergence

from ..conftest import SF_CHECK
from .conftest import odd_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k=200, min_docs=3):
    rows = [tuple(x or "" for x in r) for r in rows]  # text, lang, source
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(s, TERM.findall(t.translate(LOWER))) for t, la, s in rows if la == lang]
        df = Counter(w for _, ws in docs for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= min_docs)
        count = defaultdict(Counter)
        for s, ws in docs:
            count[s].update(w for w in ws if df[w] >= min_docs)
        total = sum(count.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {w: 1 + 10**9 * (c[w] + 1) // (n + len(kept)) for w in kept}

        q, p = share(total), {s: share(count[s]) for s in {s for s, _ in docs}}
        for s in p:
            pair = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode()) for o in p if o != s]
            term = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:k])):
                out += [(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_CHECK}/documents.parquet')")
    got = op12_divergence(spark, SF_CHECK)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows_of(got) == sorted(con.sql(ORACLE).fetchall())


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = ["a", "B", "été", "日本語", "it's", "x1y", "straße", "Straße", "zz", "sharedprefixa", "sharedprefixb", "ä", "🙂"] + [f"w{c}" for c in "abcdefghij"]
    rows = [
        (" ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None]))
        for _ in range(200)
    ]
    rows += [(None, "xx", "s1"), ("one two", "xx", "s2"), ("only", "yy", None), ("t t t", "zz", "s")] + [("t u", "zz", "r")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for k in (1, 3, 200):
        assert rows_of(divergence_audit(df.repartition(7), k=k)) == brute(rows, k)


def test_odd_and_empty(spark, odd, empty):
    rows = [r[1:4] for r in odd_rows()]
    assert rows_of(divergence_audit(odd, min_docs=1)) == brute(rows, min_docs=1)
    assert rows_of(divergence_audit(odd)) == brute(rows)
    assert divergence_audit(empty).collect() == []


def test_skyband_keeps_what_fewer_dominate():
    rng = np.random.default_rng(1)
    rows = [(int(n), int(ln), b"abcdefgh" * int(x % 2) + b"%03d" % x) for n, ln, x in zip(rng.integers(1, 9, 900), rng.integers(1, 40, 900), rng.permutation(900))]
    rows.sort(key=lambda r: (-r[0], r[1], r[2]))
    for k in (1, 5, 50):
        band, got = Skyband(k), []
        for lo in range(0, len(rows), 64):
            part = rows[lo : lo + 64]
            terms = pa.array([r[2].decode() for r in part])
            got += [part[i] for i in band.take(np.array([r[1] for r in part]), heads(terms), terms.cast(pa.binary()))]
        want = [t for t in rows if sum(o[0] >= t[0] and o[1] <= t[1] and o[2] < t[2] for o in rows) < k]
        assert got == want


def test_heads_order_like_bytes():
    words = ["a", "ab", "abcdefgh", "abcdefghi", "é", "日本語", "zz", "abcdefg", "🙂🙂🙂"]
    number = dict(zip(words, heads(pa.array(words)).tolist()))
    for x in words:
        for y in words:
            assert (number[x] < number[y]) == (x.encode()[:8] < y.encode()[:8])


def test_skyband_is_small(spark):
    """What a partition hands on does not grow with its terms where counts leave one order."""
    rows = [("en", "s", f"t{i:05d}", 1 + i % 3, 10, 2, 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, ln long, p long, q long").coalesce(1)
    assert skyband(df, 20).count() <= 3 * 20
