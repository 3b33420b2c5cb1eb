import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

import statlake.llm.ranked_search as m
from statlake.llm.queries import op11_ranked_search
from statlake.llm.ranked_search import ORACLE, Batch, ranked_search, sketches
from statlake.llm.terms import LETTERS_DIGITS, Terms

from ..conftest import SF_CHECK
from .conftest import odd_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    n, total = len(tf), sum(s for _, _, s in tf)
    df = Counter(w for _, c, _ in tf for w in c)
    out = []
    for item, text in set(items):
        asked = Counter(terms(text))
        scored = []
        for i, c, size in tf:
            at = 75 + 25 * size * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * at)) for w, q in asked.items() if c[w])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    got = op11_ranked_search(spark, SF_CHECK)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == sorted(con.sql(ORACLE).fetchall(), key=repr)


def test_copies_ties_and_batches(spark, monkeypatch):
    """A third of all documents one text, many equal scores, several batches of items, long and short texts."""
    monkeypatch.setattr(m, "BATCH_ITEMS", 3)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本語", "x-y", "🙂"]
    docs = [(i, "w1 w2 été the end" if i % 3 == 0 else " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.choice([0, 1, 5, 40, 400])))) for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(10)] + [(10, "the end"), (11, "nowhere"), (12, None)]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), k=4)
    assert rows_of(got) == brute(docs, items, 4)


def test_odd_and_empty(spark, odd, empty):
    docs = [r[:2] for r in odd_rows()]
    items = [(1, "the lazy dog OLD river"), (1, "the lazy dog OLD river"), (1, "another hello"), (None, "word"), (2, ""), (3, None), (4, "x"), (5, "word5 word5 other3 $$$")]
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    assert rows_of(ranked_search(odd, asked)) == brute(docs, items)
    assert ranked_search(empty, asked).collect() == []
    assert ranked_search(odd, asked.limit(0)).collect() == []


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(7)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.3, size).clip(0, 5000)) for size in (1, 3, 30, 300, 5000, 5000)]
    t = Terms(pa.array(texts), LETTERS_DIGITS)
    docs, total = len(texts), int(t.n.sum())
    some, made = sketches(t, docs, total)
    asked = [Terms(pa.array([x]), LETTERS_DIGITS).h for x in ("t1 t2 t7", "t4999 nowhere", texts[2])]
    batch = Batch([(i, i) for i in range(3)], [[(int(h), 5) for h in a.view(np.int64)] for a in asked])
    bound, score = batch.bounds(pa.array(made, pa.binary())), batch.scores(t, docs, total)
    assert some.tolist() == list(range(6)) and (bound >= score).all() and (score[:, 0] > 0).sum() > 3
    assert bound[5, 1] < bound[5, 0]  # a rare term is told from frequent ones
