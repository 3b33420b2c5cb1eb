"""Operator 2: targets against a plain water level, totals, reruns, hot sources."""

import re

import numpy as np
from pyspark.sql import functions as F

from statlake.llm.mixing import mix_report, mix_sources, mixed_documents, settle, source_targets

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_level(sizes, weights, cap=3.0):
    """Targets by taking full sources out until none is above its cap."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    total = float(sum(sizes.values()))
    while open_:
        left = total - sum(target[s] for s in sizes if s not in open_)
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > cap * sizes[s]}
        if not over:
            for s in open_:
                target[s] = level * weights[s]
            break
        for s in over:
            target[s] = cap * sizes[s]
        open_ -= over
    return target


def test_targets(spark):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 23):
        sizes = {f"s{i:02d}": int(v) for i, v in enumerate(rng.choice([0, 1, 10, 500, 100_000], n))}
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
        df = spark.createDataFrame([(s, v, 1) for s, v in sizes.items()], "source string, size long, n long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = water_level(sizes, weights)
        assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in sizes), (got, want)


def test_rounding_keeps_words_and_expectations():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(1, 300, 120))[::-1].astype(float)
    p = np.full(len(a), 0.37)
    drawn, missed = [], []
    for seed in range(300):
        out = settle(a, p, np.random.default_rng(seed), root=True)
        assert set(out) <= {0.0, 1.0}
        missed.append(abs((a * out).sum() - (a * p).sum()))
        drawn.append(out)
        inner = settle(a, p, np.random.default_rng(seed), root=False)
        assert abs((a * inner).sum() - (a * p).sum()) < 1e-6
    assert abs(np.mean(drawn, axis=0) - 0.37).max() < 0.13
    # of 300 words at most in a document: the last one rounded is mostly a small one
    assert max(missed) <= 300 and np.mean(missed) <= 10


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = mix_report(docs).collect()
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.size for r in got} == words and len(got) == len(words)
    per = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        per.setdefault((r.source, r.target, r.source_size), []).append(r)
    assert abs(sum(t for _, t, _ in per) - sum(words.values())) < 1e-6 * sum(words.values())
    for (_, target, size), rows in per.items():
        assert sum(r.size for r in rows) == size
        # within the smallest documents' words, unless the fraction itself is smaller
        assert abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows)
    again = mix_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_rows(spark, odd, empty):
    got = mix_report(odd).collect()
    assert len(got) == 11 and all(r.taken == 0 for r in got if r.size == 0)
    assert len({(r.copies, r.size) for r in got if r.doc_id == 5}) == 1
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mix_report(empty).count() == 0 and mixed_documents(empty).count() == 0


def test_a_hot_source_is_split_over_leaves(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("source"),
    )
    rows = mix_sources(docs, leaf=64, fan=4).collect()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 50  # one document
