"""Operator 3 against brute force."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from statlake.llm.ngram_join import _have_partner, _sets, first_documents, jaccard_groups, linked, packed, unpacked
from statlake.llm.queries import op3_ngram_join

from ..conftest import SF_SMALL
from .conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent):
    """(doc_id, size, component) of each row, by comparing rows that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    where, parent = collections.defaultdict(list), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = collections.Counter(j for g in s for j in where[g])
        for j, o in common.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                parent[root(i)] = root(j)
        for g in s:
            where[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op3_ngram_join(spark, SF_SMALL).collect()), key=key)
    assert got == sorted(brute(rows, 4, 85), key=key)


def test_families_of_near_copies(spark):
    """Chains whose ends do not link, exact copies, and strangers that share a frequent passage."""
    random.seed(2)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=25)
    rows = []
    for family in range(6):
        base = random.choices(vocabulary, k=random.choice([8, 60, 150]))
        now = base
        for _ in range(25):
            now = list(now)
            now[random.randrange(len(now))] = random.choice(vocabulary)
            rows += [" ".join(now)] * random.choice([1, 1, 3])
    rows += [" ".join(passage + random.choices(vocabulary, k=12)) for _ in range(60)]
    random.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k, percent in ((4, 85), (5, 80), (2, 50)):
        got = sorted(map(tuple, jaccard_groups(df, k, percent).collect()), key=key)
        assert got == sorted(brute(rows, k, percent), key=key)


def test_odd_rows(spark, odd, empty):
    want = sorted(brute([(r[0], r[1]) for r in odd_rows()], 5, 80), key=key)
    assert sorted(map(tuple, jaccard_groups(odd, 5, 80).collect()), key=key) == want
    kept = first_documents(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(1 for d, _, c in want if d is None or d == c)
    assert jaccard_groups(empty).count() == 0 and first_documents(empty).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_bounds_are_exact(percent):
    random.seed(percent)
    kind = [("key", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<u4")]
    for _ in range(400):
        rows = []
        for k in range(random.randint(1, 4)):
            for node in range(random.randint(2, 9)):
                n = random.randint(1, 40)
                rows.append((k, node, n, random.randint(0, min(n - 1, 8))))
        a = np.sort(np.array(rows, kind))
        r = a["n"].astype(int) - a["pos"]
        for i, ok in enumerate(_have_partner(a, percent)):
            others = [j for j in range(len(a)) if j != i and a["key"][j] == a["key"][i]]
            assert ok == any((100 + percent) * min(r[i], r[j]) >= percent * (int(a["n"][i]) + int(a["n"][j])) for j in others)
    for _ in range(300):
        x, y = ([np.unique(np.random.randint(0, 12, random.randint(0, 9)).astype("<u8")) for _ in range(3)] for _ in range(2))
        both = sum(len(np.intersect1d(u, v)) for u, v in zip(x, y))
        union = sum(map(len, x)) + sum(map(len, y)) - both
        if union:
            assert linked(x, y, percent) == (100 * both >= percent * union)


@pytest.mark.parametrize("cuts", [1, 2, 4, 7])
def test_pieces_are_exact_and_short(cuts):
    """Sets of any size come back whole, edges of the fragments included; full ones take less than six bytes an n-gram."""
    rng = np.random.default_rng(cuts)
    top = 1 << 48
    edges = [0, *(-(-(c << 24) // (cuts - 1)) << 24 for c in range(1, cuts - 1))]
    sets = [np.array(sorted({*edges, top - 1, *(e - 1 for e in edges[1:])})), np.zeros(0, int), np.array([top - 1]), np.array([0])]
    step = (1 << 40) - 1
    sets += [np.array([0, step, step + 1, 3 * step, 3 * step + 1])]
    sets += [np.unique(rng.integers(0, top, n)) for n in (1, 2, 30, 900 * cuts)]
    v, slot = [], []
    for i, s in enumerate(sets):
        cut = (s >> 24) * (cuts - 1) >> 24
        cut = np.where(rng.random(len(s)) < 0.05, cuts - 1, cut)  # frequent n-grams lie in the last piece
        order = np.argsort(cut, kind="stable")
        v.append(s[order])
        slot.append(i * cuts + cut[order])
    pieces = packed(np.concatenate(v).astype(np.uint64), np.concatenate(slot), len(sets) * cuts, cuts)
    assert len(pieces) == len(sets) * cuts
    for i in range(len(sets)):
        got = unpacked(pieces[i * cuts : (i + 1) * cuts])
        for c in range(cuts):
            assert got[c].tolist() == v[i][slot[i] == i * cuts + c].tolist()
    assert sum(map(len, pieces[-cuts:])) < 5.5 * len(sets[-1])


def test_worker_memory_does_not_grow_with_the_batch():
    """Texts of a batch are cut into n-grams a little at a time: a worker holds tens of bytes for each byte."""
    words = [f"w{i}" for i in range(5000)]
    rng = random.Random(3)
    texts = [" ".join(rng.choices(words, k=350)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["doc_id", "text"])
    assert sum(map(len, texts)) > 3_500_000
    tracemalloc.start()
    try:
        n = sum(len(s) for _, s, _ in _sets(iter([batch]), 5))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 690_000 and most < 64 << 20
