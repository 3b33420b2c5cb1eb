"""Operator 9: chunk boundaries, containment, the edit probe against brute force."""

import hashlib
import random

import numpy as np

from statlake.llm.fingerprints import chunk_ends, chunk_set, containment, edit_probe, fingerprint, fingerprint_documents, gear_hashes, parse_fingerprint
from statlake.llm.queries import op9_fingerprints

from ..conftest import SF_SMALL
from .conftest import odd_rows


def raw(text):
    return np.frombuffer(text.encode(), np.uint8)


def test_gear_hash_is_the_rolling_hash():
    from statlake.llm.fingerprints import _GEAR

    data = np.random.default_rng(0).integers(0, 256, 500).astype(np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(_GEAR[b])) % 2**32
        want.append(h)
    assert gear_hashes(data).tolist() == want


def test_chunks_cover_and_are_bounded():
    rng = np.random.default_rng(1)
    for n in (0, 1, 31, 32, 33, 5000, 200_000):
        ends = chunk_ends(rng.integers(97, 123, n).astype(np.uint8))
        size = np.diff(np.concatenate([[0], ends]))
        assert size.sum() == n and (not n or (size[:-1] >= 32).all() and size.max() <= 512)
    assert 100 < size.mean() < 170
    assert (np.diff(chunk_ends(np.zeros(5000, np.uint8))) <= 512).all()


def test_shifts_keep_most_chunks():
    random.seed(3)
    text = " ".join("".join(random.choices("abcdefgh", k=5)) for _ in range(2000))
    a, b = chunk_set(raw(text)), chunk_set(raw("some words before " + text[:6000] + " an edit " + text[6000:]))
    assert containment(a, b) > 0.9 and containment(a, a) == 1
    assert containment(a, chunk_set(raw(text[::-1]))) < 0.05
    assert parse_fingerprint(fingerprint(a)) == a
    assert containment({}, {}) == 1 and containment({}, a) == 0 and containment(a, {}) == 0


def probe(rows):
    out = []
    for i, (d, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new, nxt = (chunk_set(raw(t)) for t in (text, edited, after))
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(own), fingerprint(new), containment(own, new), containment(own, nxt)))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op9_fingerprints(spark, SF_SMALL).select(COLUMNS).collect()))
    assert got == sorted(probe(sorted(rows, key=lambda r: -r[0])))


def test_odd_rows(spark, odd, empty):
    rows = sorted([(r[0], r[1]) for r in odd_rows()], key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = sorted(map(repr, map(tuple, edit_probe(odd).select(COLUMNS).collect())))
    assert got == sorted(map(repr, probe(rows)))
    assert edit_probe(empty).count() == 0
    one = edit_probe(odd.filter("doc_id = 8")).collect()
    assert [(r.n_chars, r.near_edited, r.near_next) for r in one] == [(0, 1.0, 1.0)]
    prints = {(r.doc_id, r.n_chars, r.fingerprint) for r in fingerprint_documents(odd).collect()}
    assert prints == {(d, len(t or ""), fingerprint(chunk_set(raw(t or "")))) for d, t in rows}


def test_short_texts_keep_what_they_share(spark):
    """Half of each text is replaced, or one letter: the rest is still found."""
    random.seed(8)
    text = lambda n: " ".join("".join(random.choices("abcdefghijklmnopqrst", k=random.randint(2, 9))) for _ in range(n))[:n]
    sizes = {n: 60 for n in (50, 100, 150, 200, 300)}
    rows = [(i, text(n)) for i, n in enumerate(n for n, m in sizes.items() for _ in range(m))]
    got = edit_probe(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    for n, least in zip(sizes, (0.15, 0.3, 0.35, 0.37, 0.4), strict=True):
        near = [r.near_edited for r in got if r.n_chars == n]
        assert least < sum(near) / len(near) < 0.55, n
        assert n == 50 or near.count(0) <= 5, n
    kept = [containment(chunk_set(raw(t)), chunk_set(raw(t[: len(t) // 2] + "#" + t[len(t) // 2 + 1 :]))) for _, t in rows if len(t) >= 100]
    assert sum(kept) / len(kept) > 0.6
    assert max(r.near_next for r in got if r.n_chars >= 100) < 0.3
