"""Operators 1 and 7 against the tokenizers library itself."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from statlake.llm.packing import difference, fill_windows, fitting, pack_documents, pack_run
from statlake.llm.queries import byte_bpe, op1_token_files, op7_packing
from statlake.llm.token_files import decode_values, encode_values, read_token_files, write_token_files
from statlake.llm.tokens import Encoder, encoder
from statlake.session import scratch_dir

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(byte_bpe())
    return lambda text, end: np.array([*model.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_chunked_ids_equal_the_librarys(library):
    random.seed(5)
    parts = ["a", "B", " ", "  ", "\n", " \n", "\t", "é", "1", "23", "...", "'s", "　", "\x1c", "\x85", "<|endoftext|>", "日本", "!", "\r\n", " the", "​", "😀"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(1500)]
    ids, at = encoder(byte_bpe()).encode(pa.array(texts))
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == library(text, 0)[:-1].tolist(), repr(text)


def test_held_chunks_are_bounded(library):
    enc = encoder(byte_bpe())
    full, enc.HELD = enc.HELD, 10
    try:
        for i in range(5):
            text = " ".join(f"w{i}x{j}" for j in range(50))
            assert enc.encode(pa.array([text]))[0].tolist() == library(text, 0)[:-1].tolist()
            assert len(enc.held) <= 10 + 50
    finally:
        enc.HELD = full


def test_held_chunks_are_small():
    """A worker that holds a million chunks has tens of megabytes of them, not hundreds."""
    enc, n = Encoder(byte_bpe()), 40_000
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(100)) for i in range(n // 100)])
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        enc.encode(texts)
        most = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert len(enc.held) > 0.98 * n and most < 80 * n


def test_texts_at_hand_stay_held(library):
    """A full table keeps the chunks of the texts at hand, and ids stay right when it starts anew within a call."""
    enc = Encoder(byte_bpe())
    enc.HELD = 30
    for i in range(6):
        texts = [f"common words stay  w{i}x{j} common " for j in range(40)] + [None, "", " ", "a  b c"]
        ids, at = enc.encode(pa.array(texts))
        for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
            assert ids[a:b].tolist() == library(text, 0)[:-1].tolist()
        assert "words" in enc.held.to_pylist() and len(enc.held) == len(set(enc.held.to_pylist())) <= 100


@pytest.mark.parametrize("top", [1, 255, 256, 65536, 2**24, 2**32 - 1])
def test_value_coding_round_trip(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 1000):
        v = rng.integers(0, top, n, endpoint=True).astype(np.uint32)
        control, data = encode_values(v)
        assert len(control) == -(-n // 4)
        assert decode_values(control, data, n).tolist() == v.tolist()
    assert encode_values(np.array([0, 255, 256, 70000], np.uint32)) == (bytes([0b10_01_00_00]), b"\x00\xff\x00\x01\x70\x11\x01")


def expected_files(rows, library):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text, 2)
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op1_whole_table(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op1_token_files(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected_files(rows, library)


def test_op1_odd_rows(spark, odd, empty, library):
    path = scratch_dir(spark, "t1")
    write_token_files(odd, path, byte_bpe())
    got = read_token_files(spark, path, with_ids=True).collect()
    rows = [(r[0], r[1]) for r in odd.select(odd.columns[0], "n_chars").collect()]
    assert len(got) == len(rows)
    from .conftest import odd_rows

    want = expected_files([(r[0], r[1]) for r in odd_rows()], library)
    # equal ids stand side by side in the order of their texts' hash; here they are equal rows
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(w[1:] for w in want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    none = scratch_dir(spark, "t1")
    write_token_files(empty, none, byte_bpe())
    assert read_token_files(spark, none).count() == 0


def test_files_are_in_document_order_and_ranked(spark):
    path = scratch_dir(spark, "t1")
    write_token_files(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), path, byte_bpe())
    files = spark.read.parquet(f"{path}/ids").orderBy("segment", "n_before").collect()
    ids = [r.doc_id for r in files]
    assert ids == sorted(ids)
    counts = np.zeros(60_000, np.int64)
    for r in read_token_files(spark, path, with_ids=True).collect():
        counts += np.bincount(np.frombuffer(r.ids, "<u4"), minlength=len(counts))
    order = [r.id for r in spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()]
    assert order == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))


def test_differencing_is_near_equal():
    rng = np.random.default_rng(1)
    for k in (1, 2, 7, 40):
        sizes = rng.integers(1, 1024, 12 * k).tolist()
        groups = difference(sizes, k)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in g) for g in groups]
        assert max(sums) - min(sums) <= 0.02 * sum(sums) / k + 8


@pytest.mark.parametrize("capacity", [1, 2, 8, 1024, 1000])
def test_pack_run_covers_each_id_once(capacity):
    rng = np.random.default_rng(capacity)
    for n in (0, 1, 5, 120):
        lengths = rng.integers(1, 3 * capacity + 2, n).tolist()
        windows = pack_run(lengths, capacity)
        cover = [[] for _ in lengths]
        for w in windows:
            assert 0 < sum(p[2] for p in w) <= capacity and all(p[2] > 0 for p in w)
            for d, s, m in w:
                cover[d] += range(s, s + m)
        assert [sorted(c) for c in cover] == [list(range(m)) for m in lengths]
        # all windows but the last few, which are powers of two, are full
        short = [sum(p[2] for p in w) for w in windows if sum(p[2] for p in w) < capacity]
        assert all(s & (s - 1) == 0 for s in short) and len(short) <= capacity.bit_length()


def naive_difference(sizes, k):
    """All k windows of every partial partition spelt out; the two of largest imbalance found by sorting."""
    parts = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1][0] - p[0][0])
        a, b, *parts = parts
        parts.append(sorted(((x + y, i + j) for (x, i), (y, j) in zip(a, b[::-1])), key=lambda w: -w[0]))
    return sorted(s for s, _ in parts[0])


def test_difference_equals_a_naive_merge():
    rng = np.random.default_rng(5)
    for n, k in ((1, 1), (1, 4), (5, 9), (12, 12), (30, 4), (60, 25), (90, 60)):
        # a draw without equal sizes: no ties, so the order of merges is settled
        sizes = sorted(rng.choice(10**9, n, replace=False).tolist())
        groups = difference(sizes, k)
        assert len(groups) == k and sorted(i for g in groups for i in g) == list(range(n))
        assert sorted(sum(sizes[i] for i in g) for g in groups) == naive_difference(sizes, k)


def test_window_count_rises_until_all_fit():
    rng = np.random.default_rng(6)
    for sizes in ([600] * 40, rng.integers(1, 1024, 256).tolist(), rng.integers(500, 700, 100).tolist(), [1023], []):
        groups = fitting(sizes, 1024)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in g) <= 1024 for g in groups)
        assert len(groups) >= -(-sum(sizes) // 1024)
        windows, rest = fill_windows(sizes, 1024)
        assert all(sum(p[2] for p in w) == 1024 for w in windows) and sum(p[2] for p in rest) == sum(sizes) % 1024


def test_powers_of_two_arise_once_a_task(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * (i % 37)) for i in range(900)], "doc_id long, text string").coalesce(1)
    load = {}
    pieces = pack_documents(docs, byte_bpe(), group_docs=50).collect()
    for p in pieces:
        load[p.sequence_id] = load.get(p.sequence_id, 0) + p.length
    short = sorted(n for n in load.values() if n < 1024)
    assert len(short) == len(set(short)) and all(n & (n - 1) == 0 for n in short)
    assert sum(load.values()) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def check_pieces(pieces, rows, library):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in rows:
        ids, at = library(text, 0), 0
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        for p in own:
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 1024 or at & (at - 1) == 0


def test_op7_whole_table(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(op7_packing(spark, SF_SMALL).collect(), rows, library)


def test_op7_odd_rows(spark, odd, empty, library):
    from .conftest import odd_rows

    got = pack_documents(odd, byte_bpe(), with_ids=True).collect()
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert sum(p.length for p in got) == sum(len(library(t, 0)) for _, t in rows)
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in got)
    once = [r for r in rows if r[0] != 5]
    check_pieces([p for p in pack_documents(odd.filter("doc_id <> 5 OR doc_id IS NULL"), byte_bpe()).collect()], once, library)
    assert pack_documents(empty, byte_bpe()).count() == 0
