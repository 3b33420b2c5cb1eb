"""Packing token ids into windows (operator 7): Karmarkar-Karp multiway differencing.

Each document's ids are cut into full windows plus one tail shorter than a
window. The tails of a run of documents (``group_docs`` neighbours of one
task) are spread over as many windows as they fill, by multiway differencing:
every tail starts as a partition of its own with one loaded window, and the two
partial partitions with the largest imbalance are merged, the fullest
window of one with the emptiest of the other, until one partition is left. Its
windows are near-equal. The number of windows starts at the least that could do
and rises whenever capacity is exceeded, until no window is. As many windows as
the ids of the run fill stay, the fullest ones; the pieces of the others are cut
to fill them up, and what is left, less than a window, goes on into the task's
next run. Only the end of a task is cut at powers of two, which need no padding.

A run is bounded, so memory is bounded, nothing is shuffled, and a lost task
is recomputed alone from its input split.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from statlake.llm.common import pick, slices
from statlake.llm.tokens import encoder

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint"
)

Piece = tuple[int, int, int]  # document (position in the run), start, length
Item = tuple[int, int, bytes, int]  # document id, its ids before these, these, all its ids


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: ``len(sizes)`` items on ``k`` windows, near-equal sums.

    Returns the items (positions) of each window.
    """
    if k <= 1:
        return [list(range(len(sizes)))] if k == 1 else []
    # a partial partition: its windows that hold items as (-sum, items), fullest first; the others are empty
    heap = [(-s, i, [(-s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # the fullest of b meets the last window of a: only those from k - len(b) on do
        alone, below = max(0, k - len(b)), max(0, k - len(a))
        both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[alone:], reversed(b[below:]), strict=False)]
        merged = a[:alone] + both + b[:below][::-1]
        merged.sort(key=itemgetter(0))
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (merged[0][0] - least, made, merged))
        made += 1
    groups = [items for _, items in heap[0][2]] if heap else []
    return groups + [[] for _ in range(k - len(groups))]


def fitting(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each window: near-equal windows, of which none exceeds ``capacity`` (no size does).

    The number of windows starts at the least that could hold all and rises whenever a window is
    exceeded, by what was too much and each time by twice as many at least; then all items are differenced anew.
    """
    k, step = -(-sum(sizes) // capacity), 1
    while True:
        groups = difference(sizes, k)
        over = sum(max(0, sum(sizes[i] for i in items) - capacity) for items in groups)
        if not over:
            return groups
        k, step = min(len(sizes), k + max(step, -(-over // capacity))), 2 * step


def fill_windows(lengths: list[int], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows for documents of the given lengths, and the pieces left over (less than a window)."""
    windows: list[list[Piece]] = []
    tails: list[Piece] = []
    for d, n in enumerate(lengths):
        full = n // capacity
        windows.extend([(d, j * capacity, capacity)] for j in range(full))
        if n % capacity:
            tails.append((d, full * capacity, n % capacity))
    near = [[tails[i] for i in items] for items in fitting([t[2] for t in tails], capacity)]
    near.sort(key=lambda w: -sum(p[2] for p in w))
    k = sum(t[2] for t in tails) // capacity
    rest = [p for w in near[k:] for p in w]
    for w in near[:k]:
        w += take(rest, capacity - sum(p[2] for p in w))
    return windows + near[:k], rest


def take(pieces: list[Piece], n: int) -> list[Piece]:
    """``n`` ids off the end of the list, its last piece cut where it is longer."""
    got = []
    while n:
        d, s, m = pieces.pop()
        if m > n:
            pieces.append((d, s + n, m - n))
            m = n
        got.append((d, s, m))
        n -= m
    return got


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows of falling powers of two for pieces of less than a window."""
    windows, left = [], sum(p[2] for p in pieces)
    while left:
        windows.append(take(pieces, 1 << (left.bit_length() - 1)))
        left -= 1 << (left.bit_length() - 1)
    return windows


def pack_run(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Windows of at most ``capacity`` ids for documents of the given lengths, with nothing to follow."""
    windows, rest = fill_windows(lengths, capacity)
    return windows + powers_of_two(rest)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 0,
    group_docs: int = 256,
    group_bytes: int = 4 << 20,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of token sequences: which ids of which document stand where.

    One row per piece: ``doc_id``, ``start`` (the document's ids before it),
    ``length``, ``ids_crc32`` of its ids as little-endian unsigned 32-bit
    integers, ``doc_tokens`` (with ``end_id``, appended to every document),
    ``sequence_id``, ``offset`` in the sequence, and with ``with_ids`` the ids
    themselves (``ids`` binary, same coding).

    * NULL or empty text: the document is its end id alone; it is packed too.
    * NULL ``doc_id`` stays NULL; repeated rows are packed once each.
    * an empty table gives an empty table; other columns are ignored, whatever
      their names; a text of any length is cut over many sequences.
    * ``sequence_id`` is unique, ascending within a task, not dense.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, held=1_000_000)
        base, made = TaskContext.get().partitionId() << 40, 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def rows_of(windows: list[list[Piece]], items: list[Item]) -> Iterator[tuple]:
            nonlocal made
            for w in windows:
                offset = 0
                for d, s, n in w:
                    doc_id, before, raw, tokens = items[d]
                    own = raw[4 * s : 4 * (s + n)]
                    yield doc_id, before + s, n, zlib.crc32(own), tokens, base + made, offset, own
                    offset += n
                made += 1

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[7], pa.binary())], [*names, "ids"])
            return pa.RecordBatch.from_arrays(arrays, names)

        left: list[Item] = []  # what did not fill a window goes on into the task's next run
        for batch in batches:
            for part in slices(batch, "text", 8 * group_docs, 2 * group_bytes):
                flat, at = enc.encode(part.column("text"))
                ids = np.insert(flat, at[1:], end_id).astype("<u4", copy=False)
                at = (at + np.arange(len(at))).tolist()
                doc_ids, raw, rows = part.column("doc_id").to_pylist(), ids.tobytes(), []
                for lo in range(0, part.num_rows, group_docs):
                    hi = min(lo + group_docs, part.num_rows)
                    items = left + [(doc_ids[i], 0, raw[4 * at[i] : 4 * at[i + 1]], at[i + 1] - at[i]) for i in range(lo, hi)]
                    windows, rest = fill_windows([len(x[2]) // 4 for x in items], capacity)
                    rows.extend(rows_of(windows, items))
                    left = [(items[d][0], items[d][1] + s, items[d][2][4 * s : 4 * (s + n)], items[d][3]) for d, s, n in rest]
                if rows:
                    yield out(rows)
        rows = list(rows_of(powers_of_two([(i, 0, len(x[2]) // 4) for i, x in enumerate(left)]), left))
        if rows:
            yield out(rows)

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))
