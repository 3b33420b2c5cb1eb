"""Document fingerprints (operator 9): content-defined chunks, sets of digests.

A gear hash runs over a text's UTF-8 bytes; a chunk ends where the hash of the
bytes before meets a mask. The mask is stricter before the target length and looser after
(normalised chunking), so lengths gather around the target while boundaries
still depend on nearby bytes alone: an edit moves the chunks it touches, and the
rest keep their digests wherever they shift to. A fingerprint is the set of chunk digests
with their lengths, as text; likeness is containment weighted by length.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import pick, shuffle_partitions, span_hashes

#: target length of a fingerprint's chunks: short texts have several too
TARGET = 16
_GEAR = np.random.default_rng(20240511).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the 32 bytes up to it: sum of ``gear[byte] << age``."""
    h = _GEAR[raw]
    for m in (1, 2, 4, 8, 16):
        nxt = h.copy()
        nxt[m:] += h[:-m] << np.uint32(m)
        h = nxt
    return h


def chunk_ends(raw: np.ndarray, target: int = 128) -> np.ndarray:
    """Ends of the chunks: at least ``target/4`` and at most ``target*4`` bytes
    long (the last may be shorter); the mask has one bit more than ``target``
    before it and one less after. The hash starts anew with the text."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    bits = target.bit_length() - 1
    h = gear_hashes(raw)
    loose = np.flatnonzero(h >> np.uint32(32 - (bits - 1)) == 0) + 1
    strict = (loose[h[loose - 1] >> np.uint32(32 - (bits + 1)) == 0]).tolist()
    loose = loose.tolist()
    ends, at, low, high = [], 0, target // 4, target * 4
    i = j = 0
    while n - at > low:
        i = bisect_left(strict, at + low, i)
        if i < len(strict) and strict[i] <= at + target:
            end = strict[i]
        else:
            j = bisect_left(loose, at + target + 1, j)
            end = loose[j] if j < len(loose) and loose[j] <= at + high else at + high
        if end >= n:
            break
        ends.append(end)
        at = end
    ends.append(n)
    return np.array(ends, np.int64)


Chunks = dict[int, int]  # digest -> length


def chunk_set(raw: np.ndarray, target: int = TARGET) -> Chunks:
    ends = chunk_ends(raw, target)
    starts = np.concatenate([[0], ends])[: len(ends)].astype(np.int64)
    digests = span_hashes(raw, starts, ends) >> np.uint64(16)
    return dict(zip(digests.tolist(), (ends - starts).tolist(), strict=True))


def fingerprint(chunks: Chunks) -> str:
    """Digests (12 hex digits) and lengths (hex), ascending, joined by blanks."""
    return " ".join(f"{d:012x}:{n:x}" for d, n in sorted(chunks.items()))


def parse_fingerprint(text: str) -> Chunks:
    return {int(d, 16): int(n, 16) for d, n in (p.split(":") for p in text.split())}


def containment(a: Chunks, b: Chunks) -> float:
    """Share of ``a``, by length, that is in ``b``; 1 for two empty sets, 0 for one."""
    whole = sum(a.values())
    if not whole:
        return 0.0 if b else 1.0
    return sum(n for d, n in a.items() if d in b) / whole


def fingerprint_documents(docs: DataFrame, target: int = TARGET) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row: no shuffle.

    * NULL or empty text: 0 characters and an empty fingerprint.
    * equal texts have equal fingerprints; repeated rows are each returned;
      an empty table gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            prints = [fingerprint(chunk_set(np.frombuffer(t.encode(), np.uint8), target)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the next's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_probe(docs: DataFrame, target: int = TARGET) -> DataFrame:
    """How fingerprints follow an edit, for every row: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document follows by descending ``doc_id`` (NULL last; equal ids by
    a hash of their text, descending), and the first follows the last. The edited text
    has its last half replaced by the start of the next document. ``near_*`` is
    the containment of the document's fingerprint in the other.

    * NULL or empty text reads as empty: an empty fingerprint, contained (1) in
      an empty one and not at all (0) in others.
    * a single row is its own next; repeated rows follow each other; an empty
      table gives an empty one; other columns are ignored.

    Texts move once, to ranges of ids; only each range's first text goes to
    two, its own and the range before.
    """
    rows = pick(docs, {"doc_id": "bigint", "text": "string"}).withColumn("tie", F.xxhash64("text"))
    parts = shuffle_partitions(docs.sparkSession)
    # equal shares of ids; ties by the text's hash keep one id's rows in order
    cuts = rows.agg(F.percentile_approx("doc_id", [i / (4 * parts) for i in range(1, 4 * parts)], 10_000)).first()[0] or []
    edges = sorted(set(cuts))
    # range 0 has the largest ids; NULL ids come after all others
    bucket = F.lit(len(edges)) - F.coalesce(F.expr(_rank_sql(edges)), F.lit(-1))
    rows = rows.withColumn("bucket", bucket.cast("bigint"))
    order = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tie")
    firsts = rows.groupBy("bucket").agg(F.max(order).alias("head"))  # one row for each range
    line = Window.orderBy("bucket")
    firsts = firsts.withColumn("before", F.coalesce(F.lag("bucket").over(line), F.max("bucket").over(Window.partitionBy())))
    firsts = F.broadcast(firsts.select(F.col("bucket").alias("b"), "head", "before"))
    # as many rows as ranges: 4 for each shuffle partition, at most
    marked = rows.join(firsts, F.col("bucket") == F.col("b"), "left").withColumn("first", order == F.col("head"))
    here = F.struct(F.col("bucket").alias("to"), F.lit(0).alias("guest"))
    there = F.struct(F.col("before").alias("to"), F.lit(1).alias("guest"))
    sent = marked.withColumn("at", F.explode(F.when(F.col("first"), F.array(here, there)).otherwise(F.array(here))))
    sent = sent.select("doc_id", "text", "tie", F.col("at.to").alias("to"), F.col("at.guest").alias("guest"))
    sent = sent.repartition(parts, "to").sortWithinPartitions("to", "guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc_nulls_last())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple]:
            held = None
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "to", "guest"))
                for doc_id, text, to, guest in zip(*columns, strict=True):
                    raw = np.frombuffer((text or "").encode(), np.uint8)
                    now = (doc_id, text or "", to, guest, chunk_set(raw, target))
                    # the rows of a range, each with the next; guests close their range
                    if held is not None and held[2] == to and not held[3]:
                        yield held, now
                    held = now

        done = []
        for a, b in pairs():
            edited = edited_text(a[1], b[1]).encode()
            new = chunk_set(np.frombuffer(edited, np.uint8), target)
            done.append((a[0], len(a[1]), hashlib.sha256(edited).hexdigest(), fingerprint(a[4]), fingerprint(new), containment(a[4], new), containment(a[4], b[4])))
            if len(done) == 512:
                yield _batch(done)
                done = []
        if done:
            yield _batch(done)

    return sent.select("doc_id", "text", "to", "guest").mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _rank_sql(edges: list[int]) -> str:
    """How many edges are at most ``doc_id``, by a balanced tree of comparisons; NULL for NULL."""

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF(doc_id < {edges[mid]}, {tree(lo, mid)}, {tree(mid + 1, hi)})"

    return f"IF(doc_id IS NULL, NULL, {tree(0, len(edges))})"
