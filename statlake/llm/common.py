"""Shared helpers of the corpus operators: column picking, scratch tables, word spans.

Words everywhere in this package are maximal runs of bytes outside the ASCII
white space ``0x20, 0x09-0x0D``. Those byte values never occur inside a
multi-byte UTF-8 character, so texts can be cut on their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.session import scratch_dir

# Fixed value: what a word is, as a Java / RE2 pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any file system it knows)."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


#: rows of text handed to a Python worker at once, at most
BATCH_ROWS = 2048


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers at most ``BATCH_ROWS`` rows at once (Spark's default is
    10,000, which is a lot of memory where rows are texts). A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The named columns cast to the given types; all others are left out.

    A column is found by its exact name first, then ignoring case, and taken
    by position. Further columns whose names clash (``Text`` beside ``text``,
    or one named like an output) therefore cannot make a reference ambiguous.
    A missing column reads as NULL. The session's Arrow batches are bounded
    from here on (:func:`bounded_batches`).
    """
    bounded_batches(df.sparkSession)
    names = df.columns
    lower = [n.lower() for n in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for want, kind in columns.items():
        if want in names:
            col = F.col(f"c{names.index(want)}")
        elif want.lower() in lower:
            col = F.col(f"c{lower.index(want.lower())}")
        else:
            col = F.lit(None)
        out.append(col.cast(kind).alias(want))
    return plain.select(*out)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    This is how lineage is cut here: the table lives on storage all executors
    share, so it outlives any of them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def least(h: Column, n: int, total: Column | int) -> Column:
    """Admits the ``n`` rows of least hash ``h`` (64 bits, signed) out of ``total``, and about as many more.

    Twice the share of ``n``, and 40 rows, so that fewer than ``n`` come through about once in 10^15 draws: sort
    those by hash and take ``n``. The share is one of all 2^64 hashes and never rounds to none, whatever the total.
    """
    total = total if isinstance(total, Column) else F.lit(total)
    share = F.least(F.lit(1.0), F.lit(2.0 * n + 40) / F.greatest(total, F.lit(1)))
    return h.cast("double") <= F.lit(-(2.0**63)) + share * F.lit(2.0**64)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, text: str, max_rows: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of at most ``max_rows`` rows and about
    ``max_bytes`` of text (one longer text makes a run of its own)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    start, held = 0, 0
    for i, s in enumerate(size.tolist()):
        if i > start and (i - start >= max_rows or held + s > max_bytes):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += s
    if batch.num_rows > start:
        yield batch.slice(start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array, and the n+1 offsets in it."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word of the joined texts, and each text's
    first word (n+1 positions in the word arrays)."""
    inside = ~_SPACE[raw]
    # a word also ends where its text ends
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    heads = offsets[(offsets > 0) & (offsets < len(raw))]
    starts[heads] = inside[heads]
    ends[heads - 1] = inside[heads - 1]
    first = np.flatnonzero(starts)
    last = np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, offsets, side="left")


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_P_INV = np.uint64(pow(int(_P), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: equal inputs stay equal, all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over random byte values,
    taken from prefix sums, shifted to the span's own origin and mixed with its length."""
    if not len(first):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_P, len(raw)), out=total[1:])
    shift = _powers(_P_INV, len(raw))
    h = (total[last] - total[first]) * shift[first]
    return mix(h ^ mix((last - first).astype(np.uint64)))
