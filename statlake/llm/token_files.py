"""Token-id files (operator 1): frequency-ranked ids, byte-aligned, separate control bytes.

Format of one document (Stream-VByte layout):

* ids are replaced by their rank in the corpus's token frequencies (0 = most
  frequent; equal counts by id), so most values fit one byte;
* ``control``: two bits for each value, its byte length less one, four
  values to a control byte, the first in the lowest bits (the last
  byte is filled up with zeros);
* ``data``: the values' little-endian bytes, 1 to 4 for each, one after the other.

A table of files is a folder with ``ids/`` (Parquet containers written by
Spark's committer, one segment each, rows in ascending document order within
and across segments: ``segment, n_before, doc_id, n_tokens, control, data``) and
``vocabulary/`` (``rank, id``). Decoding looks each control byte up in a
256 x 4 table of lengths and gathers the bytes with numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.llm.common import pick, shuffle_partitions, slices, stored
from statlake.llm.tokens import encoder
from statlake.session import scratch_dir

#: lengths of the four values of each control byte
LENGTHS = np.stack([((np.arange(256) >> (2 * k)) & 3) + 1 for k in range(4)], axis=1).astype(np.int64)


def encode_documents(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(control, its offsets, data, its offsets)`` of documents one after the other.

    ``values`` are unsigned and below 2^32, ``at`` the n+1 offsets of the documents in
    them. Every document begins a control byte of its own.
    """
    v = np.ascontiguousarray(values, dtype="<u4")
    n = np.diff(at)
    head = np.concatenate([[0], np.cumsum(-(-n // 4))])
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(4 * int(head[-1]), np.uint8)
    code[np.arange(len(v)) + np.repeat(4 * head[:-1] - at[:-1], n)] = extra
    code = code.reshape(-1, 4)
    control = code[:, 0] | (code[:, 1] << 2) | (code[:, 2] << 4) | (code[:, 3] << 6)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    end = np.concatenate([[0], np.cumsum(extra.astype(np.int64) + 1)])
    return control, head, data, end[at]


def decode_documents(control: np.ndarray, head: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The values written by :func:`encode_documents`; ``n`` has each document's number of them."""
    at = np.concatenate([[0], np.cumsum(n)])
    size = LENGTHS[control].reshape(-1)[np.arange(at[-1]) + np.repeat(4 * head[:-1] - at[:-1], n)]
    begin = np.cumsum(size) - size
    out = data[begin].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        out[more] |= data[begin[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """``(control, data)`` of one document's values."""
    control, _, data, _ = encode_documents(values, np.array([0, len(values)]))
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values written by :func:`encode_values`."""
    head = np.array([0, len(control)])
    return decode_documents(np.frombuffer(control, np.uint8), head, np.frombuffer(data, np.uint8), np.array([n]))


def _as_binary(raw: np.ndarray, at: np.ndarray) -> pa.Array:
    """Bytes and the n+1 offsets in them as a column."""
    buffers = [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, buffers).cast(pa.binary())


def _as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without NULLs, and the n+1 offsets in them."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of each document (compressed), and at the end of each task its counts of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(tokenizer, held=1_000_000), zstandard.ZstdCompressor(level=1)
        size = max(enc.model.get_vocab_size(with_added_tokens=True), end_id + 1)
        width = "<u2" if size <= 1 << 16 else "<u4"
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 2048, 8 << 20):
                flat, at = enc.encode(part.column("text"))
                ids = np.insert(flat, at[1:], end_id)
                at = at + np.arange(len(at))
                counts += np.bincount(ids, minlength=size)
                raw, w = ids.astype(width).tobytes(), int(width[2])
                cut = (at * w).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["ids"] * part.num_rows),
                        part.column("doc_id"),
                        part.column("tie"),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([pack.compress(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ],
                    ["kind", "doc_id", "tie", "n_tokens", "blob"],
                )
        none = pa.array([None], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(["counts"]), none, none, none, pa.array([pack.compress(counts.tobytes())], pa.binary())],
            ["kind", "doc_id", "tie", "n_tokens", "blob"],
        )

    rows = pick(docs, {"doc_id": "bigint", "text": "string"}).withColumn("tie", F.xxhash64("text"))
    return rows.mapInArrow(run, "kind string, doc_id bigint, tie bigint, n_tokens bigint, blob binary")


def _ranked(counts: DataFrame) -> np.ndarray:
    """Ids by falling frequency. Bounded by the vocabulary, whatever the corpus."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor(), None
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                c = np.frombuffer(unpack.decompress(blob), np.int64)
                held = c.copy() if held is None else held + c
        if held is not None:
            used = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(held[used], pa.int64())], ["id", "n"])

    per_id = counts.mapInArrow(total, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = per_id.toPandas()
    order = np.lexsort((found["id"].to_numpy(), -found["n"].to_numpy()))
    return found["id"].to_numpy()[order].astype(np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Tokenise ``docs`` and write them as token-id files under ``path``.

    Every document becomes the ids of its whole text plus ``end_id``. Rows are
    ordered by ``doc_id`` (NULL first), equal ones by a hash of their text, so
    repeated rows are stored once each, side by side. NULL or empty text: the
    end id alone. No rows: empty files. Other columns are ignored.
    """
    spark = docs.sparkSession
    held = f"{scratch_dir(spark, 'token-ids')}"
    _tokenised(docs, tokenizer, end_id).write.partitionBy("kind").option("compression", "uncompressed").parquet(held)
    fields = "doc_id bigint, tie bigint, n_tokens bigint, blob binary"
    order = _ranked(spark.read.schema(fields).parquet(f"{held}/kind=counts"))
    ids = spark.read.schema(fields + ", kind string").parquet(held).filter("kind = 'ids'").drop("kind")
    # by id; ids that never occur have no rank and need none
    rank = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, segment, before = zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "blob", 2048, 4 << 20):
                n = part.column("n_tokens").to_numpy()
                raw = [unpack.decompress(b) for b in part.column("blob").to_pylist()]
                # all documents of a file have ids of one width
                width = "<u2" if len(raw[0]) == 2 * n[0] else "<u4"
                at = np.concatenate([[0], np.cumsum(n)])
                control, head, data, end = encode_documents(rank[np.frombuffer(b"".join(raw), width)], at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), segment), pa.int64()),
                        pa.array(before + at[:-1], pa.int64()),
                        part.column("doc_id"),
                        part.column("n_tokens"),
                        _as_binary(control, head),
                        _as_binary(data, end),
                    ],
                    ["segment", "n_before", "doc_id", "n_tokens", "control", "data"],
                )
                before += int(at[-1])

    parts = ids.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), F.col("tie"))
    parts = parts.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    files = parts.mapInArrow(run, "segment bigint, n_before bigint, doc_id bigint, n_tokens bigint, control binary, data binary")
    files.write.option("compression", "zstd").parquet(f"{path}/ids")
    vocabulary = pa.table({"rank": pa.array(np.arange(len(order)), pa.int64()), "id": pa.array(order, pa.int64())})
    spark.createDataFrame(vocabulary).coalesce(1).write.parquet(f"{path}/vocabulary")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode token-id files: ``doc_id, start, n_tokens, ids_crc32``, and with
    ``with_ids`` the ids (``ids`` binary, little-endian unsigned 32-bit).

    ``start`` is the number of ids of all documents before, in file order.
    """
    order = spark.read.schema("rank bigint, id bigint").parquet(f"{path}/vocabulary").toPandas()
    ids = np.zeros(len(order), "<u4")
    ids[order["rank"].to_numpy()] = order["id"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "data", 2048, 8 << 20):
                n = part.column("n_tokens").to_numpy()
                control, head = _as_bytes(part.column("control"))
                raw = ids[decode_documents(control, head, _as_bytes(part.column("data"))[0], n)].view(np.uint8)
                at = np.concatenate([[0], np.cumsum(4 * n)])
                cut = memoryview(raw)
                out = [part.column(c) for c in ("segment", "n_before", "doc_id", "n_tokens")]
                out.append(pa.array([zlib.crc32(cut[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.int64()))
                names = ["segment", "n_before", "doc_id", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(_as_binary(raw, at))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    fields = "segment bigint, n_before bigint, doc_id bigint, n_tokens bigint"
    files = spark.read.schema(fields + ", control binary, data binary").parquet(f"{path}/ids")
    rows = files.mapInArrow(run, fields + ", ids_crc32 bigint" + (", ids binary" if with_ids else ""))
    # one row for each segment: as many as the writing job had tasks
    sizes = files.groupBy("segment").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("segment").alias("s"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    joined = rows.join(sizes, rows.segment == sizes.s)
    out = ["doc_id", (F.col("base") + F.col("n_before")).alias("start"), "n_tokens", "ids_crc32"]
    return joined.select(*out, *(["ids"] if with_ids else []))
