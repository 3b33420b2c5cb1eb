"""Exact top-k search (operator 13): multi-resolution segment statistics.

A vector is cut into segments; of each, the mean and the standard deviation give a lower
bound on the distance of two vectors (``l * ((mean - mean')^2 + (dev - dev')^2)`` summed
over the segments of length l). With both norms known, a squared distance and an inner
product are the same figure (``2 x.y = |x|^2 + |y|^2 - d^2``), so the rows of highest
inner product are found by distance: few long segments rule out most rows, more and
shorter ones most of the rest, and what is left is computed exactly in integers.

Rows are dealt into tiles by hash. A task holds one tile, and queries stream past
it. First each query meets its own tile, which gives it a score to reach; then it meets the
other tiles, where the bounds are held against that score. Queries and rows meet through a
shuffle, so neither side passes through the driver, and memory is one tile
and one batch of queries whatever the size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import pick, shuffle_partitions, stored

SCALE = 256  # fixed value: components are floor(256 * x)
#: numbers of segments, coarse to fine
LEVELS = (4, 16)
#: rows of a tile: at most, and at least where there are tasks for more
TILE_ROWS, MIN_TILE_ROWS = 1 << 16, 1 << 11


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Rows that take part, and their components ``floor(256 * x)`` as little-endian 32-bit integers.

    Left out are NULL vectors and those with a NULL or non-finite component. A vector whose norm
    reaches 2^31 is an error: its scores need not fit in 64 bits.
    """
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    x = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    some = np.flatnonzero(np.asarray(pc.is_valid(column)) & (bad[at[1:]] == bad[at[:-1]]))
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(SCALE * x)
        for i in some.tolist():
            if np.square(whole[at[i] : at[i + 1]]).sum() >= 2.0**62:
                raise ValueError("a vector of norm 2^31 or more: its scores need not fit in 64 bits")
        raw = np.where(np.abs(whole) < 2.0**31, whole, 0).astype("<i4")
    return some, [raw[at[i] : at[i + 1]].tobytes() for i in some.tolist()]


def segment_stats(v: np.ndarray, parts: int) -> np.ndarray:
    """Mean and deviation of each of ``parts`` segments, times the root of its length: the
    distance of two such rows is at most the distance of the vectors, and their norms are the vectors' norms."""
    d = v.shape[1]
    edge = np.linspace(0, d, min(parts, d) + 1).astype(np.int64)
    size = np.diff(edge).astype(np.float64)
    mean = np.add.reduceat(v, edge[:-1], axis=1) / size
    square = np.add.reduceat(v * v, edge[:-1], axis=1) / size
    dev = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.concatenate([size, size]))


class Tile:
    """Rows of one length: exact vectors, squared norms and the statistics of each level."""

    def __init__(self, v: list[bytes], vec_id: np.ndarray, null: np.ndarray, own: np.ndarray, copies: np.ndarray, levels: Sequence[int]):
        # by id, so that of equal scores the first found is the first wanted
        order = np.lexsort((vec_id, null))
        self.v = np.frombuffer(b"".join(v), "<i4").reshape(len(v), -1)[order].astype(np.int64)
        self.vec_id, self.null, self.own, self.copies = vec_id[order], null[order], own[order], copies[order]
        real = self.v.astype(np.float64)
        self.norm = np.square(real).sum(axis=1)
        self.stats = [segment_stats(real, n) for n in levels] if real.shape[1] else []

    def best(self, q: np.ndarray, least: np.ndarray, k: int, levels: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query (row of ``q``): its number, and rows and scores of its ``k`` best rows here
        (by score, then id), of those that reach the score ``least`` (NaN: any)."""
        real = q.astype(np.float64)
        norm = np.square(real).sum(axis=1)
        fs = [segment_stats(real, n) for n in levels] if real.shape[1] else []
        for i in range(len(q)):
            rows = np.arange(len(self.v))
            reach = -np.inf if np.isnan(least[i]) else least[i]
            for level, (f, mine) in enumerate(zip(fs, self.stats, strict=True)):
                both = norm[i] + self.norm[rows]
                lower = both - 2 * (mine if level == 0 else mine[rows]) @ f[i]  # squared distance, at least
                if level == 0 and len(rows) > k:
                    # the rows of the least bounds against their norms, exactly: a score to reach
                    first = np.argpartition(lower - both, k - 1)[:k]
                    reach = max(reach, float((self.v[first] @ q[i]).min()))
                # a row of score ``reach`` or more lies at most this far away
                rows = rows[lower <= both - 2 * reach + 1e-9 * both + 1e-6]
            score = self.v[rows] @ q[i]
            top = np.argsort(-score, kind="stable")[:k]
            top = top[score[top] >= reach]
            yield i, rows[top], score[top]


def _meet(rows: DataFrame, k: int, levels: Sequence[int], parts: int) -> DataFrame:
    """``query_id, query, vec_id, own, copies, score``: the ``k`` best rows for each query in each
    tile it is sent to. ``rows``: ``tile, kind`` (0 row, 1 query), ``vec_id, own, v, copies, least``."""

    def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return pc.fill_null(batch.column(name), 0).to_numpy(zero_copy_only=False)

    def scored(batch: pa.RecordBatch, tiles: dict[int, Tile]) -> Iterator[pa.RecordBatch]:
        size = pc.binary_length(batch.column("v")).to_numpy()
        for n in np.unique(size).tolist():
            if n not in tiles:
                continue
            tile = tiles[n]
            step = max(1, (1 << 22) // max(1, len(tile.v) * max(levels)))
            some = np.flatnonzero(size == n)
            for lo in range(0, len(some), step):
                part = batch.take(pa.array(some[lo : lo + step]))
                q = np.frombuffer(b"".join(part.column("v").to_pylist()), "<i4").reshape(part.num_rows, -1).astype(np.int64)
                least = pc.fill_null(part.column("least").cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
                found = list(tile.best(q, least, k, levels))
                of = np.concatenate([np.full(len(r), i) for i, r, _ in found]).astype(np.int64)
                at = np.concatenate([r for _, r, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(of)),
                        part.column("own").take(pa.array(of)),
                        pa.array(tile.vec_id[at], mask=tile.null[at]),
                        pa.array(tile.own[at]),
                        pa.array(tile.copies[at]),
                        pa.array(np.concatenate([s for _, _, s in found])),
                    ],
                    ["query_id", "query", "vec_id", "own", "copies", "score"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tiles, now = [], {}, None
        for batch in batches:
            tile, kind = column(batch, "tile"), column(batch, "kind")
            cut = np.flatnonzero((tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(tile)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if tile[a] != now:
                    held, tiles, now = [], {}, tile[a]
                if kind[a] == 0:
                    held.append(part)
                    continue
                if held:  # the tile is complete
                    all_rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    size = pc.binary_length(all_rows.column("v")).to_numpy()
                    for n in np.unique(size).tolist():
                        some = all_rows.filter(pa.array(size == n))
                        null = np.asarray(pc.is_null(some.column("vec_id")))
                        tiles[n] = Tile(some.column("v").to_pylist(), column(some, "vec_id"), null, column(some, "own"), column(some, "copies"), levels)
                    held = []
                yield from scored(part, tiles)

    sent = rows.repartition(parts, "tile").sortWithinPartitions("tile", "kind")
    return sent.mapInArrow(run, "query_id bigint, query bigint, vec_id bigint, own bigint, copies bigint, score bigint")


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, levels: Sequence[int] = LEVELS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``vec_id, embedding``) whose id
    is divisible by ``every``, the ``k`` other rows of highest inner product, exactly.

    Components are ``floor(256 * x)``; scores are integers; equal scores rank by ascending ``vec_id``
    (NULL last).

    * vectors that are NULL or hold a NULL or non-finite component take no part; an empty
      vector has score 0 with empty ones; vectors of different lengths have no score;
    * a NULL id is a candidate and no query;
    * rows equal in id and vector are each other's candidates, and one query; rows that
      share an id only are queries (and candidates of each other) of their own;
    * an empty table gives an empty one; other columns are not read;
    * a vector of norm 2^31 or more (after scaling) is an error.
    """
    spark = vectors.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, v = whole_vectors(batch.column("embedding"))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(some)), pa.array(v, pa.binary())], ["vec_id", "v"])

    rows = pick(vectors, {"vec_id": "bigint", "embedding": "array<double>"}).mapInArrow(cut, "vec_id bigint, v binary")
    # repeated rows are one, with a count: no tile is filled by them
    rows = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    rows = stored(rows.withColumn("own", F.xxhash64("vec_id", "v")), "vectors")
    n, parts = rows.count(), shuffle_partitions(spark)
    tiles = max(1, math.ceil(n / TILE_ROWS), min(4 * parts, n // MIN_TILE_ROWS))
    home = F.pmod("own", F.lit(tiles))
    least = F.lit(None).cast("bigint")

    def kind(df: DataFrame, number: int) -> DataFrame:
        return df.select("tile", F.lit(number).alias("kind"), "vec_id", "own", "v", "copies", "least")

    dealt = kind(rows.withColumn("tile", home).withColumn("least", least), 0)
    queries = rows.filter(F.col("vec_id") % every == 0)
    near = _meet(dealt.unionByName(kind(queries.withColumn("tile", home).withColumn("least", least), 1)), k + 1, levels, parts)
    near = stored(near, "near-rows")
    # the score of a query's last row at home, if it has as many: it itself is among the rows
    reach = near.groupBy(F.col("query_id").alias("i"), F.col("query").alias("o")).agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c"))
    reach = reach.select("i", "o", F.when(F.col("c") > k, F.col("s")).alias("least"))
    known = queries.join(reach, (F.col("vec_id") == F.col("i")) & (F.col("own") == F.col("o")), "left")
    away = known.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint")))).filter(F.col("tile") != home)
    found = near.unionByName(_meet(dealt.unionByName(kind(away, 1)), k + 1, levels, parts))
    # each copy is a row; more than k + 1 of one never rank
    found = found.withColumn("copy", F.explode(F.expr(f"sequence(1L, least(copies, {k + 1}L))")))
    each = Window.partitionBy("query_id", "query")
    by = [F.desc("score"), F.asc_nulls_last("vec_id"), "own", "copy"]
    found = found.withColumn("place", F.row_number().over(each.orderBy(*by))).filter(F.col("place") <= k + 1)
    # one row is the query's own; where it does not rank, the last place is one too many
    mine = F.coalesce(F.min(F.when(F.col("own") == F.col("query"), F.col("place"))).over(each), F.lit(k + 1))
    found = found.withColumn("mine", mine).filter("place <> mine")
    rank = (F.col("place") - F.when(F.col("place") > F.col("mine"), 1).otherwise(0)).cast("int")
    return found.select("query_id", rank.alias("rank"), "vec_id", "score")


# The components come as FLOAT, so 256 * x is exact in DOUBLE.
ORACLE = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
