"""N-gram Jaccard join (operator 3): vertical partitioning of a global n-gram order.

All n-grams are put in one global order, frequent ones last (frequency classes
of a counting sketch over the whole corpus), and by hash within a class. Each
document's set of n-grams is sorted by it.

* Candidates: two sets with Jaccard >= t share one of the first
  ``n - ceil(t n) + 1`` n-grams of each, so these prefixes are indexed, and the positions
  of a shared n-gram bound the overlap still possible.
* Counting: the order is cut into fragments. Each candidate's set is stored
  as one sorted piece per fragment; per pair the overlaps of the pieces are counted
  separately and summed.

Equal sets are one class from the start; near copies are joined through pivots
(:mod:`statlake.llm.linking`). N-grams and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import mix, pick, shuffle_partitions, slices, span_hashes, stored, utf8, word_spans
from statlake.llm.linking import linked_groups
from statlake.session import scratch_dir

SKETCH_BITS, SLICE_BITS = 23, 17
#: bytes of text cut into n-grams at once; a worker holds about 100 bytes for each
TEXT_BYTES = 1 << 19
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_P = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed ``k``-word shingles of each text (A-Z lower-cased), text by
    text and ascending, and the n+1 offsets. Fewer than ``k`` words: all of
    them as one shingle; no word: nothing."""
    raw, at = utf8(column)
    raw = _LOWER[raw]
    first, last, heads = word_spans(raw, at)
    h = span_hashes(raw, first, last)
    n = np.diff(heads)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    begin = np.concatenate([[0], np.cumsum(count)])
    place = heads[:-1][owner] + np.arange(begin[-1]) - begin[:-1][owner]
    width = np.minimum(n, k)[owner]
    s = np.zeros(len(place), np.uint64)
    for j in range(k):
        more = width > j
        s = np.where(more, mix(s * _P + h[np.minimum(place + j, max(len(h) - 1, 0))]), s) if len(h) else s
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[new], owner[new]
    return s, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])


def _digests(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit digest for each set (0 for an empty one)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s), dtype=np.uint64)])
    n = np.diff(at).astype(np.uint64)
    return np.where(n > 0, mix((total[at[1:]] - total[at[:-1]]) ^ mix(n)), np.uint64(0)).view(np.int64)


def _bucket(s: np.ndarray, bits: int) -> np.ndarray:
    return (mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(64 - bits)).astype(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], k: int, max_bytes: int = TEXT_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, "text", 1024, max_bytes):
            yield part, *shingle_sets(part.column("text"), k)


def _counted(docs: DataFrame, k: int) -> str:
    """Write each document's set size and digest, and the n-gram count sketch in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int32)  # of one task's split
        names = ["kind", "doc_id", "n", "node", "slice", "counts"]
        for part, s, at in _sets(batches, k):
            np.add.at(sketch, _bucket(s, SKETCH_BITS), 1)
            rows = part.num_rows
            nulls = pa.nulls(rows, pa.int64())
            columns = [pa.array(["docs"] * rows), part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(_digests(s, at))]
            yield pa.RecordBatch.from_arrays([*columns, nulls, pa.nulls(rows, pa.binary())], names)
        cut, pack = sketch.reshape(-1, 1 << SLICE_BITS), zstandard.ZstdCompressor(level=1)
        nulls = pa.nulls(len(cut), pa.int64())
        blobs = pa.array([pack.compress(c.astype("<u2" if c.max() < 1 << 16 else "<i8").tobytes()) for c in cut], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(["sketch"] * len(cut)), nulls, nulls, nulls, pa.array(np.arange(len(cut))), blobs], names)

    path = scratch_dir(docs.sparkSession, "ngram-sets")
    rows = docs.mapInArrow(run, "kind string, doc_id bigint, n bigint, node bigint, slice bigint, counts binary")
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return path


def _classes(slices_: DataFrame, grams: int) -> np.ndarray:
    """Frequency class of each sketch bucket, from the number of all ``grams``: 0 for
    what a bucket of rare n-grams holds (the mean and three standard deviations above),
    one more with each doubling over the mean. 2^23 bytes, whatever the corpus."""
    width, mean = 1 << SLICE_BITS, grams / (1 << SKETCH_BITS)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, blob in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                raw = unpack.decompress(blob)
                c = np.frombuffer(raw, "<u2" if len(raw) == 2 * width else "<i8").astype(np.int64)
                held[i] = held[i] + c if i in held else c
        for i, c in held.items():
            rare = c <= mean + 3 * np.sqrt(mean) + 2
            found = np.where(rare, 0, 1 + np.log2(np.maximum(c / (mean + 2), 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([found.tobytes()], pa.binary())], ["slice", "classes"])

    parts = 1 << (SKETCH_BITS - SLICE_BITS)
    found = slices_.repartition(parts, "slice").mapInArrow(total, "slice bigint, classes binary")
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in found.collect():  # one row of 2^17 bytes for each slice
        classes[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["classes"], np.uint8)
    return classes


def _have_partner(rows: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of blocks (``key, n, pos``, sorted by key) may link with another of
    their block: with ``r = n - pos`` n-grams left, x and y need
    ``(100 + t) min(r_x, r_y) >= t (n_x + n_y)``. Exact, without comparing all pairs."""
    t, n = percent, rows["n"].astype(np.int64)
    r = n - rows["pos"].astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1], [True]]))
    size = np.diff(edge)
    out = np.zeros(len(rows), bool)
    two = edge[:-1][size == 2]
    out[two] = (100 + t) * np.minimum(r[two], r[two + 1]) >= t * (n[two] + n[two + 1])
    out[two + 1] = out[two]
    for a, m in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        # y is short enough for x, and the best of those leaves enough: prefix maxima by length
        order = a + np.argsort(n[a : a + m], kind="stable")
        length, left = n[order], (100 + t) * r[order] - t * n[order]
        best = np.maximum.accumulate(left)
        holder = np.maximum.accumulate(np.where(left == best, np.arange(m), 0))
        # the best of all but the holder: the second largest so far
        second = np.full(m, np.iinfo(np.int64).min)
        second[1:] = np.minimum(best[:-1], left[1:])
        second = np.maximum.accumulate(second)
        short = np.searchsorted(length, ((100 + t) * r[order] - t * length) // t, side="right") - 1
        some = short >= 0
        at = np.maximum(short, 0)
        other = np.where(holder[at] == np.arange(m), second[at], best[at])
        out[order] = some & (other >= t * length)
    return out


_PACKED = ("nodes", "lengths", "keys", "of", "pos")


def _prefixes(docs: DataFrame, k: int, percent: int, classes: np.ndarray, parts: int) -> DataFrame:
    """Indexed n-grams that at least two sets share which may link by it: ``key, node, n, pos``.

    Tasks send packed arrays, one for each range of n-gram hashes, so the shuffle
    moves few rows; a range is sorted once where it arrives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, s, at in _sets(batches, k, 2 * TEXT_BYTES):  # a slice sends one row for each range
            n = np.diff(at)
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((s, classes[_bucket(s, SKETCH_BITS)], owner))
            pos = np.arange(len(s)) - at[:-1][owner]
            need = -(-percent * n // 100)
            front = pos < (n - need + 1)[owner]
            key, of, pos = s[order][front], owner[front], pos[front]
            nodes, number = np.unique(_digests(s, at), return_inverse=True)  # copies in this batch count once
            length = np.zeros(len(nodes), "<i4")
            length[number] = n
            of = number[of]
            order = np.lexsort((of, key))
            key, of, pos = key[order], of[order], pos[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
            key, of, pos = key[new], of[new], pos[new]
            part = (key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            edge = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()
            # per range: which nodes occur, and for each n-gram its node's place among them
            blobs = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                here, local = np.unique(of[a:b], return_inverse=True)
                blobs.append((nodes[here].tobytes(), length[here].tobytes(), key[a:b].tobytes(), local.astype("<u2").tobytes(), pos[a:b].astype("<u4").tobytes()))
            some = [i for i, b in enumerate(blobs) if b[2]]
            columns = [pa.array([blobs[i][j] for i in some], pa.binary()) for j in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *columns], ["part", *_PACKED])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _PACKED), strict=True):
                node, length, key, of, pos = (np.frombuffer(b, t) for b, t in zip(row, ("<i8", "<i4", "<u8", "<u2", "<u4"), strict=True))
                found = np.empty(len(key), dtype=[("key", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<u4")])
                found["key"], found["node"], found["n"], found["pos"] = key, node[of], length[of], pos
                held.append(found)
        if not held:
            return
        key = np.concatenate([h["key"] for h in held])
        order = np.argsort(key, kind="stable")
        key = key[order]
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        again[:-1] |= again[1:]
        rows = np.unique(np.concatenate(held)[order[again]])  # copies from several tasks count once
        more = np.zeros(len(rows), bool)
        more[1:] = rows["key"][1:] == rows["key"][:-1]
        more[:-1] |= more[1:]
        rows = rows[more]
        rows = rows[_have_partner(rows, percent)]
        for lo in range(0, len(rows), 1 << 16):
            r = rows[lo : lo + (1 << 16)]
            columns = [pa.array(r["key"].view(np.int64)), pa.array(r["node"]), pa.array(r["n"].astype(np.int64)), pa.array(r["pos"].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "pos"])

    sent = docs.mapInArrow(run, "part bigint, " + ", ".join(f"{c} binary" for c in _PACKED)).repartition(parts, "part")
    return sent.mapInArrow(group, "key bigint, node bigint, n bigint, pos bigint")


def bitmap_of(hashed: Column, keys: DataFrame, bits: int = 24) -> np.ndarray:
    """Bits set for the keys' 64-bit hashes: 2^bits bits, whatever the number of rows.

    A filter with false positives only; what passes is joined exactly after.
    """
    h = F.pmod(hashed, F.lit(1 << bits)) + 1  # the functions count from 1
    per = keys.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("m"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in per.collect():  # at most 2^bits / 32768 rows of 4 KB
        lo = (row["b"] - 1) * 4096
        out[lo : lo + 4096] = np.frombuffer(row["m"], np.uint8)
    return out


def bitmap_has(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes are in the bitmap."""
    i = np.mod(hashed, np.int64(len(bitmap) * 8))
    return (bitmap[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1


_SKIP = np.uint64((1 << 40) - 1)


def _base(cut: np.ndarray, cuts: int) -> np.ndarray:
    """The least 48 bits of a hash in each fragment (0 in the last, of frequent n-grams)."""
    return np.where(cut < cuts - 1, -(-(cut << 24) // max(cuts - 1, 1)) << 24, 0).astype(np.uint64)


def packed(v: np.ndarray, slot: np.ndarray, slots: int, cuts: int) -> list[bytes]:
    """Each slot's ascending 48-bit numbers as bytes (slot by slot, a set's ``cuts`` fragments in turn).

    After a first byte 5 the gaps, the first from the fragment's least hash, in 5 bytes each; a
    number of all ones is a step of so much that ends at no n-gram. Where that is longer, after a 6 the numbers in 6 bytes.
    """
    n = np.bincount(slot, minlength=slots)
    begin = np.concatenate([[0], np.cumsum(n)])
    gap = v.copy()
    gap[1:] -= v[:-1]
    head = begin[:-1][n > 0]
    gap[head] = v[head] - _base(slot[head] % cuts, cuts)
    skips = (gap // _SKIP).astype(np.int64)
    rows = np.concatenate([[0], np.cumsum(skips + 1)])
    codes = np.full(rows[-1], _SKIP, np.uint64)
    codes[rows[1:] - 1] = gap % _SKIP
    short = codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    plain = v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    at = rows[begin].tolist()
    return [
        b"\x05" + short[5 * a : 5 * b] if 5 * (b - a) <= 6 * (j - i) else b"\x06" + plain[6 * i : 6 * j]
        for a, b, i, j in zip(at[:-1], at[1:], begin[:-1].tolist(), begin[1:].tolist(), strict=True)
    ]


def unpacked(pieces: list[bytes]) -> list[np.ndarray]:
    """The numbers of one set's pieces (:func:`packed`)."""
    out, base = [], _base(np.arange(len(pieces)), len(pieces))
    for start, p in zip(base, pieces, strict=True):
        v = np.zeros(((len(p) - 1) // p[0], 8), np.uint8)
        v[:, : p[0]] = np.frombuffer(p, np.uint8, offset=1).reshape(-1, p[0])
        v = v.view("<u8").reshape(-1)
        out.append((start + np.cumsum(v, dtype=np.uint64))[v != _SKIP] if p[0] == 5 else v)
    return out


def _fragments(docs: DataFrame, wanted: np.ndarray, k: int, classes: np.ndarray, cuts: int) -> DataFrame:
    """``node, grams``: the sets of documents (``text, h``) whose hash ``h`` may be
    wanted, cut into one piece for each fragment of the global order; the first 48 bits
    of each hash, :func:`packed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (b.filter(pa.array(bitmap_has(wanted, b.column("h").to_numpy()))) for b in batches)
        for part, s, at in _sets(some, k):
            node = _digests(s, at)
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            # the last fragment holds all frequent n-grams, the others equal ranges of hashes
            cut = np.where(classes[_bucket(s, SKETCH_BITS)] > 0, cuts - 1, (s >> np.uint64(40)).astype(np.int64) * (cuts - 1) >> 24)
            slot = owner * cuts + cut
            order = np.argsort(slot, kind="stable")  # hashes stay ascending within a slot
            pieces = pa.array(packed(s[order] >> np.uint64(16), slot[order], len(node) * cuts, cuts), pa.binary())
            grams = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1, dtype=np.int32) * cuts), pieces)
            yield pa.RecordBatch.from_arrays([pa.array(node), grams], ["node", "grams"])

    return docs.mapInArrow(run, "node bigint, grams array<binary>")


def linked(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> bool:
    """Whether ``100 * |intersection| >= percent * |union|``: overlaps are counted
    fragment by fragment and summed, until those left cannot suffice."""
    left_x, left_y = sum(map(len, x)), sum(map(len, y))
    need = -(-percent * (left_x + left_y) // (100 + percent))
    overlap = 0
    for u, v in zip(x, y, strict=True):
        left_x, left_y = left_x - len(u), left_y - len(v)
        at = np.minimum(np.searchsorted(v, u), max(len(v) - 1, 0))
        overlap += int((v[at] == u).sum()) if len(v) else 0
        if overlap + min(left_x, left_y) < need:
            return False
    return overlap >= need


def _tile_links(held: dict[int, list[np.ndarray]], pairs: list[tuple[int, int]], percent: int, tries: int = 8, rounds: int = 4) -> list[tuple[int, int]]:
    """Links that connect the same sets of a tile as all its linked pairs do, and some
    more between sets that are here anyway.

    Pairs that hang together already are not compared. Then sets outside the
    largest group are tried on a few of its members (or, where nothing is linked, on
    another set), so that a family of near copies mostly hangs together after its first
    round and few of its pairs have to be met again.
    """
    parent = {n: n for n in held}
    found = []

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    def tried(a: int, b: int) -> bool:
        if root(a) != root(b) and linked(held[a], held[b], percent):
            parent[root(a)] = root(b)
            found.append((a, b))
        return root(a) == root(b)

    for a, b in pairs:
        tried(a, b)
    nodes = list(held)
    for r in range(rounds if len(nodes) > 2 else 0):
        groups: dict[int, list[int]] = {}
        for n in nodes:
            groups.setdefault(root(n), []).append(n)
        most = max(groups.values(), key=len)
        if len(most) == 1:
            most = [nodes[r * 7919 % len(nodes)]]
        some = [most[(r * tries + i) * 7919 % len(most)] for i in range(min(tries, len(most)))]
        own = root(most[0])
        for group in groups.values():
            if root(group[0]) != own:
                any(tried(n, m) for n in group[:tries] for m in some)
                own = root(most[0])
    return found


TILE_GRAMS = 1 << 19


def _verified(pairs: DataFrame, pieces: DataFrame, percent: int) -> DataFrame:
    """The linked pairs, counted in tiles: the pairs met in one block, split by hashes
    of both nodes so that a tile's sets stay bounded. A set moves once to each tile
    that needs it, not once for each pair."""
    parts = shuffle_partitions(pairs.sparkSession)
    ends = pairs.selectExpr("key", "a AS node", "x.n AS n").unionByName(pairs.selectExpr("key", "b AS node", "y.n AS n"))
    size = ends.distinct().groupBy(F.col("key").alias("k")).agg(F.ceil(F.sum("n") / TILE_GRAMS).alias("cuts"))
    chunk = lambda node: F.pmod(F.xxhash64(node), F.col("cuts"))
    tile = F.xxhash64("key", chunk("a"), chunk("b")).alias("tile")
    tiled = stored(pairs.join(size, F.col("key") == F.col("k")).select("a", "b", tile), "tiles")
    needs = tiled.selectExpr("tile", "a AS need").unionByName(tiled.selectExpr("tile", "b AS need")).distinct()
    sets = needs.join(pieces, F.col("need") == F.col("node")).select("tile", F.col("node").alias("a"), F.lit(None).cast("bigint").alias("b"), "grams")
    rows = sets.unionByName(tiled.withColumn("grams", F.lit(None).cast("array<binary>")))
    rows = rows.repartition(parts, "tile").sortWithinPartitions("tile", F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def as_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64()) for j in (0, 1)], ["a", "b"])

        now, held, met = None, {}, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("tile", "a", "b"))
            for i, (tile, a, b) in enumerate(zip(*columns, strict=True)):
                if tile != now:
                    yield as_batch(_tile_links(held, met, percent))
                    now, held, met = tile, {}, []
                if b is None:  # a tile's sets stand before its pairs
                    held[a] = unpacked(batch.column("grams")[i].as_py())
                else:
                    met.append((a, b))
        yield as_batch(_tile_links(held, met, percent))

    return rows.select("tile", "a", "b", "grams").mapInArrow(run, "a bigint, b bigint")


def _by_node(sets: DataFrame) -> DataFrame:
    """``sets`` as a table in shared storage, bucketed by ``node``: joins on it move the
    other side only."""
    spark, name = sets.sparkSession, f"ngram_sets_{uuid.uuid4().hex}"
    n = shuffle_partitions(spark)
    rows = sets.repartition(n, "node").write.bucketBy(n, "node").sortBy("node")
    rows.option("path", scratch_dir(spark, "ngram-fragments")).saveAsTable(name)
    return spark.table(name)


def jaccard_groups(docs: DataFrame, k: int = 5, percent: int = 80, fragments: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of
    their sets of distinct ``k``-word shingles (A-Z lower-cased); ``component_id``
    is the smallest ``doc_id`` reachable by links, the document's own included.

    * NULL, empty or blank text: an empty set, linked with nothing, but rows
      of one such document id still share it; fewer than ``k`` words: one shingle of all words.
    * equal sets are linked; repeated rows are each returned; NULL ids are
      ignored as smallest ids (a group of NULL ids only has component NULL).
    * an empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = pick(docs, {"doc_id": "bigint", "text": "string"})
    path = _counted(rows, k)
    thin = spark.read.schema("doc_id bigint, n bigint, node bigint, kind string").parquet(path).filter("kind = 'docs'").drop("kind")
    grams = thin.agg(F.sum("n")).first()[0] or 0
    classes = _classes(spark.read.schema("slice bigint, counts binary").parquet(f"{path}/kind=sketch"), grams)
    blocks = stored(_prefixes(rows, k, percent, classes, shuffle_partitions(spark)), "ngram-prefixes")
    firsts = thin.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    in_blocks = blocks.select("node").distinct()
    # the document that stands for each candidate set; its text is cut again
    stands = stored(in_blocks.join(firsts, "node").select("node", F.col("first").alias("doc_id")), "ngram-candidates")
    wanted = bitmap_of(F.xxhash64("doc_id"), stands)
    texts = rows.select("text", F.xxhash64("doc_id").alias("h"))
    pieces = _fragments(texts, wanted, k, classes, fragments).join(stands.select("node"), "node", "left_semi")
    pieces = _by_node(pieces.groupBy("node").agg(F.first("grams").alias("grams")))

    # overlap o of sets x, y links when (100 + t) o >= t (|x| + |y|)
    left = f"{100 + percent} * least(x.n - x.pos, y.n - y.pos) >= {percent} * (x.n + y.n)"
    labels = linked_groups(blocks, ["n", "pos"], left, lambda pairs: _verified(pairs, pieces, percent), rounds=1)
    named = thin.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "label", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less near copies: of each group the smallest id stays.

    All columns are kept. Rows that share the smallest id all stay, as do rows without an id.
    """
    names = docs.columns
    lower = [n.lower() for n in names]
    at = names.index("doc_id") if "doc_id" in names else lower.index("doc_id")
    gone = jaccard_groups(docs, k, percent).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.join(gone, F.col(f"c{at}") == F.col("gone"), "left_anti").toDF(*names)
