"""Ranked lexical search (operator 11): hashed max-sketches and exact rescoring.

A document's impact of a term (a saturating function of its count and of the document's length)
is a whole number below 10^6. The impacts of all its terms are folded into a sketch: each term
falls on one place in each of two rows, and a place keeps the largest impact that fell on it,
rounded up to a byte. For a term of a query the smaller of its two places is at
least the document's impact of it, so looking up all terms of all items of a batch bounds
every score from above without touching the text.

For each batch of items: the documents of the highest bounds are scored exactly, which gives
each item a score to reach; then every document whose bound reaches it for some item is scored
exactly too. What is left out cannot rank. Sketches are a table of their own, some bytes
for each distinct term, and serve all batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.llm.common import pick, slices, stored
from statlake.llm.ngram_join import bitmap_has, bitmap_of
from statlake.llm.terms import LETTERS_DIGITS, Terms

#: places a sketch row has for each distinct term, at least; a row has a power of two of them
PLACES = 4
#: an impact is below 10^6, so this step makes it a byte
STEP = 4096
#: a batch of items ends after so many items or postings (one item is never split)
BATCH_ITEMS, BATCH_POSTINGS = 256, 1 << 16


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times in a document of ``n`` terms (fixed formula)."""
    m = 100 - 25 + (25 * n * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _places(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's place in each of the two rows of a sketch (the second follows the first)."""
    low = np.uint64(width - 1)
    return (h & low).astype(np.int64), (h >> np.uint64(32) & low).astype(np.int64) + width


def sketches(t: Terms, docs: int, total: int) -> tuple[np.ndarray, list[bytes]]:
    """The texts that have terms, and their sketches."""
    order = np.lexsort((t.h, t.owner))
    h, o = t.h[order], t.owner[order]
    start = np.flatnonzero(np.concatenate([[len(h) > 0], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])[: len(h)])
    h, o, tf = h[start], o[start], np.diff(np.append(start, len(order)))
    byte = (-(-impacts(tf, t.n[o], docs, total) // STEP)).astype(np.uint8)
    some, distinct = np.unique(o, return_counts=True)
    width = 1 << np.maximum(6, np.ceil(np.log2(PLACES * np.maximum(distinct, 1)))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(2 * width)])
    at = np.searchsorted(some, o)
    w = width[at].astype(np.uint64) - np.uint64(1)
    out = np.zeros(base[-1], np.uint8)
    np.maximum.at(out, base[at] + (h & w).astype(np.int64), byte)
    np.maximum.at(out, base[at] + width[at] + (h >> np.uint64(32) & w).astype(np.int64), byte)
    return some, [out[a:b].tobytes() for a, b in zip(base[:-1], base[1:], strict=True)]


class Batch:
    """Some items: their distinct terms ``h`` (ascending) and, item after item, postings of
    ``term`` (place in ``h``) and ``weight`` (weight of the term times its occurrences in the item)."""

    def __init__(self, items: list[tuple[int | None, int]], postings: list[list[tuple[int, int]]]):
        self.items = items
        h = np.array([p[0] for ps in postings for p in ps], np.int64).view(np.uint64)
        self.h, self.term = np.unique(h, return_inverse=True)
        self.weight = np.array([p[1] for ps in postings for p in ps], np.int64)
        self.start = np.concatenate([[0], np.cumsum([len(ps) for ps in postings])])[:-1]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document (row) and item: the weighted sum of the values of the item's terms."""
        out = np.zeros((len(values), len(self.items)), np.int64)
        step = max(1, (1 << 21) // max(1, len(self.term)))
        for lo in range(0, len(values), step):
            part = values[lo : lo + step][:, self.term].astype(np.int64) * self.weight
            out[lo : lo + step] = np.add.reduceat(part, self.start, axis=1)
        return out

    def bounds(self, column: pa.Array) -> np.ndarray:
        """Per sketch and item: a number that the score never exceeds."""
        size = pc.binary_length(column).to_numpy()
        out = np.zeros((len(size), len(self.items)), np.int64)
        for n in np.unique(size).tolist():
            some = np.flatnonzero(size == n)
            one, two = _places(self.h, n // 2)
            step = max(1, (1 << 23) // max(n, 2 * len(self.h)))
            for lo in range(0, len(some), step):
                rows = some[lo : lo + step]
                s = np.frombuffer(b"".join(column.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), n)
                out[rows] = self.sums(np.minimum(s[:, one], s[:, two])) * STEP
        return out

    def scores(self, t: Terms, docs: int, total: int) -> np.ndarray:
        """Per text and item: the exact score."""
        at = np.minimum(np.searchsorted(self.h, t.h), len(self.h) - 1)
        hit = self.h[at] == t.h
        code, tf = np.unique(t.owner[hit] * len(self.h) + at[hit], return_counts=True)
        owner, term = code // len(self.h), code % len(self.h)
        out = np.zeros((len(t.n), len(self.items)), np.int64)
        step = max(1, (1 << 21) // len(self.h))
        for lo in range(0, len(t.n), step):
            some = (owner >= lo) & (owner < lo + step)
            value = np.zeros((min(step, len(t.n) - lo), len(self.h)), np.int64)
            value[owner[some] - lo, term[some]] = impacts(tf[some], t.n[owner[some]], docs, total)
            out[lo : lo + step] = self.sums(value)
        return out


class Best:
    """The ``k`` best rows seen for each item: by value, then by id (NULL last)."""

    def __init__(self, k: int, items: int):
        self.k, self.least = k, np.ones(items, np.int64)  # a value must reach ``least``
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]  # item, value, id, whether it is NULL

    def take(self, values: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        doc, item = np.nonzero(values >= self.least)
        new = (item, values[doc, item], ids[doc], null[doc])
        self.rows = [np.concatenate([a, b]) for a, b in zip(self.rows, new, strict=True)]
        if len(self.rows[0]) > 4 * self.k * len(self.least):
            self.cut()

    def cut(self) -> None:
        item, value, ids, null = self.rows
        order = np.lexsort((ids, null, -value, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.rows = [r[order] for r in self.rows]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.least[self.rows[0][last]] = self.rows[1][last]

    def batch(self, name: str, id_name: str) -> pa.RecordBatch:
        self.cut()
        item, value, ids, null = self.rows
        return pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(value)], ["item", id_name, name])


def _query_terms(items: DataFrame) -> DataFrame:
    """``item_id, tie, h, n``: terms of the items, with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, 2 << 20):
                t = Terms(part.column("text"), LETTERS_DIGITS)
                order = np.lexsort((t.h, t.owner))
                h, o = t.h[order], t.owner[order]
                start = np.flatnonzero(np.concatenate([[len(h) > 0], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])[: len(h)])
                of = pa.array(o[start])
                n = pa.array(np.diff(np.append(start, len(h))))
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(of), part.column("tie").take(of), pa.array(h[start].view(np.int64)), n], ["item_id", "tie", "h", "n"])

    return items.mapInArrow(run, "item_id bigint, tie bigint, h bigint, n bigint")


def _statistics(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``kind, h, n``: documents that hold a term (0), documents with terms (1), all terms (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2048, 4 << 20):
                t = Terms(part.column("text"), LETTERS_DIGITS)
                some = np.flatnonzero(bitmap_has(wanted, t.h.view(np.int64)))
                order = some[np.lexsort((t.owner[some], t.h[some]))]
                h, o = t.h[order], t.owner[order]
                first = np.concatenate([[len(h) > 0], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])[: len(h)]
                h, df = np.unique(h[first], return_counts=True)
                kind = np.concatenate([np.zeros(len(h), np.int32), [1, 2]]).astype(np.int32)
                n = np.concatenate([df, [(t.n > 0).sum(), t.n.sum()]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([h.view(np.int64), [0, 0]])), pa.array(n)], ["kind", "h", "n"])

    sent = docs.select("text").mapInArrow(run, "kind int, h bigint, n bigint")
    return stored(sent.groupBy("kind", "h").agg(F.sum("n").alias("n")), "term-statistics")


def sketch_table(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``key, sketch`` of every document that has terms (``docs``: ``key, text``), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, 2 << 20):
                some, made = sketches(Terms(part.column("text"), LETTERS_DIGITS), n_docs, n_terms)
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(some)), pa.array(made, pa.binary())], ["key", "sketch"])

    return stored(docs.select("key", "text").mapInArrow(run, "key bigint, sketch binary"), "sketches", compression="zstd")


def _leaders(table: DataFrame, batch: Batch, k: int) -> DataFrame:
    """``key`` of the ``k`` documents of the highest bounds for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, len(batch.items))
        for part in batches:
            key = part.column("key").to_numpy()
            best.take(batch.bounds(part.column("sketch")), key, np.zeros(len(key), bool))
        yield best.batch("bound", "key")

    found = table.mapInArrow(run, "item bigint, key bigint, bound bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "key"))
    return found.withColumn("place", place).filter(F.col("place") <= k).select("key").distinct()


def _reaching(table: DataFrame, batch: Batch, least: np.ndarray) -> DataFrame:
    """``key`` of all documents whose bound reaches ``least`` for some item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.select(["key"]).filter(pa.array((batch.bounds(part.column("sketch")) >= least).any(axis=1)))

    return table.mapInArrow(run, "key bigint")


def _exact(docs: DataFrame, keys: DataFrame, batch: Batch, k: int, n_docs: int, n_terms: int, least: np.ndarray) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best of the documents of the given keys, of those that reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, len(batch.items))
        best.least = np.maximum(best.least, least)
        for rows in batches:
            for part in slices(rows, "text", 1024, 2 << 20):
                ids = part.column("doc_id")
                scores = batch.scores(Terms(part.column("text"), LETTERS_DIGITS), n_docs, n_terms)
                best.take(scores, pc.fill_null(ids, 0).to_numpy(), np.asarray(pc.is_null(ids)))
        yield best.batch("score", "doc_id")

    some = docs.join(keys, "key", "left_semi").select("doc_id", "text")
    found = some.mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def _batches(terms: DataFrame) -> Iterator[Batch]:
    """Items (``item_id, tie, h, weight``) in batches of bounded size, one after the other."""
    items, postings, size = [], [], 0
    for r in terms.orderBy("item_id", "tie").toLocalIterator():
        if not items or items[-1] != (r.item_id, r.tie):
            if len(items) >= BATCH_ITEMS or size >= BATCH_POSTINGS:
                yield Batch(items, postings)
                items, postings, size = [], [], 0
            items.append((r.item_id, r.tie))
            postings.append([])
        postings[-1].append((r.h, r.weight))
        size += 1
    if items:
        yield Batch(items, postings)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest score above 0 for each item.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased, compared by 64-bit
    hashes. Scores are whole numbers; equal ones rank by ascending ``doc_id`` (NULL last).

    * each row of ``docs`` is a document, so repeated rows rank side by side; NULL and empty texts
      hold no term and do not count;
    * items without a term that some document holds get no rows; rows of ``items`` equal in id and
      text are one item, rows that share an id only are ranked apart;
    * an empty table on either side gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    rows = pick(docs, {"doc_id": "bigint", "text": "string"}).filter("text IS NOT NULL")
    # a hash of the whole row stands for it: should two rows share one, both are scored
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))
    asked = pick(items, {"item_id": "bigint", "text": "string"}).distinct().withColumn("tie", F.xxhash64("text"))
    terms = stored(_query_terms(asked), "query-terms")
    statistics = _statistics(rows, bitmap_of(F.col("h"), terms))
    totals = {r.kind: r.n for r in statistics.filter("kind > 0").collect()}
    n_docs, n_terms = totals.get(1, 0), totals.get(2, 0)
    # the weight of a term (fixed formula), in doubles
    weight = F.floor(1000 * F.log(F.expr(f"({2 * n_docs + 2}D) / (2 * df + 1)"))).cast("bigint") * F.col("n")
    held = statistics.filter("kind = 0").select("h", F.col("n").alias("df"))
    terms = terms.join(held, "h").select("item_id", "tie", "h", weight.alias("weight")).filter("weight > 0")
    results, index = _no_rows(spark), None
    for batch in _batches(stored(terms, "query-weights")):
        if index is None:
            index = sketch_table(rows, n_docs, n_terms)
        args = batch, k, n_docs, n_terms
        none = np.ones(len(batch.items), np.int64)
        first = _exact(rows, stored(_leaders(index, batch, 2 * k), "leaders"), *args, none)
        # the k-th best so far: whatever ranks has at least this score, so its bound reaches it
        least = none.copy()
        for r in first.filter(F.col("rank") == k).select("item", "score").collect():
            least[r.item] = r.score
        found = _exact(rows, stored(_reaching(index, batch, least), "reaching"), *args, least)
        ids = F.lit([i for i, _ in batch.items]).cast("array<bigint>")
        found = found.select(ids[F.col("item").cast("int")].alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        results = results.unionByName(stored(found, "ranked"))
    return results


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents WHERE text IS NOT NULL
), e AS (
    SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d
), size AS (
    SELECT count(*) FILTER (WHERE len(ts) > 0) AS nd, CAST(coalesce(sum(len(ts)), 0) AS BIGINT) AS l FROM d
), tf AS (
    SELECT r, doc_id, n, term, count(*) AS tf FROM e GROUP BY ALL
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM tf, size GROUP BY term, nd
), q AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), q2 AS (
    SELECT item_id, term, count(*) AS c FROM q GROUP BY ALL
), s AS (
    SELECT item_id, r, doc_id,
           CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // l))))) AS BIGINT) AS score
    FROM q2 JOIN tf USING (term) JOIN w USING (term), size
    GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM s WHERE score > 0
) WHERE rank <= 20
"""
