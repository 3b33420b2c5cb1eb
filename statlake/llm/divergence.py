"""Source divergence audit (operator 12): which words, and which other sources, set a source apart.

Per language, terms in enough documents are kept and counted by source. Each source's smoothed
frequencies are held against its language's (the terms it overuses most) and against every
other source's (a divergence summed over all kept terms). All figures are whole numbers.

*Terms.* Within one source a term's value grows with its count there, falls with its count
in the language, and ties go to the earlier UTF-8 text. A term that ``k`` others beat (or equal) in
all three respects cannot be among the first ``k``. Each partition keeps the terms that fewer
than ``k`` others dominate, its skyband; the skybands of a source are merged into one, and
only that is ranked by exact value. A source's terms are never held in one place; what is held is
a skyband, counts and text prefixes of a few terms.

*Pairs.* Most terms of a language do not occur in a given source, so the sum over all kept terms
is put together from terms both sources have (joined), how often each count occurs in a
source (against the other's smoothed zero), and the number of remaining terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import pick, shuffle_partitions, slices, stored, utf8
from statlake.llm.terms import LETTERS, Terms

ONE = 1_000_000_000  # fixed value: frequencies are parts of 10^9
#: rows compared with the skyband at once
BLOCK = 256


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term, summed over a slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2048, 4 << 20):
                t = Terms(part.column("text"), LETTERS)
                if not len(t.h):
                    continue
                code = [part.column(c).dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("lang", "source")]
                group = (code[0] << 32 | code[1])[t.owner]
                order = np.lexsort((t.owner, t.h, group))
                g, h, o = group[order], t.h[order], t.owner[order]
                new = np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
                start = np.flatnonzero(new)
                docs = np.add.reduceat(np.concatenate([[True], o[1:] != o[:-1]]) | new, start, dtype=np.int64)
                first = order[start]
                of = pa.array(t.owner[first])
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(of), part.column("source").take(of), t.strings(first), pa.array(np.diff(np.append(start, len(g)))), pa.array(docs)],
                    ["lang", "source", "term", "n", "docs"],
                )

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def heads(column: pa.Array) -> np.ndarray:
    """The first eight bytes of each term as a number (shorter ones filled with zeros, which no term holds)."""
    raw, at = utf8(column)
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    size, out = np.diff(at), np.zeros(len(at) - 1, np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | np.where(j < size, raw[at[:-1] + j], 0).astype(np.uint64)
    return out


class Skyband:
    """Rows that come in order (count falling, language count rising, term rising): keeps those that fewer
    than ``k`` earlier ones dominate.

    Every row that dominates another comes before it. Of the rows that dominate a row, the first ``k``
    are kept themselves (whatever dominates one of them dominates the row too), so it
    is enough to count among the kept. A grid over the kept (counts of those below each corner) settles
    most rows; the others are compared one by one.
    """

    #: cells of the grid on each side, at most
    CUTS = 64

    def __init__(self, k: int):
        self.k, self.size, self.seen = k, 0, 0
        self.lang = np.zeros(256, np.int64)
        self.head = np.zeros(256, np.uint64)
        self.terms: list[bytes] = []
        self.cut_lang = self.cut_head = self.cells = self.below = None

    def take(self, lang: np.ndarray, head: np.ndarray, terms: pa.Array) -> np.ndarray:
        """Which of the next rows stay."""
        open_ = np.arange(len(lang))
        if self.below is not None:
            i = np.searchsorted(self.cut_lang, lang, side="right")
            j = np.searchsorted(self.cut_head, head, side="right")
            open_ = np.flatnonzero(self.below[i, j] < self.k)
        text = lambda i: terms[i].as_py()
        earlier = self._dominated(lang, head, text, open_, self.lang[: self.size], self.head[: self.size], self.terms.__getitem__)
        inside = self._dominated(lang, head, text, open_, lang, head, text, among=True)
        keep = open_[earlier + inside < self.k]
        need = self.size + len(keep)
        while need > len(self.lang):
            self.lang, self.head = np.concatenate([self.lang, self.lang]), np.concatenate([self.head, self.head])
        self.lang[self.size : need], self.head[self.size : need] = lang[keep], head[keep]
        self.terms += terms.take(pa.array(keep)).to_pylist()
        self._count(need)
        return keep

    def _count(self, need: int) -> None:
        """The grid: ``below[i, j]`` kept rows have a language count of at most cut ``i`` and a head under cut ``j``
        (counted from 1; 0: none)."""
        if need >= 2 * max(self.seen, self.k):
            at = np.linspace(0, need - 1, self.CUTS).astype(np.int64)
            self.cut_lang, self.cut_head = np.unique(np.sort(self.lang[:need])[at]), np.unique(np.sort(self.head[:need])[at])
            self.cells = np.zeros((len(self.cut_lang) + 2, len(self.cut_head) + 2), np.int64)
            self.size, self.seen = 0, need  # all are counted again
        if self.cells is not None and need > self.size:
            new = slice(self.size, need)
            i = np.searchsorted(self.cut_lang, self.lang[new], side="left") + 1
            j = np.searchsorted(self.cut_head, self.head[new], side="right") + 1
            np.add.at(self.cells, (i, j), 1)
            self.below = self.cells.cumsum(axis=0).cumsum(axis=1)
        self.size = need

    @staticmethod
    def _dominated(lang, head, text, some, by_lang, by_head, by_text, among: bool = False) -> np.ndarray:
        """Of the rows ``some``: by how many others each is dominated. Eight bytes decide most
        comparisons of texts; equal ones are compared whole."""
        low = by_lang[None, :] <= lang[some][:, None]
        if among:
            low &= np.arange(len(by_lang))[None, :] < some[:, None]
        out = (low & (by_head[None, :] < head[some][:, None])).sum(axis=1)
        for i, j in np.argwhere(low & (by_head[None, :] == head[some][:, None])).tolist():
            out[i] += by_text(j) < text(some[i].item())
        return out


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """Of each partition and group (``lang, source``) the rows (``term, n, ln`` and more) that fewer than
    ``k`` others of the partition dominate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, None
        for batch in batches:
            code = [batch.column(c).dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
            edge = np.flatnonzero((code[0][1:] != code[0][:-1]) | (code[1][1:] != code[1][:-1])) + 1
            ln, terms = batch.column("ln").to_numpy(), batch.column("term").cast(pa.binary())
            head = heads(batch.column("term"))
            kept = []
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                now = (batch.column("lang")[a].as_py(), batch.column("source")[a].as_py())
                if now != group:
                    group, band = now, Skyband(k)
                for lo in range(a, b, BLOCK):
                    hi = min(lo + BLOCK, b)
                    kept.append(lo + band.take(ln[lo:hi], head[lo:hi], terms.slice(lo, hi - lo)))
            if kept:
                yield batch.take(pa.array(np.concatenate(kept)))

    order = ["lang", "source", F.desc("n"), "ln", "term"]
    return rows.sortWithinPartitions(*order).mapInArrow(run, rows.schema)


def share(n: str) -> str:
    """SQL: the smoothed frequency of a count, in parts of 10^9 (``all`` occurrences of ``kept`` terms).
    Decimals, as 10^9 times a count of a large corpus exceeds 64 bits."""
    return f"(1 + CAST((CAST({n} + 1 AS DECIMAL(20, 0)) * {ONE}BD) div CAST(all + kept AS DECIMAL(20, 0)) AS BIGINT))"


def gap(p: str, q: str) -> str:
    """SQL: ``floor((p - q)^2 / q)``."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def divergence_audit(docs: DataFrame, k: int = 200, min_docs: int = 3) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source's divergence from every other source
    of its language (part ``pair``, all ranks) and its ``k`` most overused terms (part ``term``).

    Terms are runs of letters (A-Z lower-cased) and non-ASCII characters; a language keeps those in at
    least ``min_docs`` of its documents (rows). Equal values rank by UTF-8.

    * NULL text, lang or source count as empty; a source without kept terms has smoothed
      frequencies only, and value 0 towards all others where its language keeps none;
    * a source that is alone in its language has no pairs; repeated rows are documents of their own;
    * an empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    rows = pick(docs, {"text": "string", "lang": "string", "source": "string"}).na.fill("")
    group = ["lang", "source"]
    counts = count_terms(rows).groupBy(*group, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # one row a source here, so a window holds no more than a language has sources
    word = Window.partitionBy("lang", "term")
    counts = counts.select(
        *group, "term", "n", F.sum("n").over(word).alias("ln"), F.sum("docs").over(word).alias("df"),
        (F.row_number().over(word.orderBy("source")) == 1).alias("lead"),
    )
    counts = stored(counts.filter(F.col("df") >= min_docs).drop("df"), "term-counts")

    langs = counts.groupBy("lang").agg(F.sum("n").alias("la"), F.count_if("lead").alias("lk"))
    have = counts.groupBy(*group).agg(F.sum("n").alias("ga"), F.count(F.lit(1)).alias("held"))
    groups = rows.select(*group).distinct().join(have, group, "left").join(langs, "lang", "left")
    number = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    groups = groups.select(*group, number("ga").alias("all"), number("held").alias("held"), number("la").alias("la"), number("lk").alias("kept"))
    # p0: of a term that does not occur; any figure does where a language keeps no term
    p0 = F.expr(f"CASE WHEN kept > 0 THEN {share('0L')} ELSE 1L END")
    groups = stored(groups.withColumn("p0", p0), "term-groups")

    facts = counts.join(groups, group).withColumn("p", F.expr(share("n")))
    facts = facts.withColumn("all", F.col("la")).withColumn("q", F.expr(share("ln")))
    facts = stored(facts.select(*group, "term", "n", "ln", "p", "q", "p0"), "term-shares")

    over = facts.filter("p > q").select(*group, "term", "n", "ln", "p", "q")
    band = skyband(over, k).repartition(shuffle_partitions(spark), *group)
    value = F.expr(gap("p", "q"))
    terms = skyband(band, k).select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    pairs = _pairs(facts, groups).select(*group, F.lit("pair").alias("part"), "item", "value")
    ranked = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)


def _pairs(facts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of each two sources of a language.

    ``f(p, q)`` is summed as if no term were in both, then corrected for those that are.
    """

    def both_ways(df: DataFrame, there: str, back: str) -> DataFrame:
        """Rows ``lang, source, other`` with a part of the value each way."""
        way = F.explode(F.expr(f"array(struct(source, other AS item, {there} AS value), struct(other AS source, source AS item, {back} AS value))"))
        return df.select("lang", way.alias("w")).select("lang", "w.source", "w.item", "w.value")

    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("r0"), F.col("held").alias("rheld"))
    # terms of a source, all of one count at once, against the other's smoothed zero
    counts = facts.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("c"))
    single = counts.join(other, "lang").filter("source <> other").groupBy("lang", "source", "other")
    single = single.agg(F.expr(f"sum(c * {gap('p', 'r0')})").alias("there"), F.expr(f"sum(c * {gap('r0', 'p')})").alias("back"))
    # terms that neither has
    none = groups.join(other, "lang").filter("source <> other")
    none = none.select("lang", "source", F.col("other").alias("item"), F.expr(f"(kept - held - rheld) * {gap('p0', 'r0')}").alias("value"))
    # terms that both have: right, less what was counted above
    a, b = facts.alias("a"), facts.alias("b")
    same = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source"))

    def fix(p: str, p0: str, q: str, q0: str) -> str:
        return f"sum({gap(p, q)} - {gap(p, q0)} - {gap(p0, q)} + {gap(p0, q0)})"

    shared = a.join(b, same).groupBy(F.col("a.lang"), F.col("a.source"), F.col("b.source").alias("other")).agg(
        F.expr(fix("a.p", "a.p0", "b.p", "b.p0")).alias("there"), F.expr(fix("b.p", "b.p0", "a.p", "a.p0")).alias("back")
    )
    parts = both_ways(single, "there", "back").unionByName(both_ways(shared, "there", "back")).unionByName(none)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), t AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS ln FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), size AS (
    SELECT lang, count(*) AS v, sum(ln) AS n FROM kept GROUP BY lang
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL
), groups AS (
    SELECT DISTINCT lang, source FROM d
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.ln, s.v, s.n AS all_lang
    FROM groups g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN counted c USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (ln + 1)) // (all_lang + v)::HUGEINT AS q
    FROM dense
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
