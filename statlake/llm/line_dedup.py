"""Line dedup (operator 10): fuzzy lines, one occurrence kept per connected group.

Lines are normalised (A-Z lower-cased, every other ASCII character but digits and letters a
separator) and counted as sequences of word hashes. Equal sequences are one
class, counted before any shuffle of occurrences.

Classes meet in pigeonhole blocks. If a line of d possible edits has d + 1 n-grams side by side, one of
them is untouched in any line alike. Each line gives its first n-grams, in an order that all lines
have, until there are so many; two lines alike have one of them in common (:func:`line_keys`).

Inside a block the SimHash decides which pairs are compared. Of its 64 bits those whose majority the
allowed edits cannot overturn are firm; two lines that differ in a firm bit of either
cannot be alike. Nor can they if more words differ, by a sketch of 128 parities (in the last comparison also one of 512, in which a
word's second and later places in the line count as words of their own), than edits can change, where lines of different length need some edits that change less.
(With ``max_bits``, lines must also differ in at most so many bits of their SimHashes to count as alike.) What is left is verified by edit similarity over
words and connected through pivots (:mod:`statlake.llm.linking`). Of each group
the first occurrence (by document id, text hash, line number) stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import mix, pick, shuffle_partitions, slices, span_hashes, stored, utf8, word_spans
from statlake.llm.linking import linked_groups
from statlake.llm.ngram_join import bitmap_has, bitmap_of

_MAP = np.arange(256, dtype=np.uint8)
_MAP[:128] = 32
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789\n":
    _MAP[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _MAP[_c] = _c + 32
_P = np.uint64(0xC2B2AE3D27D4EB4F)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))


#: bytes of text taken to words at once; a worker holds about 100 bytes for each
TEXT_BYTES = 1 << 19
#: what a line class shows of its words in a block
LINE_ATTRS = ["sim", "firm", "odd1", "odd2", "words"]
#: parities of numbered words over 512 bits, of classes in blocks only (more would make the join's
#: condition too long a method for the JVM to compile)
BAG_ATTRS = [f"bag{i}" for i in range(8)]


class Lines:
    """Lines of some texts: ``owner`` text, ``number`` in it, ``words``, and the word
    hashes ``h`` with the n+1 offsets ``at`` of the lines in them."""

    def __init__(self, column: pa.Array):
        raw, at = utf8(column)
        raw = _MAP[raw]
        breaks = np.flatnonzero(raw == 10)
        # a text's lines: one more than its line breaks
        starts = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
        per_text = np.searchsorted(breaks, at[1:]) - np.searchsorted(breaks, at[:-1]) + 1
        begin = np.concatenate([[0], np.cumsum(per_text)])
        self.owner = np.repeat(np.arange(len(per_text)), per_text)
        self.number = np.arange(begin[-1]) - begin[:-1][self.owner]
        first, last, _ = word_spans(raw, at)
        self.h = span_hashes(raw, first, last)
        self.at = np.concatenate([np.searchsorted(first, starts), [len(first)]])
        self.words = np.diff(self.at)

    def digests(self) -> np.ndarray:
        """64-bit hash of each line's word sequence."""
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(len(self.h) - 1, 0), _P)]).astype(np.uint64), dtype=np.uint64)
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.h), _P_INV)]).astype(np.uint64), dtype=np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.h) * power[: len(self.h)], dtype=np.uint64)]).astype(np.uint64)
        d = (total[self.at[1:]] - total[self.at[:-1]]) * back[self.at[:-1]]
        return mix(d ^ mix(self.words.astype(np.uint64))).view(np.int64)

    def simhashes(self, chosen: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
        """64-bit SimHash of the chosen lines: per bit, what most words have."""
        return self.firm_simhashes(chosen, np.zeros(len(chosen), np.int64), chunk)[0]

    def firm_simhashes(self, chosen: np.ndarray, edits: np.ndarray, chunk: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """SimHashes of the chosen lines, and which of their bits so many edits leave as they are:
        an edit takes one word and puts another, so it moves a bit's majority by two at most."""
        out, firm = np.zeros(len(chosen), np.uint64), np.zeros(len(chosen), np.uint64)
        size = np.cumsum(self.words[chosen])
        lo = 0
        while lo < len(chosen):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + chunk, side="right")))
            some = chosen[lo:hi]
            n = self.words[some]
            edge = np.concatenate([[0], np.cumsum(n)])
            place = np.repeat(self.at[some] - edge[:-1], n) + np.arange(edge[-1])
            bits = np.unpackbits(mix(self.h[place]).view(np.uint8).reshape(-1, 8), axis=1)
            lead = 2 * np.add.reduceat(bits, edge[:-1], axis=0, dtype=np.int32) - n[:, None]
            most = 2 * edits[lo:hi, None]
            out[lo:hi] = np.packbits(lead > 0, axis=1).reshape(-1).view(np.uint64)
            firm[lo:hi] = np.packbits((lead > most) | (lead <= -most), axis=1).reshape(-1).view(np.uint64)
            lo = hi
        return out, firm


    def odd_words(self, chosen: np.ndarray, columns: int = 2, numbered: bool = False) -> np.ndarray:
        """64 bits in each of so many columns (a power of two) for each chosen line: whether an odd number
        of its words falls on the bit. An edit takes a word and puts another, so it turns two bits at most,
        and a word left out or put in one.

        ``numbered``: of its words with how many like it stand before them, so a bit turns for each place by which two lines'
        counts of a word differ, however often both have it; an edit still takes one and puts one.
        """
        n = self.words[chosen]
        edge = np.concatenate([[0], np.cumsum(n)])
        h = self.h[np.repeat(self.at[chosen] - edge[:-1], n) + np.arange(edge[-1])]
        if numbered and len(h):
            order = np.lexsort((h, np.repeat(np.arange(len(n)), n)))
            run = np.concatenate([[True], h[order][1:] != h[order][:-1]])
            run[edge[:-1][n > 0]] = True
            number = np.empty(len(h), np.uint64)
            number[order] = np.arange(len(h)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            h = mix(h + number * _P)
        bit = np.uint64(1) << (h & np.uint64(63))
        column = h >> np.uint64(6) & np.uint64(columns - 1)
        out = np.zeros((len(chosen), columns), np.uint64)
        for c in range(columns if len(chosen) else 0):
            out[:, c] = np.bitwise_xor.reduceat(np.where(column == c, bit, np.uint64(0)), edge[:-1])
        return out


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance of two word sequences: common ends are cut off, the
    rest is counted bit-parallel (one big integer per column)."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    lo = n if same.all() else int(np.argmin(same))
    a, b, n = a[lo:], b[lo:], n - lo
    same = a[::-1][:n] == b[::-1][:n]
    hi = n if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - hi].tolist(), b[: len(b) - hi].tolist()
    if not a or not b:
        return len(a) or len(b)
    where: dict[int, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for w in b:
        eq = where.get(w, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(across | plus)), plus & across
        score += 1 if up & top else -1 if down & top else 0
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = down | (full & ~((eq | minus) | up)), up & (eq | minus)
    return score


def _occurrences(docs: DataFrame, similarity: float, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, TEXT_BYTES):
                lines = Lines(part.column("text"))
                some = np.flatnonzero(lines.words >= min_words)
                of = pa.array(lines.owner[some])
                sim, firm = lines.firm_simhashes(some, _most_edits(lines.words[some], similarity))
                odd = lines.odd_words(some).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(of),
                        part.column("tie").take(of),
                        pa.array(lines.number[some]),
                        pa.array(lines.digests()[some]),
                        pa.array(sim.view(np.int64)),
                        pa.array(firm.view(np.int64)),
                        pa.array(np.ascontiguousarray(odd[:, 0])),
                        pa.array(np.ascontiguousarray(odd[:, 1])),
                        pa.array(lines.words[some].astype(np.int32)),
                    ],
                    ["doc_id", "tie", "number", "line", "sim", "firm", "odd1", "odd2", "words"],
                )

    return docs.mapInArrow(run, "doc_id bigint, tie bigint, number bigint, line bigint, sim bigint, firm bigint, odd1 bigint, odd2 bigint, words int")


def _word_rows(docs: DataFrame, wanted: np.ndarray, min_words: int) -> DataFrame:
    """``line, seq`` and ``BAG_ATTRS``: word hashes (32 bits each) and parities of lines whose digest may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, TEXT_BYTES):
                lines = Lines(part.column("text"))
                digest = lines.digests()
                some = np.flatnonzero((lines.words >= min_words) & bitmap_has(wanted, digest))
                some = some[np.unique(digest[some], return_index=True)[1]]
                h = (lines.h >> np.uint64(32)).astype("<u4")
                seq = [h[a:b].tobytes() for a, b in zip(lines.at[some], lines.at[some + 1], strict=True)]
                bag = [pa.array(np.ascontiguousarray(c)) for c in lines.odd_words(some, len(BAG_ATTRS), numbered=True).view(np.int64).T]
                yield pa.RecordBatch.from_arrays([pa.array(digest[some]), pa.array(seq, pa.binary()), *bag], ["line", "seq", *BAG_ATTRS])

    return docs.select("text").mapInArrow(run, "line bigint, seq binary, " + ", ".join(f"{c} bigint" for c in BAG_ATTRS))


def max_edits(words: np.ndarray | int, similarity: float) -> np.ndarray:
    """Most edits between two lines of edit similarity ``similarity`` or more, the longer of ``words`` words."""
    return np.floor((1 - similarity) * np.asarray(words) + 1e-9).astype(np.int64)


def _most_edits(words: np.ndarray, similarity: float) -> np.ndarray:
    """Most edits between a line of ``words`` words and any line alike."""
    return max_edits(np.floor(words / similarity + 1e-9), similarity)


def gram_size(similarity: float, min_words: int) -> int:
    """Words in an n-gram: every line has one n-gram more than edits, side by side (1 to 3)."""
    n = np.arange(max(min_words, 1), 1000)
    d = _most_edits(n, similarity)
    return int(np.clip((n // (d + 1))[d > 0].min(initial=3), 1, 3))


def _grams(h: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` words from each place on (the last q - 1 are no n-grams)."""
    s = np.zeros(len(h), np.uint64)
    for j in range(q):
        s = mix(s * _P + np.concatenate([h[j:], np.zeros(min(j, len(h)), np.uint64)]))
    return s


def line_keys(lines: Lines, some: np.ndarray, similarity: float, q: int) -> tuple[np.ndarray, np.ndarray]:
    """The place in ``some`` and the hash of each key of a line: n-grams that lines alike share.

    A line's n-grams are taken in the order of their hashes until one more than its most edits lie side
    by side (or all are taken): so many edits cannot touch them all. Of two lines alike, let one be
    that whose last key comes first in that order: one of its keys is untouched, stands in the other
    line, and before that line's last key, so it is a key of both.
    """
    need = _most_edits(lines.words[some], similarity) + 1
    use = np.flatnonzero((need > 1) & (lines.words[some] >= q))  # the others are alike only if equal
    n = lines.words[some[use]] - q + 1
    edge = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(use)), n)
    gram = _grams(lines.h, q)[lines.at[some[use]][owner] + np.arange(edge[-1]) - edge[:-1][owner]]
    # one number to sort by: the line, then the leading bits of the hash, enough to tell a line's n-grams apart
    bits = np.uint64(max(1, len(use)).bit_length())
    order = np.argsort(owner.astype(np.uint64) << (np.uint64(64) - bits) | gram >> bits)
    # in step for all lines: the next n-gram counts unless it overlaps a counted one
    taken, counted = np.zeros(len(use), np.int64), np.zeros(len(use), np.int64)
    blocked = np.zeros(edge[-1], bool)
    live, r = np.arange(len(use)), 0
    while len(live):
        at = order[edge[live] + r]
        free = ~blocked[at]
        taken[live] += 1
        counted[live] += free
        at, line = at[free], live[free]
        for j in range(1 - q, q):
            blocked[np.clip(at + j, edge[line], edge[line + 1] - 1)] = True
        r += 1
        live = live[(counted[live] < need[use[live]]) & (r < n[live])]
    first = np.arange(edge[-1]) - edge[:-1][owner] < taken[owner]
    return use[owner[first]], gram[order][first]


def line_blocks(docs: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """``key, node``: line classes by their :func:`line_keys`, of keys that another line shares whose number
    of words allows the similarity."""
    q = gram_size(similarity, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, TEXT_BYTES):
                lines = Lines(part.column("text"))
                digest = lines.digests()
                some = np.flatnonzero(lines.words >= max(min_words, q))
                some = some[np.unique(digest[some], return_index=True)[1]]
                of, gram = line_keys(lines, some, similarity, q)
                # 48 bits of the n-gram, 16 of the number of words: rows of two numbers
                size = np.minimum(lines.words[some[of]], 0xFFFF).astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array((gram & ~np.uint64(0xFFFF) | size).view(np.int64)), pa.array(digest[some[of]])], ["gram", "node"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key: np.ndarray, node: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key[keep] >> 16), pa.array(node[keep])], ["key", "node"])

        key, node, met = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:  # sorted: the last row waits for the next, ``met`` if it has its key from the one before
            key = np.concatenate([key, batch.column("gram").to_numpy()])
            node = np.concatenate([node, batch.column("node").to_numpy()])
            if not len(key):
                continue
            again = (key[1:] == key[:-1]) & (node[1:] == node[:-1])
            new = np.concatenate([[True], ~again])
            key, node = key[new], node[new]
            # by number of words within a key: if any line's allows the similarity, the next or the last one's does
            words = key & 0xFFFF
            with_next = np.concatenate([(key[1:] >> 16 == key[:-1] >> 16) & (words[:-1] >= similarity * words[1:] - 1e-6), [False]])
            keep = with_next | np.concatenate([[met], with_next[:-1]])
            yield rows(key[:-1], node[:-1], keep[:-1])
            met, key, node = bool(keep[-1]), key[-1:], node[-1:]
        if met:
            yield rows(key, node, np.ones(1, bool))

    sent = docs.select("text").mapInArrow(run, "gram bigint, node bigint")
    sent = sent.repartition(shuffle_partitions(docs.sparkSession), F.expr("shiftright(gram, 16)")).sortWithinPartitions("gram", "node")
    return stored(sent.mapInArrow(shared, "key bigint, node bigint"), "line-keys")


def line_groups(occurrences: DataFrame, docs: DataFrame, similarity: float, max_bits: int, min_words: int, complete: bool = False) -> DataFrame:
    """``line, label`` of line classes that are linked to others."""
    bits = 64 if complete else max_bits
    keyed = line_blocks(docs, similarity, min_words)
    attrs = occurrences.groupBy(F.col("line").alias("l")).agg(*[F.first(c).alias(c) for c in LINE_ATTRS])
    keyed = stored(keyed.join(attrs, F.col("node") == F.col("l")).select("key", "node", *LINE_ATTRS), "line-blocks")
    sized = f"least(x.words, y.words) >= {similarity} * greatest(x.words, y.words)"
    # the SimHashes agree where edits cannot change them, and no more words differ than edits can change
    edits = f"floor({1 - similarity + 1e-9} * greatest(x.words, y.words))"
    # (so many edits put in or take out a word, which turns one bit)
    longer = "abs(x.words - y.words)"
    differ = f"bit_count(x.odd1 ^ y.odd1) + bit_count(x.odd2 ^ y.odd2) <= 2 * {edits} - {longer}"
    near = f"x.node <> y.node AND (x.sim ^ y.sim) & (x.firm | y.firm) = 0 AND {differ} AND bit_count(x.sim ^ y.sim) <= {bits} AND {sized}"
    # classes with a near one in their block: a semi join stops at the first
    sides = keyed.select("key", F.struct("node", *LINE_ATTRS).alias("x"))
    other = sides.select(F.col("key").alias("k"), F.col("x").alias("y"))
    met = sides.join(other, (F.col("key") == F.col("k")) & F.expr(near), "left_semi")
    blocks = stored(met.select("key", "x.*"), "line-blocks")
    nodes = blocks.select("node").distinct()
    wanted = bitmap_of(F.col("node"), nodes)  # a digest is a hash already
    seqs = _word_rows(docs, wanted, min_words).join(nodes.withColumnRenamed("node", "line"), "line", "left_semi")
    seqs = stored(seqs.groupBy("line").agg(*[F.first(c).alias(c) for c in ("seq", *BAG_ATTRS)]), "line-words")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                u, v = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                ok.append(edit_distance(u, v) <= max_edits(max(len(u), len(v)), similarity))
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = (seqs.select(F.col("line").alias(c), F.col("seq").alias(f"s{c}")) for c in ("a", "b"))
        return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(alike, "a bigint, b bigint")

    # families of a block differ in their SimHashes: pigeonhole parts of 16 bits, one pivot each
    cuts = [f"shiftright(x.sim, {at}) & 65535" for at in (0, 16, 32, 48)]
    differ = " + ".join(f"bit_count(xl.{c} ^ yl.{c})" for c in BAG_ATTRS) + f" <= 2 * {edits} - {longer}"
    late = seqs.select(F.col("line").alias("node"), *BAG_ATTRS)
    return linked_groups(blocks, LINE_ATTRS, near, verify, rounds=3, cuts=cuts, late=late, late_link=differ).withColumnRenamed("node", "line")


def duplicate_lines(docs: DataFrame, similarity: float = 0.9, max_bits: int = 3, min_words: int = 5, complete: bool = False) -> DataFrame:
    """``doc_id, tie, numbers``: the lines (from 0) of each document that repeat a kept one.

    ``tie`` is ``xxhash64`` of the text. Rows equal in id and text are one document here.
    """
    rows = pick(docs, {"doc_id": "bigint", "text": "string"}).withColumn("tie", F.xxhash64("text"))
    found = stored(_occurrences(rows, similarity, min_words), "line-occurrences")
    labels = line_groups(found, rows, similarity, max_bits, min_words, complete)
    labels = labels.select(F.col("line").alias("l"), "label")
    place = F.struct("doc_id", "tie", "number")
    per = found.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    per = per.join(labels, F.col("line") == F.col("l"), "left").withColumn("label", F.coalesce("label", "line"))
    per = stored(per.select("line", "label", "first", "last"), "line-firsts")
    group = per.groupBy("label").agg(F.min("first").alias("kept"), F.max("last").alias("end")).filter("kept <> end")
    several = per.join(group, "label").select(F.col("line").alias("l"), "kept")
    gone = found.join(several, F.col("line") == F.col("l")).filter(place != F.col("kept"))
    return gone.groupBy("doc_id", "tie").agg(F.collect_set("number").alias("numbers"))


def without_duplicate_lines(docs: DataFrame, similarity: float = 0.9, max_bits: int = 3, min_words: int = 5, drop_emptied: bool = False, counts: bool = True, complete: bool = False) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; with ``counts`` further
    columns ``n_lines`` and ``n_removed``.

    Lines of fewer than ``min_words`` words are never removed. A line counts as
    repeated when it is connected, through lines of edit similarity of at least
    ``similarity`` (over words) whose SimHashes differ in at most ``max_bits`` bits, to an
    earlier occurrence anywhere in the table. With ``complete`` lines of that similarity
    are connected whatever their SimHashes.

    * NULL text stays NULL (0 lines); an empty text has one empty line.
    * rows equal in id and text are one document: both keep what either keeps.
    * an empty table gives an empty one; all columns of ``docs`` are kept, and
      ``n_chars``, if there, is set to the new length where lines went.
    * ``drop_emptied``: rows left without any word go (their text stands elsewhere).
    """
    names, gone = docs.columns, duplicate_lines(docs, similarity, max_bits, min_words, complete)
    lower = [n.lower() for n in names]
    find = lambda c: f"c{names.index(c) if c in names else lower.index(c)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = find("doc_id"), find("text")
    gone = gone.select(F.col("doc_id").alias("g_id"), F.col("tie").alias("g_tie"), F.col("numbers").alias("g_numbers"))
    on = plain[doc_id].cast("bigint").eqNullSafe(gone.g_id) & (F.xxhash64(plain[text].cast("string")) == gone.g_tie)
    rows = plain.join(gone, on, "left").withColumn("g_lines", F.split(text, "\n", -1))
    rest = "array_except(sequence(0L, size(g_lines) - 1L), g_numbers)"
    new = F.expr(f"array_join(transform({rest}, i -> g_lines[int(i)]), '\\n')")
    rows = rows.withColumn("g_text", F.when(F.col("g_numbers").isNull(), F.col(text)).otherwise(new))
    if drop_emptied:
        rows = rows.filter("g_numbers IS NULL OR g_text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    out = []
    for i, n in enumerate(names):
        c = f"c{i}"
        if c == text:
            out.append(F.col("g_text").alias(c))
        elif n == "n_chars":
            kind = plain.schema[c].dataType
            out.append(F.when(F.col("g_numbers").isNull(), F.col(c)).otherwise(F.char_length("g_text").cast(kind)).alias(c))
        else:
            out.append(F.col(c))
    if not counts:
        return rows.select(*out).toDF(*names)
    n_lines = F.coalesce(F.size("g_lines"), F.lit(0)).cast("bigint")
    removed = F.coalesce(F.size("g_numbers"), F.lit(0)).cast("bigint")
    more = [F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("bigint"), F.when(F.col("g_numbers").isNull(), 0).otherwise(removed).cast("bigint")]
    return rows.select(*out, *[c.alias(f"g{i}") for i, c in enumerate(more)]).toDF(*names, "n_lines", "n_removed")

