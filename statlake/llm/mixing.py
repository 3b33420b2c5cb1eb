"""Mixing sources to target weights (operator 2): pivotal dependent rounding.

Each source gets a target number of words; target / source size is the copy
rate of its documents: a whole number of copies for all, and a fraction that
is a copy probability. Probabilities are rounded in pairs: words move from one document
to the other until one probability is 0 or 1, upwards or downwards at odds
that keep every expectation. The words of a source thus stay the same at each step.

The work is a reduction tree. A source's documents are dealt by hash to leaves of
about ``leaf`` documents, so a source that holds a third of all rows is many
leaves. A leaf settles all but a bounded remainder (its last fraction and its
smallest documents), and ``fan`` remainders meet in the next node. At a
source's root the largest open document is rounded against all smaller open
ones together, down to the smallest, so the total misses the target by the words
of one document at most, mostly a small one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import WORD, pick, stored

_STATE = "doc_id bigint, source string, size bigint, n bigint, sid bigint, leaf bigint, whole bigint, p double"


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """``source, source_size, target, n_docs, sid`` for rows ``source, size, n``.

    Sources in code-point order (NULL last) weigh ``weights``, repeating. The
    targets share all words by weight, but stop at ``cap`` times the source's
    size, the excess being shared again until none is above: the target is
    ``min(cap * size, level * weight)`` for the one level at which they add up.
    """
    per = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum((F.col("size") > 0).cast("bigint")).alias("n_docs"),
    )
    # one row for each source from here on
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("sid").cast("int") % len(weights) + 1)
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint") - 1)
    per = per.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(every) - before) / weight_left)
    # the level rises while sources that it would overfill are taken out, and falls after
    level = F.max("level").over(every)
    return per.select("source", "source_size", F.least("limit", level * F.col("weight")).alias("target"), "n_docs", "sid")


def _duel(p: np.ndarray, a: np.ndarray, i: int, j: int, u: float) -> None:
    """Move words between documents i and j until one of them is 0 or 1."""
    i_gains, j_loses = a[i] * (1 - p[i]), a[j] * p[j]
    i_loses, j_gains = a[i] * p[i], a[j] * (1 - p[j])
    up, down = min(i_gains, j_loses), min(i_loses, j_gains)
    if u * (up + down) < down:
        p[i], p[j] = (1.0 if up == i_gains else p[i] + up / a[i]), (0.0 if up == j_loses else p[j] - up / a[j])
    else:
        p[i], p[j] = (0.0 if down == i_loses else p[i] - down / a[i]), (1.0 if down == j_gains else p[j] + down / a[j])


def _open(p: np.ndarray, i: int) -> bool:
    return 0.0 < p[i] < 1.0


def settle(a: np.ndarray, p: np.ndarray, rng: np.random.Generator, root: bool) -> np.ndarray:
    """Round ``p`` (documents of ``a`` words, largest first) in pairs.

    Below the root the smallest documents, at most a 64th of them, stay open
    beside the last fraction. At the root all are rounded.
    """
    p, n = p.copy(), len(p)
    slack = np.cumsum((a * np.minimum(p, 1 - p))[::-1])  # what the smallest documents can take up
    keep = int(np.searchsorted(slack, 4 * a[0])) + 1
    keep = min(keep, n) if root else min(keep, max(16, n // 64))
    order, draw = rng.permutation(n - keep), rng.random(2 * n)
    held, used = -1, 0
    for j in order.tolist():
        if held >= 0:
            _duel(p, a, held, j, draw[used])
            used += 1
        held = held if held >= 0 and _open(p, held) else (j if _open(p, j) else -1)
    if not root:
        return p
    left = [i for i in range(n) if _open(p, i)]  # largest first
    while left:
        i, rest = left[0], left[1:]
        u = rng.random()
        if not rest:
            p[i] = 1.0 if u < p[i] else 0.0
            break
        # document i against all smaller open ones, which move by the same share
        words, least, most = a[rest].sum(), p[rest].min(), p[rest].max()
        gain, loss = a[i] * (1 - p[i]), a[i] * p[i]
        up, down = min(gain, words * least), min(loss, words * (1 - most))
        if u * (up + down) < down:
            p[rest] -= up / words
            p[i] = 1.0 if up == gain else p[i] + up / a[i]
        else:
            p[rest] += down / words
            p[i] = 0.0 if down == loss else p[i] - down / a[i]
        p[rest] = np.where(p[rest] < 1e-12, 0.0, np.where(p[rest] > 1 - 1e-12, 1.0, p[rest]))
        left = [k for k in left if _open(p, k)]
    return p


def _node(seed: int, level: int, root: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def node(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "size", "n"], kind="stable")
        words = (g["size"] * g["n"]).to_numpy(np.float64)
        order = np.argsort(-words, kind="stable")
        g = g.iloc[order]
        rng = np.random.default_rng([seed, level, int(g["sid"].iloc[0]), int(g["leaf"].iloc[0])])
        return g.assign(p=settle(words[order], g["p"].to_numpy(), rng, root))

    return node


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3.0,
    seed: int = 0,
    leaf: int = 4096,
    fan: int = 64,
) -> DataFrame:
    """How often the mix takes each document: one row per distinct ``(doc_id,
    source, size)`` with ``n`` (its rows), ``source_size, target, copies``.

    * size is the number of words of the whole text; NULL or empty text: 0 words, never taken.
    * rows that agree in id, source and size are one item of ``n`` times the
      words and get the same copies; NULL ids and sources are values like others.
    * no document gets more than ``ceil(cap)`` copies; reruns agree (the
      draws depend on ``seed`` and the documents alone).
    * an empty table gives an empty table; other columns are ignored.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    sized = pick(docs, {"doc_id": "bigint", "text": "string", "source": "string"}).select("doc_id", "source", size.alias("size"))
    sized = stored(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = stored(source_targets(sized, weights, cap), "mix-targets")
    t = targets.withColumnRenamed("source", "s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # rates within rounding error of a whole number are whole
    whole = F.floor(rate + F.lit(1e-12)).cast("bigint")
    rows = sized.join(t, sized.source.eqNullSafe(t.s)).withColumn("whole", whole)
    p = F.greatest(rate - F.col("whole"), F.lit(0.0))
    rows = rows.withColumn("p", F.when((F.col("size") == 0) | (p < 1e-12), 0.0).otherwise(p))
    nodes = F.ceil(F.col("n_docs") / F.lit(float(leaf)))
    key = F.xxhash64(F.lit(seed), "doc_id", "size", "n")
    rows = rows.withColumn("leaf", F.when(F.col("p") > 0, F.pmod(key, F.greatest(nodes, F.lit(1)))).otherwise(-1))
    state = rows.selectExpr("doc_id", "source", "size", "n", "sid", "cast(leaf as bigint) leaf", "whole", "p")

    most = targets.agg(F.max("n_docs")).first()[0] or 0
    nodes, level, done = max(1, -(-most // leaf)), 0, []
    while True:
        root = nodes == 1

        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(state.filter(~is_open))
        if root and level:
            state = state.filter(is_open)
        settled = state.filter(is_open).groupBy("sid", "leaf").applyInPandas(_node(seed, level, root), _STATE)
        state = stored(settled, f"mix-level{level}")
        if root:
            done.append(state)
            break
        nodes, level = -(-nodes // fan), level + 1
        state = state.withColumn("leaf", F.floor(F.col("leaf") / fan).cast("bigint"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.join(targets.select("sid", "source_size", "target"), "sid")
    copies = F.col("whole") + F.col("p").cast("bigint")
    return out.select(
        "doc_id", "source", "size", "n", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint").alias("copies"),
    )


def mix_report(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 0) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, source, size, source_size, target,
    copies, taken`` (words taken, repeats counted)."""
    mixed = mix_sources(docs, weights, cap, seed)
    rows = mixed.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("i", "n")
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept.

    Columns of ``docs`` keep their names and order; NULLs and ties as in :func:`mix_sources`.
    """
    names = docs.columns
    mixed = mix_sources(docs, weights, cap, seed).filter("copies > 0")
    mixed = mixed.select(*[F.col(c).alias(f"m_{c}") for c in ("doc_id", "source", "size", "copies")])
    lower = [n.lower() for n in names]
    at = {c: f"c{names.index(c) if c in names else lower.index(c)}" for c in ("doc_id", "source", "text")}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.coalesce(F.col(at["text"]), F.lit(""))
    plain = plain.withColumn("w", F.regexp_count(text, F.lit(WORD)).cast("bigint"))
    on = plain[at["doc_id"]].eqNullSafe(mixed.m_doc_id) & plain[at["source"]].eqNullSafe(mixed.m_source)
    taken = plain.join(mixed, on & (plain.w == mixed.m_size))
    taken = taken.withColumn("m_i", F.explode(F.sequence(F.lit(1), F.col("m_copies"))))
    return taken.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
