"""Connected groups of similar items without listing all pairs of a group.

``components`` labels connected nodes of an edge table. ``linked_groups`` finds
the groups of items that a similarity links, given blocks in which any two
linked items meet:

* the first round compares each item with one pivot per block only (a star), or, with
  ``cuts``, with one pivot per part of a block that agrees in a cut; one item is the pivot of many blocks;
* further rounds draw each block's pivot anew, so what is still apart meets as many pivots as it has blocks;
* what these links connect needs no more comparing inside;
* the last round compares, in blocks that still hold several groups, items of
  different groups, all of them, so no link between two groups is lost.

A dense group of g near copies thus costs about g comparisons, not g^2 / 2.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b`` bigint) but the labels
    themselves; ``label`` is the smallest connected node.

    Alternating large and small stars: each step hangs a node's neighbours on the
    smallest it knows, until the edges are stars around the smallest nodes. Each
    step is a table in shared storage; hubs are reduced map-side.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, before = stored(e, "edges"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        up = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = stored(up.filter("u <> v").distinct(), "edges")
        low = up.groupBy("u").agg(F.min("v").alias("m"))
        hung = up.join(low.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(low.withColumnRenamed("m", "v").unionByName(hung).filter("u <> v").distinct(), "edges")
        mark = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))
        now = tuple(e.agg(F.count(F.lit(1)), mark).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def linked_groups(
    blocks: DataFrame,
    attrs: Sequence[str],
    may_link: str,
    verify: Callable[[DataFrame], DataFrame],
    rounds: int = 2,
    cuts: Sequence[str] = (),
    late: DataFrame | None = None,
    late_link: str = "true",
) -> DataFrame:
    """``node, label`` of all linked nodes (labels themselves left out).

    ``blocks``: ``key, node`` and ``attrs``, stored. ``may_link``: SQL over
    ``x`` and ``y`` (structs of ``node`` and ``attrs``), a necessary condition
    for a link found in this block. ``verify`` gets pairs ``a, b`` with
    ``x, y`` and the ``key`` of a block where they meet, and returns the linked
    ones, ``a, b``. ``cuts``: SQL over ``x``, bigint; in the first round a block's items
    meet once per cut, with a pivot among those of the same value, so that a block
    of several families has a pivot in each.
    ``late``, ``late_link``: a table of ``node`` (each once) and further columns, and a further necessary condition
    on them, SQL over ``x``, ``y`` and structs ``xl`` and ``yl`` of those columns. Only the last round has them, for
    the rows it compares.
    """

    def pairs(found: DataFrame) -> DataFrame:
        flip = F.expr("x.node > y.node")
        low, high = F.when(flip, F.col("y")).otherwise(F.col("x")), F.when(flip, F.col("x")).otherwise(F.col("y"))
        ordered = found.filter(may_link).select("key", low.alias("x"), high.alias("y"))
        out = ordered.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        return stored(out.agg(F.min("key").alias("key"), F.first("x").alias("x"), F.first("y").alias("y")), "pairs")

    labels = None
    for r in range(rounds + 1):
        rows = blocks.withColumn("x", F.struct("node", *attrs)).select("key", "x", F.col("node").alias("own"))
        if labels is None:
            rows = rows.withColumn("label", F.col("own"))
        else:
            known = labels.select(F.col("node").alias("k"), F.col("label").alias("l"))
            rows = rows.join(known, F.col("own") == F.col("k"), "left").withColumn("label", F.coalesce("l", "own"))
        rows = rows.select("key", F.lit(0).alias("cut"), F.lit(0).cast("bigint").alias("part"), "x", "label")
        if r == 0 and cuts:
            rows = rows.select("key", F.posexplode(F.array(*[F.expr(c) for c in cuts])).alias("cut", "part"), "x", "label")
        elif labels is not None:
            rows = stored(rows, "blocks")  # read twice below
        per = rows.groupBy(F.col("key").alias("pk"), F.col("cut").alias("pc"), F.col("part").alias("pp")).agg(
            F.min_by(F.struct("x", "label"), F.xxhash64(F.lit(r), "x.node", *(["key"] if r else []))).alias("pivot"),
            F.min("label").alias("lo"), F.max("label").alias("hi"),
        ).filter("lo <> hi")
        rows = rows.join(per, F.expr("key = pk AND cut = pc AND part = pp"))
        if r < rounds:
            met = rows.filter("pivot.label <> label").select("key", "x", F.col("pivot.x").alias("y"))
        else:
            rows, link = rows.select("key", "x", "label"), may_link
            if late is not None:
                more = late.select(F.col("node").alias("ln"), F.struct(*[c for c in late.columns if c != "node"]).alias("xl"))
                rows, link = rows.join(more, F.col("x.node") == F.col("ln")).drop("ln"), f"{may_link} AND {late_link}"
            rows = stored(rows, "blocks")
            other = rows.toDF(*[{"key": "k2", "x": "y", "label": "label2", "xl": "yl"}[c] for c in rows.columns])
            met = rows.join(other, (F.col("key") == F.col("k2")) & (F.col("label") < F.col("label2")) & F.expr(link)).select("key", "x", "y")
        new = stored(verify(pairs(met)).select("a", "b"), "links")
        labels = components(new) if labels is None else merged(labels, new)
    return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` of :func:`components`, further links between nodes taken in: only the groups that
    these join are connected anew, each by its label."""
    of = [labels.select(F.col("node").alias(f"n{c}"), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
    ends = links.join(of[0], F.col("a") == F.col("na"), "left").join(of[1], F.col("b") == F.col("nb"), "left")
    joined = components(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    # a node of ``joined`` was a label or in no group, so it is not in ``labels``
    new = joined.select(F.col("node").alias("k"), F.col("label").alias("l"))
    moved = labels.join(new, F.col("label") == F.col("k"), "left").select("node", F.coalesce("l", "label").alias("label"))
    return stored(moved.unionByName(joined), "labels")
