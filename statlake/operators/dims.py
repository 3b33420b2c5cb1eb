"""Dimensions: split off a fact (D7) and conform several code lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.names import qcol
from statlake.functions.sql import ident, string
from statlake.operators.keys import keep_first


def extract_dim(
    df: DataFrame,
    key: str,
    attrs: Sequence[str],
    one_per_key: bool = False,
) -> DataFrame:
    """Distinct (key, attrs...) rows of a fact.

    With ``one_per_key`` a key that appears with several attribute values
    keeps the first by those values (NULLs last, so a name wins over none), and
    joining the result never fans out. Both forms reduce map-side first.
    """
    cols = [qcol(key)] + [qcol(a) for a in attrs]
    if one_per_key:
        # distinct first: a hash aggregate in the map tasks, so only distinct rows are ranked
        pairs = df.select(*cols).filter(qcol(key).isNotNull()).distinct()
        return keep_first(pairs, [key], list(attrs))
    return df.select(*cols).distinct()


def conform_dim(
    primary: DataFrame,
    secondary: DataFrame,
    key: str = "country_code",
    name: str = "country_name",
    secondary_name: str = "country",
    enrich: Sequence[str] = ("region", "subregion"),
) -> DataFrame:
    """One conformed dimension from a primary and a secondary code list.

    1. primary: rows with any NULL dropped, one row per code (first name);
    2. secondary: NULL codes dropped, one row per code (first by name, then
       the enrich columns), so it cannot fan out;
    3. codes only in the secondary are appended with the secondary's name;
    4. every code is enriched from the secondary (left join).

    Result: columns ``key, name, *enrich``, a code at most once. Left out are
    NULL codes, and codes of the primary whose name is always NULL and that the
    secondary lacks. Names of the secondary may be NULL only where a code has no
    other. One lazy plan; nothing is collected.
    """
    p = keep_first(primary.select(qcol(key), qcol(name)).dropna(how="any").distinct(), [key], [name])
    s = keep_first(
        secondary.select(qcol(key), qcol(secondary_name), *[qcol(c) for c in enrich]).filter(qcol(key).isNotNull()).distinct(),
        [key],
        [secondary_name, *enrich],
    )
    only_secondary = s.join(p.select(key), on=key, how="left_anti").select(
        qcol(key), qcol(secondary_name).alias(name)
    )
    every_code = p.unionByName(only_secondary)
    attrs = s.select(qcol(key), *[qcol(c) for c in enrich])
    return every_code.join(attrs, on=key, how="left").select(
        qcol(key), qcol(name), *[qcol(c) for c in enrich]
    )


def survivorship(
    sources: Sequence[tuple[str, DataFrame, Mapping[str, str]]],
    key: str,
    attrs: Sequence[str],
    provenance: bool = True,
) -> DataFrame:
    """D8 for any number of code lists: one row per code, each attribute from the first list that has it.

    ``sources`` are ``(name, rows, columns)`` in order of precedence; ``columns`` maps ``key`` and
    attributes to a list's own column names (those left out are named alike; a column that a list does not
    have gives nothing). An attribute's value is taken from the first source with one that is not
    NULL; within a source the least value wins. With ``provenance``, ``<attr>_source`` names the list it
    came from. NULL codes are left out; a code without any value keeps its row with NULLs.

    One aggregate over the union of the lists: one shuffle, whatever their number, and a code
    that fills a third of a list leaves each map task once.
    """
    if not sources:
        raise ValueError("survivorship needs at least one code list")
    parts = []
    for rank, (name, df, columns) in enumerate(sources):
        have = {c: columns.get(c, c) for c in (key, *attrs)}
        if have[key] not in df.columns:
            raise ValueError(f"{name}: no column {have[key]!r}")
        picked = [qcol(have[c]).alias(c) if have[c] in df.columns else F.lit(None).alias(c) for c in (key, *attrs)]
        parts.append(df.select(*picked, F.lit(rank).alias("__rank")).filter(qcol(key).isNotNull()))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    names = "array(" + ", ".join(string(name) for name, _, _ in sources) + ")"
    # the least (rank, value) is a minimum, so each map task sends one row a code
    best = [F.expr(f"min(CASE WHEN {ident(a)} IS NOT NULL THEN struct(__rank, {ident(a)} AS v) END)").alias(f"__{i}") for i, a in enumerate(attrs)]
    found = rows.groupBy(qcol(key)).agg(*best)
    out = [qcol(key)]
    for i, a in enumerate(attrs):
        out.append(F.col(f"__{i}.v").alias(a))
        if provenance:
            out.append(F.expr(f"get({names}, __{i}.__rank)").alias(f"{a}_source"))
    return found.select(*out)
