"""Keys, membership and key sets.

None of these collects keys to the driver: membership is a semi/anti join,
key-set algebra is set operators over de-duplicated keys, and "one row per
key" is a ranked window. Every shuffle is on the key, and each one is
preceded by a map-side reduction (partial aggregate or partial window
limit), so a key holding a third of all rows sends at most one row per map
task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.names import qcol
from statlake.functions.sql import ident

_RANK = "__statlake_rank"


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def keep_first(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key, the first by the ``order`` columns (ascending).

    NULLs order last, so a NULL attribute never wins over a value. Remaining columns (ascending, NULLs last) break ties, so the survivor
    is deterministic whatever the partitioning. Catalyst plans
    ``row_number() = 1`` with a partial WindowGroupLimit before the
    shuffle, so skewed keys are reduced map-side.
    """
    keys = _cols(keys)
    order = list(order)
    tie = [c for c in df.columns if c not in keys and c not in order]
    by = ", ".join([f"{ident(o)} ASC NULLS LAST" for o in order] + [f"{ident(c)} ASC NULLS LAST" for c in tie])
    over = f"PARTITION BY {', '.join(ident(k) for k in keys)}" + (f" ORDER BY {by}" if by else "")
    ranked = df.withColumn(_RANK, F.expr(f"row_number() OVER ({over})"))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """A1: rows per key (partial count map-side, then one shuffle)."""
    return df.groupBy(*[qcol(k) for k in _cols(keys)]).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """A2: keys that occur more than once, with their count."""
    return count_by(df, keys, name).filter(F.col(name) > 1)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A4: the total row count as a one-row DataFrame (lazy)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def _key_set(other: DataFrame, other_key: str, key: str) -> DataFrame:
    # distinct() is a partial aggregate: the hot key leaves each map task once
    return other.select(qcol(other_key).alias(key)).distinct()


def semi_members(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (NULL never matches)."""
    return df.join(_key_set(other, other_key or key, key), on=key, how="left_semi")


def anti_members(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``other``; NULL keys drop.

    A bare left-anti join would keep NULL keys; the membership test
    ``NOT key IN (...)`` it replaces never keeps them.
    """
    keys = _key_set(other, other_key or key, key).filter(F.col(key).isNotNull())
    return df.filter(qcol(key).isNotNull()).join(keys, on=key, how="left_anti")


def key_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys in either input (NULL counts as a key)."""
    return a.union(b).distinct()


def key_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys in both inputs (INTERSECT DISTINCT, NULL-safe)."""
    return a.distinct().intersect(b.distinct())


def key_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (EXCEPT DISTINCT, NULL-safe)."""
    return a.distinct().subtract(b.distinct())


def sort_desc(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """O1: global sort, descending on ``columns``.

    The remaining columns follow as ascending tie-breakers: a global sort
    range-partitions on the sort key, and rows sharing one value can never
    be split across ranges, so a value held by a third of all rows would
    land in one task. With the tie-breakers the range boundaries can fall
    inside such a value.
    """
    cols = _cols(columns)
    rest = [qcol(c).asc_nulls_last() for c in df.columns if c not in cols]
    return df.orderBy(*[qcol(c).desc() for c in cols], *rest)
