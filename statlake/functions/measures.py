"""Measure cleaning, recoding and rule-driven casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.names import qcol
from statlake.functions.sql import ident, string

# What counts as numeric text in a measure column, the marker
# for "no value" kept as NULL, and the total marker of dimension codes.
NUMERIC_TEXT = r"^-?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"
MISSING_MARKER = "NA"
TOTAL_RECODE = {"_T": "T"}


def is_numeric_text(col: Column | str) -> Column:
    """True when the text is a plain decimal number (F4). NULL stays NULL."""
    if isinstance(col, str):
        col = qcol(col)
    return col.rlike(NUMERIC_TEXT)


def recode(df: DataFrame, columns: Sequence[str], mapping: Mapping[str, str] = TOTAL_RECODE) -> DataFrame:
    """Replace exact values in the given columns (D5), one projection."""
    targets = set(columns)
    exprs = []
    for name in df.columns:
        if name in targets and mapping:
            arms = " ".join(f"WHEN {ident(name)} = {string(o)} THEN {string(n)}" for o, n in mapping.items())
            exprs.append(f"CASE {arms} ELSE {ident(name)} END AS {ident(name)}")
        else:
            exprs.append(ident(name))
    return df.selectExpr(*exprs)


def clean_measure(
    df: DataFrame,
    column: str = "value",
    missing: str = MISSING_MARKER,
    to_type: str = "double",
) -> DataFrame:
    """Text measure -> number.

    * NULL text: row dropped.
    * the missing marker (``NA``): row kept, value NULL.
    * numeric text: cast to ``to_type``.
    * any other text: row dropped.
    No sentinel number is used, so a genuine -999.999 survives.
    """
    raw = qcol(column).cast("string")
    keep = (raw == F.lit(missing)) | raw.rlike(NUMERIC_TEXT)
    value = F.when(raw == F.lit(missing), F.lit(None)).otherwise(raw.try_cast(to_type))
    return df.filter(keep).withColumn(column, value.cast(to_type))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any listed) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def cast_by_name(
    df: DataFrame,
    rules: Mapping[str, str] | None = None,
    default: str | None = "string",
) -> DataFrame:
    """Cast each column by its name (P8) in one projection.

    ``rules`` maps a column name to a type; other columns get ``default``
    (``None`` leaves them as they are). Casts are ``try_cast``: unreadable
    text becomes NULL instead of failing the job.
    """
    rules = {"value": "float", "year": "int"} if rules is None else dict(rules)
    exprs = []
    for name in df.columns:
        target = rules.get(name, default)
        col = ident(name)
        exprs.append(col if target is None else f"TRY_CAST({col} AS {target}) AS {col}")
    return df.selectExpr(*exprs)
