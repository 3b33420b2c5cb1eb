"""Header sanitising (P6, P7) and safe column references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The header rule of the source pipeline. Lower-case, a space
# becomes an underscore, and these characters are removed:
#   , ; ( ) newline tab =
REMOVED_FROM_HEADERS = ",;()\n\t="
# Added by us: braces are also removed, so every sanitised name is a legal
# parquet column name on every Spark version.
ALSO_REMOVED = "{}"

_DELETE = str.maketrans("", "", REMOVED_FROM_HEADERS + ALSO_REMOVED)


def sanitize_name(name: str) -> str:
    """``'Country Name (x)'`` -> ``'country_name_x'``."""
    return name.lower().replace(" ", "_").translate(_DELETE)


def sanitized_names(names: list[str]) -> list[str]:
    """``sanitize_name`` of each header, made unique.

    Two headers that sanitise to the same name would make the parquet write
    fail, so later ones get a ``_2``, ``_3`` ... suffix (first free one).
    Applying it twice gives the same names (idempotent).
    """
    taken: set[str] = set()
    out = []
    for raw in names:
        base = sanitize_name(raw)
        name, k = base, 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        out.append(name)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by ``sanitized_names``, positionally (one call)."""
    return df.toDF(*sanitized_names(df.columns))


def qcol(name: str) -> Column:
    """A column by its literal name, even with dots, quotes or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")
