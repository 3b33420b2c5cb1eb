"""Quoting for SQL expression text (``selectExpr`` / ``F.expr``).

Per-column expressions are built as SQL text and handed to Spark in one
call: the JVM parses the whole projection at once instead of the driver
making one gateway round trip per column operation. That keeps planning
time flat for publisher sheets with hundreds of columns.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A column name as a quoted identifier (dots, spaces, quotes are fine)."""
    return "`" + name.replace("`", "``") + "`"


def string(text: str) -> str:
    """A string literal (backslash escapes, Spark's default)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
