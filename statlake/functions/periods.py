"""Period text -> first day of the period.

Statistical publishers label rows ``1987M01`` (monthly), ``1987Q3``
(quarterly) or ``1987`` / ``1987.0`` (annual). ``parse_period`` turns such
text into a DATE on the first day of the period and yields NULL, never an
error, for anything it cannot read (Spark 4 runs with ANSI on).

How, and why this way: the year, month and quarter are read as integer
parts and the date is built from them with ``try_make_timestamp_ntz``.
Each part is referenced exactly once in the expression tree, so its regex
runs once per row (a part used both in a CASE condition and in its value
may be evaluated twice), and no label is turned into text and re-parsed
with a date pattern. Good labels never raise internally; only an
out-of-range month does. The result equals the text route
``to_date(concat_ws('-', y, lpad(m, 2, '0'), '01'), 'yyyy-MM-dd')``.
The expression is built as SQL text (one parse on the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions.sql import ident, string

FREQUENCIES = ("annual", "quarterly", "monthly")

# The patterns that read period labels.
YEAR_PREFIX = r"^(\d{4})"
MONTH_PART = r"M(\d{1,2})"
QUARTER_PART = r"Q([1-4])"
# A plain decimal number (optionally signed, padded, with exponent).
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _digits(label: str, pattern: str) -> str:
    """The regex group as INT; NULL when absent (the group is 1-4 digits)."""
    return f"CAST(NULLIF(regexp_extract(CAST({label} AS STRING), {string(pattern)}, 1), '') AS INT)"


def _year_in_range(year: str) -> str:
    """NULL unless 1000 <= year <= 9999 (one reference to ``year``)."""
    return f"NULLIF(NULLIF(LEAST(GREATEST({year}, 999), 10000), 999), 10000)"


def _first_day(year: str, month: str) -> str:
    return f"CAST(try_make_timestamp_ntz({_year_in_range(year)}, {month}, 1, 0, 0, 0) AS DATE)"


def monthly_sql(label: str) -> str:
    """``'1987M01'`` / ``'1987M1'`` -> 1987-01-01; month 0 or 13 -> NULL."""
    return _first_day(_digits(label, YEAR_PREFIX), _digits(label, MONTH_PART))


def quarterly_sql(label: str) -> str:
    """``'1987Q3'`` -> 1987-07-01 (quarter q starts in month 3q-2)."""
    return _first_day(_digits(label, YEAR_PREFIX), f"({_digits(label, QUARTER_PART)} * 3 - 2)")


def annual_sql(label: str) -> str:
    """``'1987'``, ``'1987.0'`` or a numeric 1987.0 -> 1987-01-01.

    The label is read as a number and truncated to an integer year, so
    ``'1987.0'`` works (a direct text->int cast would reject it). A year of
    fewer than four digits (``'87'``) has no date. Text is
    checked against ``NUMBER_TEXT`` first, so bad text is not parsed at all.
    """
    text = f"CAST({label} AS STRING)"
    number = f"CASE WHEN {text} RLIKE {string(NUMBER_TEXT)} THEN TRY_CAST({text} AS DOUBLE) END"
    return _first_day(f"TRY_CAST({number} AS INT)", "1")


_PARSERS = {"annual": annual_sql, "quarterly": quarterly_sql, "monthly": monthly_sql}


def period_sql(label: str, frequency: str) -> str:
    """SQL text of the period expression for the column named ``label``."""
    if frequency not in _PARSERS:
        raise ValueError(f"frequency must be one of {FREQUENCIES}, got {frequency!r}")
    return _PARSERS[frequency](ident(label))


def parse_period(label: str, frequency: str) -> Column:
    """First day of the period named by the column ``label`` at ``frequency``."""
    return F.expr(period_sql(label, frequency))
