"""Reshape and schema alignment: wide -> long (R1-R3), unions (U1, P10), literals.

Unpivot is planned by Catalyst as a narrow ``Expand``: no shuffle, inside
whole-stage codegen, one output row per (input row, value column). Its cost
grows with rows x columns and it partitions exactly like its input.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.names import qcol
from statlake.functions.periods import period_sql
from statlake.functions.sql import ident, string


def _unpivot(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[tuple[str, str]],
    variable: str,
    value: str,
    value_type: str | None,
) -> DataFrame:
    """``values`` are (column, label) pairs; NULL cells are kept.

    One projection (SQL text, parsed once) renames the value columns to
    their labels and, if asked, casts them to one type (unpivot needs a
    single value type; text that does not read as the type becomes NULL).
    """
    if not values:
        raise ValueError("nothing to unpivot: no value column selected")
    types = dict(df.dtypes)
    labels = [label for _, label in values]
    # labels double as staged column names unless two collide (e.g. yr1999
    # and zz1999 with the prefix stripped) or one equals an id; then stage
    # under internal names
    distinct = len(set(labels)) == len(labels) and not set(labels) & set(ids)
    staged_names = labels if distinct else [f"__statlake_v{k}" for k in range(len(values))]
    exprs = [ident(i) for i in ids]
    for (name, _), staged_name in zip(values, staged_names):
        src = ident(name)
        if value_type is not None:
            src = f"{'TRY_CAST' if types[name] == 'string' else 'CAST'}({src} AS {value_type})"
        exprs.append(f"{src} AS {ident(staged_name)}")
    staged = df.selectExpr(*exprs)
    if distinct:
        cols = [ident(label) for label in labels]
    else:
        cols = [F.col(ident(n)).alias(label) for n, label in zip(staged_names, labels)]
    return staged.unpivot([ident(i) for i in ids], cols, variable, value)


def unpivot_entities(
    df: DataFrame,
    id_column: str = "year",
    variable: str = "country",
    value: str = "value",
    value_type: str | None = "double",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every column except ``id_column`` (and ``keep``) is an entity (e.g. a country).

    ``year | St. Lucia | Korea, Rep.`` becomes ``year | country | value``
    with one row per (row, entity); empty cells stay as NULL values. Column
    names are used verbatim as labels (dots, commas, quotes are fine).
    """
    ids = [id_column, *keep]
    entities = [(c, c) for c in df.columns if c not in ids]
    return _unpivot(df, ids, entities, variable, value, value_type)


def unpivot_matching(
    df: DataFrame,
    pattern: str,
    variable: str = "year",
    value: str = "value",
    ids: Sequence[str] | None = None,
    strip_prefix: int = 0,
    ignore_case: bool = True,
    full_match: bool = False,
    value_type: str | None = None,
) -> DataFrame:
    """Unpivot the columns whose *name* matches ``pattern``.

    * ``ids=None`` keeps every non-matching column as an identifier (R2);
      a list keeps only those and drops the rest (R3).
    * ``strip_prefix`` removes that many leading characters from the label
      (``YR1999`` -> ``1999``).
    * the match is anchored at the start of the name (``re.match``), or at
      both ends with ``full_match``.
    """
    rx = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    test = rx.fullmatch if full_match else rx.match
    matched = [c for c in df.columns if test(c)]
    keep = [c for c in df.columns if c not in matched] if ids is None else list(ids)
    labels = [(c, c[strip_prefix:]) for c in matched]
    return _unpivot(df, keep, labels, variable, value, value_type)


def as_cells(df: DataFrame, ids: Sequence[str], cells: str = "cells") -> DataFrame:
    """A wide table as ``ids`` and one column ``cells``: a map from header to text.

    Tables whose headers differ from file to file then share one schema, so they are united, stored and
    filtered as one table. NULL cells are left out of the map (absent and empty cells read
    alike); headers are kept verbatim. One projection, built as one SQL text.
    """
    others = [c for c in df.columns if c not in ids]
    pairs = ", ".join(f"struct({string(c)} AS key, CAST({ident(c)} AS STRING) AS value)" for c in others)
    entries = f"filter(array({pairs}), e -> e.value IS NOT NULL)" if others else "CAST(array() AS ARRAY<STRUCT<key: STRING, value: STRING>>)"
    return df.selectExpr(*[ident(i) for i in ids], f"map_from_entries({entries}) AS {ident(cells)}")


def unpivot_cells(
    df: DataFrame,
    pattern: str,
    variable: str = "year",
    value: str = "value",
    cells: str = "cells",
    strip_prefix: int = 0,
    ignore_case: bool = True,
) -> DataFrame:
    """R1-R3 on map rows (:func:`as_cells`): one row for each cell whose header matches ``pattern`` as a whole.

    Headers are filtered before rows are made, in the same stage as the scan, and nothing is known about
    them when the job is planned: a file with a new year column needs no new schema. Cells that are
    NULL have no row. All other columns are kept.
    """
    rx = f"^(?:{pattern})$" if not ignore_case else f"(?i)^(?:{pattern})$"
    kept = f"map_filter({ident(cells)}, (k, v) -> k RLIKE {string(rx)} AND v IS NOT NULL)"
    others = [c for c in df.columns if c != cells]
    long = df.selectExpr(*[ident(c) for c in others], f"explode(map_entries({kept})) AS __cell")
    label = f"substr(__cell.key, {strip_prefix + 1})" if strip_prefix else "__cell.key"
    return long.selectExpr(*[ident(c) for c in others], f"{label} AS {ident(variable)}", f"__cell.value AS {ident(value)}")


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add (or replace) constant columns in one projection."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def common_columns(*dfs: DataFrame) -> list[str]:
    """P10: names present in every input, in the first input's order."""
    if not dfs:
        return []
    shared = set(dfs[0].columns)
    for d in dfs[1:]:
        shared &= set(d.columns)
    return [c for c in dfs[0].columns if c in shared]


def align_union(dfs: Iterable[DataFrame], allow_missing: bool = False, common: bool = False) -> DataFrame:
    """Union all, matched by column *name*, never by position.

    ``common=True`` first narrows every input to ``common_columns``;
    ``allow_missing=True`` fills absent columns with NULL instead.
    A union is a narrow concatenation of the inputs' partitions.
    """
    dfs = list(dfs)
    if not dfs:
        raise ValueError("align_union needs at least one DataFrame")
    if common:
        names = common_columns(*dfs)
        dfs = [d.select(*[qcol(c) for c in names]) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def normalize_period(
    df: DataFrame,
    frequency: str,
    label: str = "year",
    keep_frequency: bool = True,
) -> DataFrame:
    """Period label -> ``period`` DATE, set ``frequency``, drop helpers.

    The label column and any ``insert_timestamp`` are removed; the other
    columns keep their order, then ``frequency`` (unless dropped) and
    ``period``. A ``period`` column already there is kept as it is. One projection.
    """
    others = [c for c in df.columns if c not in (label, "insert_timestamp", "frequency", "period")]
    exprs = [ident(c) for c in others]
    if keep_frequency:
        exprs.append(f"{string(frequency)} AS frequency")
    exprs.append("period" if "period" in df.columns else f"{period_sql(label, frequency)} AS period")
    return df.selectExpr(*exprs)
