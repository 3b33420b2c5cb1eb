"""Fact-to-dimension joins.

No broadcast hint is placed here on purpose. A hint forces a broadcast
whatever the size; without one, Spark checks the size itself:

* at planning time against ``spark.sql.autoBroadcastJoinThreshold`` using
  the scan statistics (a parquet dimension of a few hundred countries is
  kilobytes and is broadcast);
* at run time (AQE) against the measured shuffle output, converting a
  sort-merge join to a broadcast join when the dimension turned out small.

Beyond both thresholds the join stays a sort-merge join, and AQE's skew
handling splits a fact partition whose key holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.names import qcol
from statlake.functions.sql import ident



def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    columns: Mapping[str, str] | None = None,
    how: str = "inner",
    keep_fact: Sequence[str] | None = None,
) -> DataFrame:
    """Join a fact to a dimension and project named dimension columns.

    ``columns`` maps output name -> dimension column. ``keep_fact`` lists
    fact columns to keep (default: all but the key when a dimension column
    replaces it, else all). ``how`` is ``inner`` (unmatched facts drop) or
    ``left`` (unmatched facts get NULL attributes).
    """
    dim_key = dim_key or fact_key
    columns = dict(columns or {})
    f, d = fact.alias("f"), dim.alias("d")
    cond = F.col(f"f.`{fact_key}`") == F.col(f"d.`{dim_key}`")
    kept = list(keep_fact) if keep_fact is not None else list(fact.columns)
    out = [f"f.{ident(c)} AS {ident(c)}" for c in kept]
    out += [f"d.{ident(src)} AS {ident(name)}" for name, src in columns.items()]
    return f.join(d, cond, how).selectExpr(*out)


def denormalize(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]],
    keep_fact: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Replace codes by names through a chain of dimension joins.

    ``lookups`` holds ``(dim, fact_key, dim_key, {out_name: dim_col})``;
    the fact keys are dropped from the output unless listed in
    ``keep_fact``.
    """
    used_keys = {fk for _, fk, _, _ in lookups}
    kept = list(keep_fact) if keep_fact is not None else [c for c in fact.columns if c not in used_keys]
    out = fact
    carried = list(fact.columns)
    for dim, fk, dk, cols in lookups:
        out = join_dim(out, dim, fk, dk, cols, how=how, keep_fact=carried)
        carried = carried + list(cols)
    final = kept + [name for _, _, _, cols in lookups for name in cols]
    return out.select(*[qcol(c) for c in final])
