"""Landing a table of the lake: written, counted, and readable by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from statlake.layout import Layout
from statlake.sources.catalog import register_table
from statlake.sources.ledger import Controls
from statlake.sources.tables import write_table


def land(
    df: DataFrame,
    layout: Layout,
    layer: str,
    name: str,
    partition_by: str | Sequence[str] | None = None,
    sanitize: bool = True,
    controls: Mapping[str, str] | None = None,
) -> None:
    """Replace ``layer.name``: the table in its folder, its control totals in the run ledger (counted in the
    writing job itself), and its entry in the catalogue."""
    path = getattr(layout, layer)(name)
    counted = Controls(f"{layer}.{name}", controls, layout.ledger())
    write_table(df, path, partition_by=partition_by, sanitize=sanitize, counted=counted)
    register_table(df.sparkSession, f"{layer}.{name}", path)
