"""Control totals of a write, gathered in the same job, and the run ledger that keeps them.

What a run prints and forgets elsewhere (rows read, codes missing, cells that are not numbers) is
counted here while the rows are written, without a second scan, and entered into a table that a
later check can read.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEDGER = "table string, batch string, control string, n bigint, entered timestamp, run string"


class Controls:
    """Totals of one write: its rows, and the rows for which each SQL condition holds.

    Pass it to ``write_table`` or ``deliver``; ``totals`` has the figures afterwards. With ``ledger``
    (a folder) they are entered into the ledger table there, one row a control, once the write
    has succeeded: a failed one enters nothing. Each entry is a partition of its own, so writes
    that run side by side do not meet.
    """

    def __init__(self, table: str, conditions: Mapping[str, str] | None = None, ledger: str | None = None):
        self.table, self.conditions, self.ledger = table, dict(conditions or {}), ledger
        if "rows" in self.conditions:
            raise ValueError("the control 'rows' is always counted")
        self.totals: dict[str, int] = {}
        self._seen: Observation | None = None

    def on(self, df: DataFrame) -> DataFrame:
        self._seen = Observation(f"controls-{uuid.uuid4().hex[:12]}")
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(c)).alias(n) for n, c in self.conditions.items()])

    def enter(self, spark: SparkSession, path: str, batch: str | None = None) -> None:
        """After a successful write: take the figures, and enter them into the ledger."""
        got = self._seen.get
        self.totals = {n: int(got.get(n) or 0) for n in ("rows", *self.conditions)}
        if self.ledger:
            rows = [(self.table, batch, n, v) for n, v in self.totals.items()]
            entry = spark.createDataFrame(rows, "table string, batch string, control string, n bigint").coalesce(1)
            place = f"{self.ledger.rstrip('/')}/run={uuid.uuid4().hex[:12]}"
            entry.withColumn("entered", F.current_timestamp()).write.parquet(place)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``table, batch, control, n, entered, run`` of every successful write."""
    return spark.read.schema(LEDGER).parquet(ledger)


def latest_totals(spark: SparkSession, ledger: str) -> DataFrame:
    """``table, batch, control, n`` of the last write of each table and batch."""
    last = F.max_by("n", F.struct("entered", "run")).alias("n")
    return read_ledger(spark, ledger).groupBy("table", "batch", "control").agg(last)
