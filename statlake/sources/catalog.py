"""Published tables by name (S11): an external catalogue table over each table's folder.

The catalogue holds location, schema and partition columns from the stored contract; the data stays
where it is, and dropping the name leaves it there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from statlake.functions.sql import ident, string
from statlake.sources.contract import ContractError, stored_contract


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make the table in ``path`` readable as ``name`` (``database.table``).

    An earlier registration is kept if location, schema and partition columns are unchanged; else it is
    made anew. Partitions that came or went since are recovered.
    """
    contract = stored_contract(spark, path)
    if contract is None:
        raise ContractError(f"{path} keeps no contract")
    full = ".".join(ident(p) for p in name.split("."))
    if spark.catalog.tableExists(name) and not _same(spark, full, path, contract):
        spark.sql(f"DROP TABLE {full}")  # external: the files stay
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in contract.schema)
        parts = f"PARTITIONED BY ({', '.join(ident(p) for p in contract.partition_by)})" if contract.partition_by else ""
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {parts} LOCATION {string(path)}")
    if contract.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {full}")


def _same(spark: SparkSession, full: str, path: str, contract) -> bool:
    rows = spark.sql(f"DESCRIBE EXTENDED {full}").collect()
    location = next((r.data_type for r in rows if r.col_name == "Location"), "")
    bare = lambda p: p.split(":", 1)[-1].replace("///", "/").rstrip("/")
    have = spark.table(full).schema
    parts = [c.name for c in spark.catalog.listColumns(full) if c.isPartition]
    types = [(f.name, f.dataType) for f in have] == [(f.name, f.dataType) for f in contract.schema]
    return bare(location) == bare(path) and types and parts == list(contract.partition_by)
