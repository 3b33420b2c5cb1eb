"""Parquet tables (S4-S11): read with the stored or a declared schema, write with an audit
column, hive partitions, overwrite/append/delivery, and namespaces.

A table is a folder of parquet files in hive layout that any reader understands. Writing never
destroys what is there: an overwrite is written beside the table and takes its place by
renaming folders once the whole job has succeeded, together with its contract
(:mod:`statlake.sources.contract`). The table it replaces is kept, hidden, until the next overwrite.
A delivered batch is one partition folder, replaced in the same way. Renaming a folder must be atomic
(HDFS, local disks, object stores with a hierarchical namespace). One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from statlake.functions.names import sanitize_columns
from statlake.operators.shape import align_union
from statlake.sources.contract import (
    ADDED,
    MISSING,
    Contract,
    ContractError,
    as_schema,
    compare,
    keep_contract,
    require,
    stored_contract,
)
from statlake.sources.files import Files, sibling
from statlake.sources.ledger import Controls

AUDIT_COLUMN = "insert_timestamp"
#: where a table's replaced batches wait until their next delivery
REPLACED = ".previous"
BATCH_KEY = re.compile(r"[A-Za-z0-9_.-]+")


def current_path(spark: SparkSession, path: str) -> str:
    """Where the table's rows are: its folder, or the kept one if a writer died between two renames."""
    files, previous = Files(spark, path), sibling(path, "previous")
    return previous if not files.exists(path) and files.exists(previous) else path


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, strict: bool = False
) -> DataFrame:
    """Read a parquet table.

    Without ``schema`` the stored contract's is used, or, for a table without one, Spark's inference
    (which would turn a partition code ``001`` into the integer 1). With it, the declared columns are read:
    those the table lacks are NULL, those not declared are left out, and a column of another
    type is a :class:`ContractError` (with ``strict``, any difference but the audit column is).
    """
    path = current_path(spark, path)
    contract = stored_contract(spark, path)
    if schema is None:
        schema = contract.schema if contract else None
    elif contract:
        drifts = [d for d in compare(contract.schema, as_schema(spark, schema)) if d.column != AUDIT_COLUMN]
        require(drifts, path, () if strict else (ADDED, MISSING))
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    files, held = Files(spark, path), f"{path.rstrip('/')}/{REPLACED}"
    # a batch whose writer died between two renames is still there
    waiting = [b for b in files.children(held) if not files.exists(f"{path.rstrip('/')}/{b}")]
    table = reader.parquet(path)
    for batch in waiting:
        table = table.unionByName(reader.option("basePath", held).parquet(f"{held}/{batch}"))
    return table


def with_audit(df: DataFrame) -> DataFrame:
    """(re)set ``insert_timestamp``; one value for the whole write."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp())


def _columns(names: str | Sequence[str] | None) -> list[str]:
    return [names] if isinstance(names, str) else list(names or ())


def _write(df: DataFrame, path: str, parts: Sequence[str], mode: str, counted: Controls | None = None) -> None:
    """Plain parquet files. A partitioned write is preceded by a REBALANCE on the partition
    columns: rows of one partition value meet in few tasks (few files per
    directory instead of tasks x values), and AQE splits a value that holds
    a large share of all rows over several tasks, so no single task writes
    a hot partition alone.
    """
    rows = df.hint("rebalance", *parts) if parts else df
    # counted in the writing stage itself, where a task that runs again counts once
    writer = (counted.on(rows) if counted else rows).write.mode(mode)
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def _contract_of(df: DataFrame, parts: Sequence[str]) -> Contract:
    # as parquet gives it back: every column nullable, partition columns last
    fields = [f for f in df.schema if f.name not in parts] + [df.schema[p] for p in parts]
    return Contract(StructType([StructField(f.name, f.dataType, True) for f in fields]), tuple(parts))


def _replace(files: Files, staged: str, place: str, previous: str) -> None:
    """Put ``staged`` at ``place``; what was there stays at ``previous``."""
    if files.exists(place):
        files.delete(previous)
        files.move(place, previous)
    files.move(staged, place)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    sanitize: bool = True,
    audit: bool = True,
    evolve: bool = False,
    counted: Controls | None = None,
) -> None:
    """Optional header sanitising, audit column, mode, partitions.

    ``overwrite`` replaces the table when the job has succeeded; a failed one leaves it as it was.
    ``append`` adds files to it; columns must fit the stored contract (a column it lacks, or of another
    type, is a :class:`ContractError` before anything is written; columns left out are NULL). With
    ``evolve`` new columns join the contract. ``counted`` gathers control totals in the same job
    (:mod:`statlake.sources.ledger`).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode!r}: overwrite or append")
    if sanitize:
        df = sanitize_columns(df)
    if audit:
        df = with_audit(df)
    spark, parts = df.sparkSession, _columns(partition_by)
    contract = _contract_of(df, parts)
    if mode == "overwrite" or not _fit(spark, path, contract, evolve):
        _overwrite(df, path, contract, counted)
    else:
        _write(df, path, parts, "append", counted)
    spark.catalog.refreshByPath(path)
    if counted:
        counted.enter(spark, path)


def _overwrite(df: DataFrame, path: str, contract: Contract, counted: Controls | None = None) -> None:
    spark = df.sparkSession
    files, staged = Files(spark, path), sibling(path, f"next-{uuid.uuid4().hex[:12]}")
    try:
        _write(df, staged, contract.partition_by, "errorifexists", counted)
        keep_contract(spark, staged, contract)
    except BaseException:
        files.delete(staged)
        raise
    # a writer that died between its renames left only the kept table, which stays the one to keep
    _replace(files, staged, path, sibling(path, "previous"))


def _fit(spark: SparkSession, path: str, contract: Contract, evolve: bool) -> bool:
    """Whether there is a table to add rows to; if so, they must fit its contract, which ``evolve`` widens."""
    files, previous = Files(spark, path), sibling(path, "previous")
    if not files.exists(path):
        if not files.exists(previous):
            return False
        files.move(previous, path)  # the last writer died between its renames
    stored = stored_contract(spark, path)
    if stored:
        if list(contract.partition_by) != list(stored.partition_by):
            raise ContractError(f"{path}: partitioned by {list(stored.partition_by)}, given {list(contract.partition_by)}")
        drifts = compare(stored.schema, contract.schema)
        require(drifts, path, (ADDED, MISSING) if evolve else (MISSING,))
        new = {d.column for d in drifts if d.change == ADDED}
        if new:  # before the rows: those without the columns read as NULL
            data = [f for f in stored.schema if f.name not in stored.partition_by] + [f for f in contract.schema if f.name in new]
            kept = [stored.schema[p] for p in stored.partition_by]
            keep_contract(spark, path, Contract(StructType(data + kept), stored.partition_by))
    return True


def deliver(
    df: DataFrame,
    path: str,
    batch: str,
    column: str = "batch",
    partition_by: str | Sequence[str] | None = None,
    sanitize: bool = True,
    audit: bool = True,
    evolve: bool = False,
    counted: Controls | None = None,
) -> None:
    """Land one batch of a source; landing it again replaces it, whatever came in between.

    The batch is the table's first partition column, so its rows are one folder: it is written
    beside the table and takes the place of the same batch's folder when the job has succeeded. Other
    batches are not touched, late ones just appear. A batch without rows leaves none. Columns must fit
    the contract as for an append. A key consists of letters, digits, ``_``, ``.`` and ``-``.
    """
    if not BATCH_KEY.fullmatch(batch) or not batch.strip("."):
        raise ValueError(f"batch key {batch!r}: letters, digits, '_', '.' and '-' only")
    if sanitize:
        df = sanitize_columns(df)
    if audit:
        df = with_audit(df)
    spark, path = df.sparkSession, path.rstrip("/")
    df = df.withColumn(column, F.lit(batch))
    parts = [column, *_columns(partition_by)]
    contract, files = _contract_of(df, parts), Files(spark, path)
    if not _fit(spark, path, contract, evolve):
        _overwrite(df.filter("false"), path, contract)  # a table without rows
    staged = sibling(path, f"next-{uuid.uuid4().hex[:12]}")
    place, previous = f"{path}/{column}={batch}", f"{path}/{REPLACED}/{column}={batch}"
    try:
        _write(df, staged, parts, "errorifexists", counted)
    except BaseException:
        files.delete(staged)
        raise
    files.make(f"{path}/{REPLACED}")
    if files.exists(f"{staged}/{column}={batch}"):
        _replace(files, f"{staged}/{column}={batch}", place, previous)
    elif files.exists(place):
        files.delete(previous)
        files.move(place, previous)
    # the batch is in place (or empty): nothing of it waits any more
    files.delete(previous)
    files.delete(staged)
    spark.catalog.refreshByPath(path)
    if counted:
        counted.enter(spark, path, batch)


def accumulate(
    dfs: Iterable[DataFrame],
    path: str,
    partition_by: str | Sequence[str] | None = None,
    sanitize: bool = True,
    allow_missing: bool = False,
) -> None:
    """Several sources into one table with a single overwrite.

    Replaces "first source overwrites, later sources append": one union by
    name and one job, so a failure leaves either the old or the new table,
    never a partial mix.
    """
    write_table(align_union(dfs, allow_missing=allow_missing), path, "overwrite", partition_by, sanitize)


def append_each(
    dfs: Iterable[DataFrame],
    path: str,
    partition_by: str | Sequence[str] | None = None,
    sanitize: bool = True,
) -> None:
    """S7 as the source pipeline does it: the first overwrites, the rest append.

    One job per input, so a failure in between leaves the inputs so far. Prefer ``accumulate``, or
    ``deliver`` for sources that arrive at different times.
    """
    for i, df in enumerate(dfs):
        write_table(df, path, "overwrite" if i == 0 else "append", partition_by, sanitize)


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(AUDIT_COLUMN)


def create_namespaces(spark: SparkSession, locations: dict[str, str]) -> None:
    """``CREATE DATABASE IF NOT EXISTS name LOCATION path`` per layer."""
    for name, location in locations.items():
        safe = location.replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{safe}'")
