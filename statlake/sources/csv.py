"""CSV files (S1): header row, every column read as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    multiline: bool = False,
    schema: StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read delimited text with a header row; all values stay strings.

    * ``multiline=True`` lets a quoted field hold newlines (metadata files
      with long descriptions). Such a file cannot be split, so it is one
      task per file: use it for metadata, not for large fact files.
    * a doubled quote inside a quoted field is an escaped quote.
    * ``columns`` declares the header names up front (all strings), which
      skips the pass that would otherwise read the header.
    """
    if schema is None and columns is not None:
        schema = StructType([StructField(c, StringType(), True) for c in columns])
    reader = (
        spark.read.option("header", "true")
        .option("multiLine", "true" if multiline else "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", "false")
        .option("mode", "PERMISSIVE")
    )
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.csv(path if isinstance(path, str) else list(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write with a header, quoting like ``read_csv`` expects."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", "false")
        .csv(path)
    )


#: column that holds a torn record's text
TORN = "__statlake_torn"


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], multiline: bool = False) -> DataFrame:
    """Like :func:`read_csv`, with every record kept and told apart: further columns ``record`` (the text of
    a torn record, else NULL), ``file`` and ``reason``.

    A record is torn when it has fewer or more fields than the header. Its cells are filled from the
    left, as far as they go.
    """
    if TORN in columns or {"record", "file", "reason"} & set(columns):
        raise ValueError("record, file and reason are added here")
    schema = StructType([StructField(c, StringType(), True) for c in [*columns, TORN]])
    raw = (
        spark.read.option("header", "true").option("multiLine", str(multiline).lower()).option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", TORN).option("enforceSchema", "true")
        .schema(schema).csv(path if isinstance(path, str) else list(path))
    )
    last = F.col("`" + columns[-1].replace("`", "``") + "`")
    # a full last cell in a torn record means that more followed
    reason = F.when(F.col(TORN).isNotNull(), F.when(last.isNotNull(), "too many fields").otherwise("too few fields"))
    return raw.select(
        *["`" + c.replace("`", "``") + "`" for c in columns], F.col(TORN).alias("record"), F.input_file_name().alias("file"), reason.alias("reason")
    )


def land_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], out: str, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Read raw files once into a landed table that splits torn records off.

    Returns the whole rows (``columns``) and the ledger of rejected records (``file, reason, record``), both
    read from the landed parquet by a partition filter; the raw text is parsed once.
    """
    from statlake.sources.tables import read_table, write_table

    checked = read_csv_checked(spark, path, columns, multiline).withColumn("torn", F.col("record").isNotNull())
    write_table(checked, out, partition_by="torn", sanitize=False, audit=False)
    landed = read_table(spark, out)
    return landed.filter("NOT torn").select(*["`" + c.replace("`", "``") + "`" for c in columns]), landed.filter("torn").select("file", "reason", "record")
