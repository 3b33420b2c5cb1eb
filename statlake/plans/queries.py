"""Operator checks on the driver's tables (``queries()`` in ``__spark_entry__``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame built (those that
check a sink or a whole job write their tables under the scratch folder when called)
with the library's operators over whole tables. The driver tables hold no
NULLs or dirty text, so each query makes the cases it needs (NULL keys,
malformed labels, text measures) from the rows themselves with ``CASE``
expressions; ``oracle.py`` makes the same cases in SQL.

Money sums use DECIMAL(18,2) and are cast to DOUBLE at the end, so the
result does not depend on summation order (exact on both engines).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.measures import cast_by_name, clean_measure, drop_incomplete, is_numeric_text, recode
from statlake.functions.names import sanitize_columns
from statlake.functions.periods import parse_period
from statlake.operators.dims import conform_dim, extract_dim, survivorship
from statlake.operators.joins import denormalize, join_dim
from statlake.operators.keys import (
    anti_members,
    count_by,
    duplicate_keys,
    keep_first,
    key_except,
    key_intersect,
    key_union,
    row_count,
    semi_members,
    sort_desc,
)
from statlake.operators.shape import (
    align_union,
    as_cells,
    unpivot_cells,
    unpivot_entities,
    unpivot_matching,
    with_literals,
)
from statlake.functions.sql import string as sql_string
from statlake.layout import EDSTATS_YEAR_HEADER, STATS_YEARS, STATS_ID_COLUMNS, StatsSource, year_headers
from statlake.session import scratch_dir
from statlake.sources.catalog import register_table
from statlake.sources.csv import land_csv, read_csv, write_csv
from statlake.sources.ledger import Controls, latest_totals
from statlake.sources.tables import accumulate, create_namespaces, deliver, drop_audit, read_table, write_table

# Fixed values used to build wide test tables from the driver's data.
# Region names are fixed by the TPC-H specification.
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Market segments (TPC-H) and the awkward column headers they become:
# a dot, an apostrophe, a comma, parentheses, as in publishers' country headers.
SEGMENT_HEADERS = {
    "AUTOMOBILE": "Auto. Mobile",
    "BUILDING": "Build'ing",
    "FURNITURE": "Furniture, Rep.",
    "HOUSEHOLD": "House hold (all)",
    "MACHINERY": "MACHINERY",
}
# Wide year columns span the whole documented range, with one header on either
# side of it (which R3 must leave out).
RANGE = range(STATS_YEARS[0], STATS_YEARS[1] + 1)
PLAIN_YEARS = [RANGE[0] - 1, *RANGE, RANGE[-1] + 1]
OTHER = "Other (n.e.s.)"  # header of the cell for values outside a fixed list


# Declared schemas of the driver's tables (as listed in FIXTURES.md). Reading
# with a declared schema skips the footer read on the driver that schema
# inference needs for every read (about 0.2 s per table here, and a driver-side
# pass over file footers at scale).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


# Wide test tables have one aggregate per column; they are written as SQL
# text so each column costs one parse on the JVM, not a gateway call per
# operation.

def money_sum(expr: str) -> Column:
    return F.expr(f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)")


def count_if_sql(cond: str) -> str:
    """Matching rows, NULL (not 0) when none: an empty cell of a wide table."""
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 END) AS BIGINT)"


def count_if(cond: str) -> Column:
    return F.expr(count_if_sql(cond))


def year_cells(df: DataFrame, keys: Sequence[Column], year: str, headers: Mapping[str, str], text: bool = False) -> DataFrame:
    """A wide table of row counts: one row for each key, one column for each header, whose SQL condition is over ``y``.

    Rows are counted by (key, year) first, in the map tasks, so the many conditions see one row for each
    group and year, whatever the number of rows. A further column ``rows_in_group`` has the total.
    """
    counted = df.groupBy(*keys, F.expr(year).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    names = [c for c in counted.columns if c not in ("y", "n")]
    kind = "CAST(CAST(SUM(CASE WHEN {} THEN n END) AS BIGINT) AS STRING)" if text else "CAST(SUM(CASE WHEN {} THEN n END) AS BIGINT)"
    cells = [F.expr(kind.format(cond)).alias(h) for h, cond in headers.items()]
    return counted.groupBy(*[F.col(f"`{n}`") for n in names]).agg(*cells, F.sum("n").alias("rows_in_group"))


def _str(c: Column) -> Column:
    return c.cast("string")


# --------------------------------------------------------------- reshape (R*)

def q_unpivot_years_prefixed(spark, d):
    """R2 on a ``YRnnnn``-wide table: orders per priority and year."""
    o = table(spark, d, "orders")
    headers = {f"YR{y}": f"y = {y}" for y in RANGE}
    # YR0000 counts what no other header does, so every row is in one cell
    headers["YR0000"] = f"y IS NULL OR y NOT BETWEEN {RANGE[0]} AND {RANGE[-1]}"
    wide = year_cells(o, [F.col("o_orderpriority")], "year(o_orderdate)", headers).drop("rows_in_group")
    return unpivot_matching(wide, EDSTATS_YEAR_HEADER, variable="year", value="value", strip_prefix=2)


def q_unpivot_years_plain(spark, d):
    """Only in-range ``nnnn`` headers are unpivoted; the listed ids are kept, other columns dropped."""
    li = table(spark, d, "lineitem")
    headers = {str(y): f"y = {y}" for y in PLAIN_YEARS}
    wide = year_cells(li, [F.col("l_returnflag"), F.col("l_linestatus")], "year(l_shipdate)", headers, text=True)
    wide = wide.withColumnRenamed("rows_in_group", "Rows In Group")
    long = unpivot_matching(
        wide, year_headers(*STATS_YEARS), variable="year", value="value", ids=["l_returnflag", "l_linestatus"], full_match=True
    )
    return cast_by_name(long, {"year": "int", "value": "float"}, default=None)


def q_unpivot_map_rows(spark, d):
    """R2 and R3 on map rows: two publishers with different headers in one stored table (a batch each), unpivoted
    into a landed fact. The generator runs in the landing job."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    first = year_cells(o, [F.col("o_orderpriority").alias("series")], "year(o_orderdate)", {f"YR{y}": f"y = {y}" for y in RANGE})
    second = year_cells(
        li, [F.concat_ws("/", "l_returnflag", "l_linestatus").alias("series")], "year(l_shipdate)", {str(y): f"y = {y}" for y in PLAIN_YEARS}
    )
    path = scratch_dir(spark, "unpivot_map_rows")
    # a header of the first publisher that the second lacks, and the other way round
    deliver(as_cells(first.withColumnRenamed("rows_in_group", "Rows (all)"), ["series"]), f"{path}/bronze", "orders")
    deliver(as_cells(second.drop("rows_in_group"), ["series"]), f"{path}/bronze", "lines")
    long = unpivot_cells(drop_audit(read_table(spark, f"{path}/bronze")), r"(?:yr)?\d{4}")
    write_table(long, f"{path}/silver", partition_by="batch")
    return drop_audit(read_table(spark, f"{path}/silver")).drop("batch")


def _segment_wide(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    label = F.date_format("o_orderdate", "yyyy'M'MM").alias("year")
    known = ", ".join(sql_string(seg) for seg in SEGMENT_HEADERS)
    return j.groupBy(label).agg(
        *[money_sum(f"CASE WHEN c_mktsegment = {sql_string(seg)} THEN o_totalprice END").alias(h)
          for seg, h in SEGMENT_HEADERS.items()],
        money_sum(f"CASE WHEN c_mktsegment IS NULL OR c_mktsegment NOT IN ({known}) THEN o_totalprice END").alias(OTHER),
    )


def q_unpivot_entities(spark, d):
    """One column per entity (headers with . ' , ( )) -> long."""
    return unpivot_entities(_segment_wide(spark, d), "year", "country", "value")


# --------------------------------------------------------------- periods (D*)

def q_period_monthly(spark, d):
    li = table(spark, d, "lineitem")
    text = F.concat(_str(F.year("l_shipdate")), F.lit("M"), _str(F.month("l_shipdate")))
    return li.select("l_orderkey", "l_linenumber", text.alias("period_text")).withColumn(
        "period", parse_period("period_text", "monthly")
    )


def q_period_quarterly(spark, d):
    li = table(spark, d, "lineitem")
    text = F.concat(_str(F.year("l_shipdate")), F.lit("Q"), _str(F.quarter("l_shipdate")))
    return li.select("l_orderkey", "l_linenumber", text.alias("period_text")).withColumn(
        "period", parse_period("period_text", "quarterly")
    )


def q_period_annual(spark, d):
    o = table(spark, d, "orders")
    text = F.concat(_str(F.year("o_orderdate")), F.lit(".0"))
    return o.select("o_orderkey", text.alias("period_text")).withColumn("period", parse_period("period_text", "annual"))


def malformed_label(event_id: Column, ts: Column) -> Column:
    k = F.pmod(event_id, F.lit(10))
    return (
        F.when(k == 0, "2000M13")
        .when(k == 1, "2000M")
        .when(k == 2, "x")
        .when(k == 3, "2000Q5")
        .when(k == 4, F.concat(_str(F.year(ts)), F.lit("M"), _str(F.month(ts))))
        .when(k == 5, "1999.5")
        .when(k == 6, "87")
        .when(k == 7, "12.0")
        .when(k == 8, "0")
        .otherwise(F.concat(_str(F.year(ts)), F.lit("Q"), _str(F.quarter(ts))))
    )


def q_period_malformed(spark, d):
    """Every label read at every frequency: bad ones give NULL, never an error."""
    e = table(spark, d, "events")
    df = e.select("event_id", malformed_label(F.col("event_id"), F.col("ts")).alias("period_text"))
    return df.select(
        "event_id",
        "period_text",
        parse_period("period_text", "monthly").alias("p_monthly"),
        parse_period("period_text", "quarterly").alias("p_quarterly"),
        parse_period("period_text", "annual").alias("p_annual"),
    )


def _region_cells(spark, d) -> DataFrame:
    """Order value per (month, region): reduced map-side before any shuffle."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
    )
    return j.groupBy(F.trunc("o_orderdate", "month").alias("month"), "r_name").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v")
    )


_LABELS = {
    "monthly": lambda m: F.date_format(m, "yyyy'M'MM"),
    "quarterly": lambda m: F.concat(_str(F.year(m)), F.lit("Q"), _str(F.quarter(m))),
    "annual": lambda m: F.concat(_str(F.year(m)), F.lit(".0")),
}


def gem_like_wide(cells: DataFrame, frequency: str) -> DataFrame:
    """A publisher-style wide sheet: period label | one column per region."""
    label = _LABELS[frequency](F.col("month")).alias("year")
    known = ", ".join(sql_string(name) for name in REGION_NAMES)
    return cells.groupBy(label).agg(
        *[F.expr(f"CAST(SUM(CASE WHEN r_name = {sql_string(name)} THEN v END) AS DOUBLE)").alias(name)
          for name in REGION_NAMES],
        F.expr(f"CAST(SUM(CASE WHEN r_name IS NULL OR r_name NOT IN ({known}) THEN v END) AS DOUBLE)").alias(OTHER),
    )


def q_all_periods_union(spark, d):
    """Flagship (G11 in miniature): three wide sheets -> one long, dated fact."""
    from statlake.plans.silver import gem_to_long
    from statlake.plans.gold import gem_all_periods

    cells = _region_cells(spark, d)
    silver = {f: gem_to_long([("order_value", gem_like_wide(cells, f))], f) for f in _LABELS}
    return gem_all_periods(silver)


# ------------------------------------------------------- cleaning (D5, D6, F*)

def measure_text(event_id: Column, user_id: Column, value: Column) -> Column:
    k = F.pmod(event_id, F.lit(9))
    uid = _str(user_id)
    return (
        F.when(k == 0, F.lit("NA"))
        .when(k == 1, _str(value.cast("decimal(12,2)")))
        .when(k == 2, F.lit("abc"))
        .when(k == 3, F.lit(""))
        .when(k == 4, F.concat(F.lit("."), uid))
        .when(k == 5, F.concat(uid, F.lit(".")))
        .when(k == 6, F.concat(F.lit("-"), uid, F.lit("e2")))
        .when(k == 7, F.concat(F.lit("+"), uid))
        .otherwise(F.lit(None).cast("string"))
    )


def _raw_measures(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", measure_text(F.col("event_id"), F.col("user_id"), F.col("value")).alias("raw"))


def q_clean_measure(spark, d):
    return clean_measure(_raw_measures(spark, d).withColumn("value", F.col("raw")), "value")


def q_numeric_gate(spark, d):
    return _raw_measures(spark, d).withColumn("is_numeric", is_numeric_text("raw"))


def q_recode_values(spark, d):
    e = table(spark, d, "events")
    k = F.pmod(F.col("event_id"), F.lit(3))
    j = F.pmod(F.col("user_id"), F.lit(4))
    df = e.select(
        "event_id",
        F.when(k == 0, "_T").when(k == 1, "F").otherwise("M").alias("sex"),
        F.when(F.col("event_type") == "view", "_T").otherwise(F.col("event_type")).alias("urbanization"),
        F.when(j == 0, "_T").when(j == 1, "_t").when(j == 2, F.lit(None)).otherwise("Y15T24").alias("age"),
    )
    return recode(df, ["sex", "urbanization", "age"])


def q_drop_incomplete(spark, d):
    e = table(spark, d, "events")
    df = e.select(
        "event_id",
        F.when(F.pmod("event_id", F.lit(4)) == 0, F.lit(None)).otherwise(F.col("event_type")).alias("kind"),
        F.when(F.pmod("user_id", F.lit(5)) == 0, F.lit(None)).otherwise(F.col("value")).alias("amount"),
    )
    return drop_incomplete(df)


# ------------------------------------------------------ projection (P*, U1)

def q_cast_by_name(spark, d):
    p = table(spark, d, "part")
    df = p.select(
        F.col("p_partkey").alias("id"),
        "p_name",
        F.when(F.pmod("p_partkey", F.lit(10)) == 0, "n/a")
        .otherwise(_str(F.col("p_retailprice").cast("decimal(12,2)")))
        .alias("value"),
        F.when(F.pmod("p_partkey", F.lit(10)) == 1, "unknown")
        .otherwise(_str(F.lit(1990) + F.pmod("p_size", F.lit(30))))
        .alias("year"),
        "p_size",
    )
    return cast_by_name(df)


def q_sanitize_headers(spark, d):
    p = table(spark, d, "part")
    messy = p.select(
        F.col("p_partkey").alias("Part Key"),
        _str(F.col("p_partkey")).alias("part_key"),
        F.col("p_name").alias("P Name (x)"),
        F.col("p_brand").alias("Brand;Code"),
        F.col("p_type").alias("TYPE=1"),
        F.col("p_size").alias("Size\tNum"),
        F.col("p_retailprice").alias("Retail, Price"),
    )
    return sanitize_columns(messy)


def q_project_alias(spark, d):
    c = table(spark, d, "customer").alias("A")
    return c.select(
        F.col("A.c_custkey").alias("customer_id"),
        F.col("A.c_name").alias("customer_name"),
        F.col("A.c_nationkey").alias("country_code"),
    )


def q_drop_rename(spark, d):
    c = table(spark, d, "customer")
    return (
        c.drop("c_acctbal", "no_such_column")
        .withColumnRenamed("c_name", "name")
        .withColumnsRenamed({"c_custkey": "id", "c_mktsegment": "segment"})
    )


def q_literal_columns(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return with_literals(c, {"source": "customer", "version": 1, "note": F.lit(None).cast("string")})


def _parties(spark, d) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return c, s


def q_common_columns_union(spark, d):
    c, s = _parties(spark, d)
    return align_union([c, s], common=True)


def q_union_all(spark, d):
    c, s = _parties(spark, d)
    return align_union([c.withColumn("kind", F.lit("customer")), s.withColumn("kind", F.lit("supplier"))], allow_missing=True)


# -------------------------------------------------------- storage (S*)

ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def q_parquet_roundtrip(spark, d):
    o = table(spark, d, "orders")
    path = scratch_dir(spark, "parquet_roundtrip")
    write_table(o, path)
    return drop_audit(read_table(spark, path, o.schema))


def q_partitioned_roundtrip(spark, d):
    o = table(spark, d, "orders")
    path = scratch_dir(spark, "partitioned_roundtrip")
    write_table(o, path, partition_by="o_orderpriority")
    return read_table(spark, path, o.schema).select(*ORDERS_COLUMNS)


def q_partition_types(spark, d):
    """Codes like ``001``, a NULL code and a date, as partition values of declared types."""
    o = table(spark, d, "orders")
    k = F.pmod("o_orderkey", F.lit(12))
    df = o.select(
        "o_orderkey",
        F.when(k == 11, F.lit(None)).otherwise(F.lpad(_str(k), 3, "0")).alias("code"),
        F.trunc("o_orderdate", "year").alias("period"),
    )
    path = scratch_dir(spark, "partition_types")
    write_table(df, path, partition_by=["code", "period"], audit=False)
    return read_table(spark, path, "o_orderkey bigint, code string, period date")


def q_audit_column(spark, d):
    """Every written row carries the write's ``insert_timestamp``.

    The timestamp itself differs per run, so the check exposes whether each
    row got one and whether it lies between the times before and after the write.
    """
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    path = scratch_dir(spark, "audit_column")
    now = lambda: F.timestamp_micros(F.lit(time.time_ns() // 1000))
    before = now()
    write_table(c, path)
    after = now()
    back = read_table(spark, path, "c_custkey bigint, c_name string, insert_timestamp timestamp")
    stamp = F.col("insert_timestamp")
    return back.select(
        "c_custkey",
        "c_name",
        stamp.isNotNull().alias("stamped"),
        (stamp >= before).alias("stamped_after_start"),
        (stamp <= after).alias("stamped_before_end"),
    )


def q_append_accumulate(spark, d):
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    first, second = o.filter(status == "F"), o.filter(status == "O")
    rest = o.filter(~status.isin("F", "O") | status.isNull())
    path = scratch_dir(spark, "append_accumulate")
    accumulate([first, second], path)  # one union, one overwrite
    write_table(rest, path, mode="append")  # a later arrival appends
    return drop_audit(read_table(spark, path, o.schema))


def _batch_key(status: Column) -> Column:
    return F.when(status.isin("F", "O"), status).otherwise("rest")


def q_idempotent_delivery(spark, d):
    """A batch lands half, lands again whole, another lands twice, and one is late: each row once."""
    o = table(spark, d, "orders")
    batch = {k: o.filter(_batch_key(F.col("o_orderstatus")) == k) for k in ("F", "O", "rest")}
    path = scratch_dir(spark, "idempotent_delivery")
    deliver(batch["F"].filter("o_orderkey % 2 = 0"), path, "F")
    deliver(batch["O"], path, "O")
    deliver(batch["F"], path, "F")
    deliver(batch["O"], path, "O")
    deliver(batch["rest"], path, "rest")
    return drop_audit(read_table(spark, path))


def q_replaced_partitions(spark, d):
    """A partitioned table overwritten by one with other partitions: nothing of the old one is left."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_dir(spark, "replaced_partitions")
    write_table(o, path, partition_by="o_orderpriority")
    urgent = F.col("o_orderpriority").substr(1, 1).isin("1", "2")
    write_table(o.filter(urgent), path, partition_by="o_orderpriority")
    return drop_audit(read_table(spark, path))


def q_contract_evolution(spark, d):
    """The stored contract is what readers see: codes stay text, and a later source adds a column."""
    o = table(spark, d, "orders")
    code = F.lpad(_str(F.pmod("o_custkey", F.lit(7))), 3, "0").alias("code")
    path = scratch_dir(spark, "contract_evolution")
    write_table(o.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_totalprice", code), path, partition_by="code")
    later = o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.year("o_orderdate").alias("o_year"), code)
    write_table(later, path, mode="append", partition_by="code", evolve=True)
    return drop_audit(read_table(spark, path))


def q_catalog_table(spark, d):
    """A table read by name after it was replaced: new partitions are there, old ones gone."""
    o = table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate")).select("o_orderkey", "o_custkey", "o_year")
    path = scratch_dir(spark, "catalog_table")
    database = f"lake_{path[-12:]}"
    create_namespaces(spark, {database: f"{path}_db"})
    write_table(o.filter("o_year % 3 <> 0"), path, partition_by="o_year", audit=False)
    register_table(spark, f"{database}.orders_by_year", path)
    write_table(o.filter("o_year % 3 <> 1"), path, partition_by="o_year", audit=False)
    register_table(spark, f"{database}.orders_by_year", path)
    return spark.table(f"{database}.orders_by_year")


def q_control_totals(spark, d):
    """Totals counted in the writing jobs, read back from the run ledger (the last run of each table counts)."""
    e, o = table(spark, d, "events"), table(spark, d, "orders")
    path = scratch_dir(spark, "control_totals")
    rejected = {"rejected": "raw IS NOT NULL AND NOT coalesce(is_numeric, false)", "missing": "raw IS NULL"}
    measures = q_numeric_gate(spark, d)
    for rows in (measures.filter("event_id % 2 = 0"), measures):
        write_table(rows, f"{path}/measures", counted=Controls("measures", rejected, f"{path}/ledger"))
    for key in ("F", "O"):
        rows = o.filter(F.col("o_orderstatus") == key)
        deliver(rows, f"{path}/orders", key, partition_by="o_orderpriority", counted=Controls("orders", {"big": "o_totalprice > 100000"}, f"{path}/ledger"))
    clicks = e.filter("event_type = 'click'")
    write_table(clicks, f"{path}/clicks", partition_by="event_type", counted=Controls("clicks", {"no_user": "user_id IS NULL"}, f"{path}/ledger"))
    return latest_totals(spark, f"{path}/ledger")


def q_csv_rejects(spark, d):
    """Files with torn records: whole rows as they are, torn ones apart with file and reason."""
    c = table(spark, d, "customer")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    k = F.pmod("c_custkey", F.lit(11))
    whole = [_str(F.col("c_custkey")), F.concat(F.lit('"'), F.col("c_name"), F.lit(', Ltd ""x"""')), F.col("c_mktsegment")]
    line = (
        F.when(k == 3, whole[0]).when(k == 5, F.concat_ws(",", *whole[:2])).when(k == 7, F.concat_ws(",", *whole, F.lit("more")))
        .otherwise(F.concat_ws(",", *whole))
    )
    folder = F.pmod("c_custkey", F.lit(4)).alias("folder")
    # every file starts with a header line
    header = spark.range(4).select(F.lit(0).alias("place"), F.lit(",".join(columns)).alias("value"), F.col("id").alias("folder"))
    lines = c.select(F.lit(1).alias("place"), line.alias("value"), folder).unionByName(header)
    path = scratch_dir(spark, "csv_rejects")
    lines.repartition("folder").sortWithinPartitions("folder", "place").drop("place").write.partitionBy("folder").text(f"{path}/raw")
    rows, torn = land_csv(spark, f"{path}/raw", columns, f"{path}/landed")
    none = F.lit(None).cast("string")
    rows = rows.select(*columns, none.alias("record"), none.alias("reason"), F.lit(False).alias("has_file"))
    torn = torn.select(*[none.alias(n) for n in columns], "record", "reason", F.col("file").contains("/raw/folder=").alias("has_file"))
    return rows.unionByName(torn)


def q_csv_roundtrip(spark, d):
    c = table(spark, d, "customer")
    df = c.select(
        _str(F.col("c_custkey")).alias("c_custkey"),
        "c_name",
        _str(F.col("c_acctbal").cast("decimal(12,2)")).alias("c_acctbal"),
        F.concat(F.col("c_name"), F.lit('\n"'), F.col("c_mktsegment"), F.lit('"')).alias("note"),
    )
    path = scratch_dir(spark, "csv_roundtrip")
    write_csv(df, path)
    return read_csv(spark, path, multiline=True, columns=df.columns)


# ---------------------------------------------------------------- joins (J*)

def _nation_subset(spark, d) -> DataFrame:
    return table(spark, d, "nation").filter(F.col("n_regionkey") != 2)


def q_join_inner_dim(spark, d):
    c = table(spark, d, "customer")
    return join_dim(
        c, _nation_subset(spark, d), "c_nationkey", "n_nationkey", {"country_name": "n_name"},
        keep_fact=["c_custkey", "c_name", "c_nationkey"],
    )


def q_left_enrich(spark, d):
    c = table(spark, d, "customer")
    return join_dim(
        c, _nation_subset(spark, d), "c_nationkey", "n_nationkey",
        {"country_name": "n_name", "region_code": "n_regionkey"},
        how="left", keep_fact=["c_custkey", "c_name", "c_nationkey"],
    )


def q_star_join(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return denormalize(
        li,
        [
            (table(spark, d, "supplier"), "l_suppkey", "s_suppkey", {"supplier_name": "s_name"}),
            (table(spark, d, "part"), "l_partkey", "p_partkey", {"part_name": "p_name"}),
        ],
    )


def _coded_customers(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    code = F.when(F.pmod("c_custkey", F.lit(10)) == 0, F.lit(None)).otherwise(F.col("c_nationkey"))
    return c.select("c_custkey", "c_name", code.alias("code"))


def _member_nations(spark, d) -> DataFrame:
    return table(spark, d, "nation").filter(F.col("n_regionkey").isin(1, 3))


def q_semi_membership(spark, d):
    return semi_members(_coded_customers(spark, d), _member_nations(spark, d), "code", "n_nationkey")


def q_anti_membership(spark, d):
    return anti_members(_coded_customers(spark, d), _member_nations(spark, d), "code", "n_nationkey")


# ---------------------------------------------------------- aggregation (A*)

def q_group_count(spark, d):
    return count_by(table(spark, d, "orders"), "o_custkey")


def q_duplicate_keys(spark, d):
    return duplicate_keys(table(spark, d, "orders"), "o_custkey")


def q_row_count(spark, d):
    return row_count(table(spark, d, "orders"))


def q_distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_tax").distinct()


def q_extract_dim(spark, d):
    return extract_dim(table(spark, d, "part"), "p_brand", ["p_type"])


def q_extract_dim_first(spark, d):
    """A third of the names is NULL; one brand has no name at all."""
    p = table(spark, d, "part")
    none = (F.pmod("p_partkey", F.lit(3)) == 0) | (F.col("p_brand") == "Brand#11")
    named = p.select("p_brand", F.when(none, F.lit(None)).otherwise(F.col("p_type")).alias("p_type"))
    return extract_dim(named, "p_brand", ["p_type"], one_per_key=True)


# ------------------------------------------------------ window / sets (W, U2, O1)

def q_keep_first(spark, d):
    """Rows whose order column is NULL come last; nation 3 has no other."""
    c = table(spark, d, "customer")
    none = (F.pmod("c_custkey", F.lit(4)) == 0) | (F.col("c_nationkey") == 3)
    return keep_first(c.withColumn("c_name", F.when(none, F.lit(None)).otherwise(F.col("c_name"))), ["c_nationkey"], ["c_name"])


def q_conform_dimension(spark, d):
    n = table(spark, d, "nation")
    primary = align_union(
        [
            n.filter(F.col("n_nationkey") < 15).select(
                F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("country_name")
            ),
            n.filter(F.col("n_nationkey") < 5).select(
                F.col("n_nationkey").alias("country_code"), F.concat(F.lit("ALT "), "n_name").alias("country_name")
            ),
            n.filter(F.col("n_regionkey") == 0).select(
                F.col("n_nationkey").alias("country_code"), F.lit(None).cast("string").alias("country_name")
            ),
        ]
    )
    s = table(spark, d, "supplier")
    secondary = s.select(
        F.when(F.pmod("s_suppkey", F.lit(13)) == 0, F.lit(None)).otherwise(F.col("s_nationkey")).alias("country_code"),
        F.when(F.pmod("s_suppkey", F.lit(2)) == 0, F.lit(None)).otherwise(F.col("s_name")).alias("country"),
        F.concat(F.lit("R"), _str(F.pmod("s_nationkey", F.lit(5)))).alias("region"),
        F.concat(F.lit("S"), _str(F.pmod("s_suppkey", F.lit(3)))).alias("subregion"),
    )
    return conform_dim(primary, secondary)


def q_survivorship(spark, d):
    """D8 over three code lists: names from the first list that has one, segments and regions from others."""
    n = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("code"), F.when(F.pmod("n_nationkey", F.lit(4)) == 0, F.lit(None)).otherwise(F.col("n_name")).alias("name")
    ).filter("code < 18")
    s = table(spark, d, "supplier").select(
        F.when(F.pmod("s_suppkey", F.lit(13)) == 0, F.lit(None)).otherwise(F.col("s_nationkey")).alias("nation"),
        F.when(F.col("s_nationkey") < 9, F.col("s_name")).alias("label"),
        F.concat(F.lit("R"), _str(F.pmod("s_suppkey", F.lit(5)))).alias("region"),
    )
    c = table(spark, d, "customer").select(
        (F.col("c_nationkey") + 3).alias("code"), F.col("c_name").alias("name"), F.lit("R9").alias("region"), F.col("c_mktsegment").alias("segment")
    )
    lists = [("nations", n, {}), ("suppliers", s, {"code": "nation", "name": "label"}), ("customers", c, {})]
    return survivorship(lists, "code", ["name", "region", "segment"])


def _key_sets(spark, d) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    a = c.select(F.when(F.pmod("c_custkey", F.lit(7)) == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("key"))
    b = s.select(F.when(F.pmod("s_suppkey", F.lit(5)) == 0, F.lit(None)).otherwise(F.col("s_nationkey") + 5).alias("key"))
    return a, b


def q_key_union(spark, d):
    return key_union(*_key_sets(spark, d))


def q_key_intersect(spark, d):
    return key_intersect(*_key_sets(spark, d))


def q_key_except(spark, d):
    return key_except(*_key_sets(spark, d))


def q_sort_desc(spark, d):
    return sort_desc(table(spark, d, "orders"), "o_totalprice")


# ------------------------------------------------ whole jobs on driver data
# The silver and gold job functions themselves, fed with publisher-shaped
# wide tables that Spark derives from the driver's tables.

def land_bronze(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a derived wide table as a bronze table and read it back.

    The jobs read stored bronze tables; each one feeds several outputs
    (fact and code lists), which then re-read a parquet table (with column
    pruning) instead of re-deriving it. The table goes to the shared
    scratch folder under ``spark.checkpoint.dir``.
    """
    path = scratch_dir(spark, name)
    bronze = sanitize_columns(df)
    write_table(bronze, path, partition_by=partition_by, sanitize=False)
    return read_table(spark, path, bronze.schema)  # declared: no footer read


def _stats_wide(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two wide statistics sources (the second with IDS-style headers)."""
    li = table(spark, d, "lineitem")
    su = table(spark, d, "supplier")
    na = table(spark, d, "nation")
    pa = table(spark, d, "part")
    base = (
        li.join(su, li.l_suppkey == su.s_suppkey)
        .join(na, F.col("s_nationkey") == na.n_nationkey)
        .join(pa, li.l_partkey == pa.p_partkey)
        .select("n_nationkey", "n_name", "p_brand", F.col("l_returnflag").eqNullSafe("R").alias("first"), F.year("l_shipdate").alias("y"))
    )
    # the three-way join runs once: both sources read the landed rows
    base = land_bronze(spark, base, "stats_lines", partition_by="first")
    cells = {str(y): f"y = {y}" for y in PLAIN_YEARS}
    code = _str(F.col("n_nationkey")).alias("country_code")
    # some countries have no name in the first source
    name = F.when(F.pmod("n_nationkey", F.lit(5)) == 0, F.lit(None)).otherwise(F.col("n_name"))
    first = year_cells(base.filter("first"), [
        name.alias("country_name"), code,
        F.concat(F.lit("Lines "), "p_brand").alias("indicator_name"), F.col("p_brand").alias("indicator_code"),
    ], "y", cells, text=True).drop("rows_in_group").withColumn("extra", F.lit("x"))
    second = year_cells(base.filter("NOT first"), [
        F.concat("n_name", F.lit(" (IDS)")).alias("country_name"), code,
        F.concat(F.lit("Lines of "), "p_brand").alias("series_name"), F.col("p_brand").alias("series_code"),
    ], "y", cells, text=True).drop("rows_in_group")
    return first, second


def q_job_non_gem_gold(spark, d):
    """G8 + G12: wide statistics -> long fact + code lists -> named gold fact."""
    from statlake.plans.gold import gold_non_gem
    from statlake.plans.silver import stats_dims, stats_to_long

    first, second = _stats_wide(spark, d)
    sources = [(first, ()), (second, (("series_name", "indicator_name"), ("series_code", "indicator_code")))]
    countries, indicators = stats_dims(sources)
    dim_country = keep_first(countries, ["country_code"], ["country_name"])
    return gold_non_gem(stats_to_long(sources), dim_country, indicators)


def edstats_cell(count: str) -> Column:
    """Text cell from a count: NULL, 'NA', '3.', 'x3' or '-3e1'."""
    c = f"({count})"
    return F.expr(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN pmod({c}, 4) = 1 THEN 'NA' "
        f"WHEN pmod({c}, 4) = 2 THEN concat(CAST({c} AS STRING), '.') "
        f"WHEN pmod({c}, 4) = 3 THEN concat('x', CAST({c} AS STRING)) "
        f"ELSE concat('-', CAST({c} AS STRING), 'e1') END"
    )


def q_job_edstats_gold(spark, d):
    """G7 + G13: a yrNNNN-wide table (one column per day, read as years)."""
    from statlake.plans.gold import gold_edstats
    from statlake.plans.silver import edstats_to_long

    e = table(spark, d, "events")
    uid = F.col("user_id")
    meta = [
        F.concat(F.lit("User "), _str(uid)).alias("country_name"),
        F.col("event_type").alias("indicator_name"),
        F.when(F.pmod(uid, F.lit(3)) == 0, "_T").when(F.pmod(uid, F.lit(3)) == 1, "F").otherwise("M").alias("sex"),
        F.when(F.col("event_type").isin("view", "click"), "_T").otherwise("U").alias("urbanization"),
        F.when(F.pmod(uid, F.lit(4)) == 0, F.lit(None)).otherwise(F.lit("_T")).alias("age"),
        F.lit("NUM").alias("unit_type"),
        F.lit("EV").alias("unit_measure"),
    ]
    cells = [
        edstats_cell(count_if_sql(f"dayofmonth(ts) = {k}")).alias(f"{'YR' if k <= 15 else 'yr'}{1990 + k}")
        for k in range(1, 32)
    ]
    wide = e.groupBy(*meta).agg(*cells)
    return gold_edstats(edstats_to_long(wide))


def _unodc_sheets(spark, d) -> list[DataFrame]:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    nk = F.col("c_nationkey")
    cols = {
        "iso3_code": F.when(F.pmod("o_orderkey", F.lit(13)) == 0, F.lit(None)).otherwise(_str(nk)),
        "country": F.concat(F.lit("Country "), _str(nk)),
        "region": F.concat(F.lit("R"), _str(F.pmod(nk, F.lit(5)))),
        "subregion": F.concat(F.lit("S"), _str(F.pmod(nk, F.lit(3)))),
        "indicator": F.col("o_orderpriority"),
        "dimension": F.col("o_orderstatus"),
        "category": F.col("c_mktsegment"),
        "sex": F.lit("Total"),
        "age": F.lit("Total"),
        "year": _str(F.year("o_orderdate")),
        "value": F.when(F.pmod("o_orderkey", F.lit(11)) == 0, F.lit("n/a")).otherwise(
            _str(F.col("o_totalprice").cast("decimal(12,2)"))
        ),
        "source": F.lit("CTS"),
    }
    # the join runs once: both sheets read the landed rows, by a partition filter
    rows = j.select(*[v.alias(k) for k, v in cols.items()], F.col("o_orderstatus").eqNullSafe("F").alias("sheet"))
    landed = drop_audit(land_bronze(spark, rows, "bronze_unodc", partition_by="sheet"))
    return [landed.filter("sheet").select(*cols), landed.filter("NOT sheet").select(*reversed(cols))]


def q_job_unodc_gold(spark, d):
    """G5 + G9 + G10: crime-style sheets -> silver dim + fact -> conformed dim -> gold."""
    from statlake.plans.gold import gold_dim_country, gold_unodc
    from statlake.plans.silver import unodc_to_silver

    dim_unodc, fact = unodc_to_silver(_unodc_sheets(spark, d))
    n = table(spark, d, "nation")
    dim_wb = n.filter(F.col("n_nationkey") < 15).select(
        _str(F.col("n_nationkey")).alias("country_code"), F.col("n_name").alias("country_name")
    )
    return gold_unodc(fact, gold_dim_country(dim_wb, dim_unodc))


def _raw_csv(spark, name: str, df: DataFrame) -> str:
    path = scratch_dir(spark, name)
    write_csv(df, path)
    return path


def q_job_bronze_metadata(spark, d):
    """Country metadata of two publishers (multi-line CSV) -> one table without repeats."""
    from statlake.plans.bronze import country_metadata

    n = table(spark, d, "nation")
    code, note = _str(F.col("n_nationkey")), F.concat("n_name", F.lit('\n"note"'))
    first = n.select(
        code.alias("Country Code"), note.alias("Short Name"), _str(F.col("n_regionkey")).alias("PPP survey year"),
        F.lit("x").alias("Alternative conversion factor"),
    )
    # the second publisher names its columns otherwise and repeats some countries
    second = n.select(
        F.concat(F.when(F.col("n_regionkey") == 1, "X").otherwise(""), code).alias("Code"), note.alias("Short Name"),
        _str(F.col("n_regionkey")).alias("PPP survey years"), F.lit("2026").alias("Extra"),
    ).drop("Extra")
    plain = StatsSource("a", "", "", "")
    renamed = StatsSource("b", "", "", "", country_renames=(("Code", "Country Code"), ("PPP survey years", "PPP survey year")), country_drop=())
    frames = [(read_csv(spark, _raw_csv(spark, "raw_countries", f), multiline=True), s) for f, s in ((first, plain), (second, renamed))]
    return country_metadata(frames)


def q_job_bronze_series(spark, d):
    """Series metadata of two publishers, narrowed to the columns they share."""
    from statlake.plans.bronze import series_metadata

    p = table(spark, d, "part")
    first = p.select(F.col("p_brand").alias("Series Code"), F.col("p_type").alias("Topic"), F.lit("long").alias("Long definition"))
    second = p.select(F.concat("p_brand", F.lit("b")).alias("Code"), F.col("p_type").alias("Topic"))
    sources = (StatsSource("a", "", "", ""), StatsSource("b", "", "", "", series_renames=(("code", "series_code"),)))
    frames = [(read_csv(spark, _raw_csv(spark, "raw_series", f), multiline=True), s) for f, s in zip((first, second), sources)]
    return series_metadata(frames)


def q_job_bronze_stats(spark, d):
    """A wide statistics file (splittable CSV) landed as text, headers sanitised."""
    o = table(spark, d, "orders")
    wide = year_cells(o, [
        F.concat(F.lit("Customer, no. "), _str(F.col("o_custkey"))).alias("Country Name"), _str(F.col("o_custkey")).alias("Country Code"),
        F.col("o_orderpriority").alias("Indicator Name"), F.substring("o_orderpriority", 1, 1).alias("Indicator Code"),
    ], "year(o_orderdate)", {str(y): f"y = {y}" for y in PLAIN_YEARS}, text=True).drop("rows_in_group")
    raw = read_csv(spark, _raw_csv(spark, "raw_stats", wide), columns=wide.columns)
    bronze = drop_audit(land_bronze(spark, raw, "bronze_stats"))
    some = [c for c in bronze.columns if c not in STATS_ID_COLUMNS]
    # one row for each customer and priority: the years as one text, so the check compares all cells
    return bronze.select(*STATS_ID_COLUMNS, F.concat_ws(" ", *[F.coalesce(F.col(f"`{c}`"), F.lit("-")) for c in some]).alias("cells"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
