"""Physical plans: the shapes the operators rely on at scale."""

from pyspark.sql import functions as F

from statlake.operators.joins import join_dim
from statlake.operators.keys import keep_first, semi_members
from statlake.operators.shape import unpivot_entities
from statlake.plans.queries import QUERIES, table

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unpivot_is_a_narrow_expand(spark):
    df = spark.createDataFrame([("1990", 1.0, 2.0)], "year string, `St. Lucia` double, B double")
    p = plan(unpivot_entities(df))
    assert "Expand" in p and "Generate" not in p and "Exchange" not in p


def test_keep_first_limits_before_the_shuffle(spark):
    c = table(spark, SF_SMALL, "customer")
    p = plan(keep_first(c, ["c_nationkey"], ["c_name"]))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_semi_join_dedups_the_key_set_first(spark):
    c = table(spark, SF_SMALL, "customer")
    n = table(spark, SF_SMALL, "nation")
    p = plan(semi_members(c, n, "c_nationkey", "n_nationkey"))
    assert "LeftSemi" in p and "HashAggregate" in p


def test_small_dimension_is_broadcast_without_a_hint(spark):
    c = table(spark, SF_SMALL, "customer")
    n = table(spark, SF_SMALL, "nation")
    df = join_dim(c, n, "c_nationkey", "n_nationkey", {"country_name": "n_name"})
    assert "BroadcastHashJoin" in plan(df)
    assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()


def test_large_side_is_not_broadcast_when_over_threshold(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["star_join"](spark, SF_SMALL)
        p = plan(df)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_scans_prune_columns_and_push_filters(spark):
    df = QUERIES["join_inner_dim"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in p
    assert "PushedFilters: [IsNotNull(n_regionkey), Not(EqualTo(n_regionkey,2))" in p


def test_flagship_aggregates_before_shuffle_and_reuses_it(spark):
    df = QUERIES["all_periods_union"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in final
    assert "ReusedExchange" in final


def test_partitioned_write_rebalances(spark, workdir):
    from statlake.sources.tables import write_table

    o = table(spark, SF_SMALL, "orders")
    df = o.hint("rebalance", "o_orderpriority")
    assert "REBALANCE" in plan(df).upper()
    write_table(o, workdir + "/t", partition_by="o_orderpriority")
    back = spark.read.parquet(workdir + "/t")
    assert back.filter(F.col("o_orderpriority") == "1-URGENT").count() == o.filter(F.col("o_orderpriority") == "1-URGENT").count()


def test_no_cross_joins_generators_or_python_in_any_query(spark):
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "Generate ", "BatchEvalPython", "ArrowEvalPython",
              "MapInPandas", "FlatMapGroupsInPandas")
    for name, build in QUERIES.items():
        p = plan(build(spark, SF_SMALL))
        found = [b.strip() for b in banned if b in p]
        assert not found, (name, found)


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_join_is_split_by_aqe(spark):
    # one key holds a third of the fact; broadcast is off so the join must shuffle
    old = _with_conf(spark, {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    })
    try:
        fact = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"), F.col("id").alias("v"))
        dim = spark.range(1001).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        out = join_dim(fact, dim, "k", columns={"name": "name"})
        assert out.count() == 300_000
        out.collect()
        final = plan(out).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        _restore(spark, old)


def test_hot_partition_value_is_written_by_several_tasks(spark, workdir):
    import glob

    from statlake.sources.tables import write_table

    old = _with_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"})
    try:
        df = spark.range(400_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")).alias("code"),
            (F.col("id") * 7).alias("v"))
        write_table(df, workdir + "/p", partition_by="code", sanitize=False)
        hot_files = glob.glob(workdir + "/p/code=HOT/*.parquet")
        assert len(hot_files) > 1  # the hot value was split over tasks, not written by one
        assert spark.read.parquet(workdir + "/p").count() == 400_000
    finally:
        _restore(spark, old)


def test_hot_key_semi_join_is_split_by_aqe(spark):
    from statlake.operators.keys import semi_members

    old = _with_conf(spark, {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    })
    try:
        fact = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("code"), F.col("id").alias("v"))
        members = spark.range(0, 1001, 2).select(F.col("id").alias("code"))  # the hot code 0 is a member
        out = semi_members(fact, members, "code")
        expected = fact.filter(F.col("code") % 2 == 0).count()
        assert out.count() == expected
        out.collect()
        final = plan(out).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final and "LeftSemi" in final
    finally:
        _restore(spark, old)


def test_dimensions_rank_distinct_rows_only(spark):
    """The hash aggregate stands below the ranking: raw rows are never sorted."""
    for name in ("extract_dim_first", "conform_dimension"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        below = p.split(", Partial")[1:]  # of each map-side WindowGroupLimit
        assert below and all("HashAggregate" in part for part in below)


def test_jobs_land_their_joined_rows_once(spark):
    """The landed rows are read by a partition filter; no join of the sources runs again."""
    for name, column in (("job_unodc_gold", "sheet"), ("job_non_gem_gold", "first")):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert f"PartitionFilters: [isnotnull({column}" in p
        assert "l_partkey" not in p and "o_custkey" not in p
