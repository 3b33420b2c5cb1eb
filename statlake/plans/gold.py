"""Gold jobs (G9-G13): conformed country dimension and analysis-ready facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from statlake.functions.measures import clean_measure, recode
from statlake.operators.dims import conform_dim
from statlake.operators.joins import denormalize, join_dim
from statlake.operators.shape import align_union, normalize_period
from statlake.layout import Layout
from statlake.plans.landing import land
from statlake.sources.tables import create_namespaces, drop_audit, read_table

# The columns of the gold tables.
EDSTATS_COLUMNS = (
    "country_name", "indicator_name", "sex", "urbanization", "age", "unit_type", "unit_measure", "year", "value",
)
UNODC_FACT_COLUMNS = ("indicator", "dimension", "category", "sex", "age", "year", "value", "source")

S = StringType()
SILVER_UNODC_FACT = StructType(
    [StructField(c, S) for c in ("indicator", "dimension", "category", "sex", "age")]
    + [StructField("year", IntegerType()), StructField("value", FloatType()), StructField("source", S),
       StructField("country_code", S)]
)
SILVER_NON_GEM_FACT = StructType(
    [StructField("indicator_code", S), StructField("year", IntegerType()), StructField("value", FloatType()),
     StructField("country_code", S)]
)
SILVER_GEM = StructType(
    [StructField("year", S), StructField("period", DateType()), StructField("country", S), StructField("value", DoubleType()),
     StructField("indicator", S), StructField("frequency", S)]
)


DIM_COUNTRY_WB = "country_code string, country_name string"
DIM_COUNTRY_UNODC = "country_code string, country string, region string, subregion string"
DIM_COUNTRY = "country_code string, country_name string, region string, subregion string"
DIM_INDICATOR = "indicator_code string, indicator_name string"
SILVER_EDSTATS = StructType([StructField(c, S) for c in EDSTATS_COLUMNS])


def gold_dim_country(dim_wb: DataFrame, dim_unodc: DataFrame) -> DataFrame:
    """Every country code once, WB names first, UNODC region/subregion."""
    return conform_dim(drop_audit(dim_wb), drop_audit(dim_unodc), "country_code", "country_name", "country")


def gold_unodc(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Crime facts with the country name (codes absent from the dim drop)."""
    out = join_dim(
        drop_audit(fact), drop_audit(dim_country), "country_code",
        columns={"country_name": "country_name"}, keep_fact=list(UNODC_FACT_COLUMNS),
    )
    return out.select("country_name", *UNODC_FACT_COLUMNS)


def gem_all_periods(silver: Mapping[str, DataFrame]) -> DataFrame:
    """The frequencies' facts as one union, dated (labels without a date yet are parsed).

    Output ``country, value, indicator, frequency, period``.
    """
    parts = [normalize_period(drop_audit(df), freq) for freq, df in silver.items()]
    return align_union(parts)


def gold_non_gem(fact: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame) -> DataFrame:
    """Codes -> names through both dimensions (inner joins)."""
    return denormalize(
        drop_audit(fact),
        [
            (drop_audit(dim_country), "country_code", "country_code", {"country_name": "country_name"}),
            (drop_audit(dim_indicator), "indicator_code", "indicator_code", {"indicator_name": "indicator_name"}),
        ],
        keep_fact=["year", "value"],
    ).select("country_name", "indicator_name", "year", "value")


def gold_edstats(df: DataFrame) -> DataFrame:
    """Dated, recoded, cleaned EdStats facts.

    Order matters and is kept: rows with any NULL (including an unreadable
    year) drop first, so a NULL value disappears while the text ``NA``
    survives as a NULL value; totals ``_T`` become ``T``; other
    non-numeric text drops.
    """
    df = df.select(*EDSTATS_COLUMNS)
    df = normalize_period(df, "annual", keep_frequency=False)
    df = df.dropna(how="any")
    df = recode(df, ["sex", "urbanization", "age"])
    return clean_measure(df, "value", to_type="double")


def run_gold(spark: SparkSession, layout: Layout) -> None:
    create_namespaces(spark, {"gold": layout.namespaces()["gold"]})
    dim_country = gold_dim_country(
        read_table(spark, layout.silver("dim_country_wb"), DIM_COUNTRY_WB),
        read_table(spark, layout.silver("dim_country_unodc"), DIM_COUNTRY_UNODC),
    )
    land(dim_country, layout, "gold", "dim_country", sanitize=False)
    dim_country = read_table(spark, layout.gold("dim_country"), DIM_COUNTRY)

    fact = read_table(spark, layout.silver("fact_crime_and_justice_unodc"), SILVER_UNODC_FACT)
    land(gold_unodc(fact, dim_country), layout, "gold", "fact_unodc_crime_global", sanitize=False)

    silver = {}
    for freq in ("annual", "quarterly", "monthly"):
        if any(freq in src.frequencies for src in layout.gem):
            silver[freq] = read_table(spark, layout.silver(f"fact_gem_{freq}"), SILVER_GEM)
    land(gem_all_periods(silver), layout, "gold", "fact_wb_gem_all_data", sanitize=False)

    non_gem = read_table(spark, layout.silver("fact_wb_stats_non_gem"), SILVER_NON_GEM_FACT)
    dim_indicator = read_table(spark, layout.silver("dim_indicator_wb"), DIM_INDICATOR)
    land(gold_non_gem(non_gem, dim_country, dim_indicator), layout, "gold", "fact_wb_non_gem_all_data", sanitize=False)

    ed = read_table(spark, layout.silver("fact_wb_edstats"), SILVER_EDSTATS)
    land(gold_edstats(ed), layout, "gold", "fact_edstats", partition_by="period", sanitize=False)

