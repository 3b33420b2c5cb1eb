"""Silver jobs (G5-G8): long, typed facts and their code lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from statlake.functions.measures import cast_by_name
from statlake.functions.periods import parse_period
from statlake.layout import EDSTATS_YEAR_HEADER, STATS_ID_COLUMNS, STATS_YEARS, Layout, year_headers
from statlake.operators.dims import extract_dim
from statlake.functions.sql import ident, string
from statlake.operators.shape import align_union, unpivot_entities, unpivot_matching
from statlake.plans.landing import land
from statlake.sources.tables import create_namespaces, drop_audit, read_table

UNODC_COUNTRY_COLUMNS = ("country_code", "country", "region", "subregion")


# ------------------------------------------------------------------ G5 UNODC

def unodc_to_silver(sheets: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(dim_country_unodc, fact_crime_and_justice_unodc) from bronze sheets.

    The dimension is the distinct country columns as text; the fact keeps
    the code and every other column, ``value`` as FLOAT, ``year`` as INT,
    the rest as text.
    """
    renamed = [drop_audit(s).withColumnRenamed("iso3_code", "country_code") for s in sheets]
    dim = align_union([s.select(*UNODC_COUNTRY_COLUMNS) for s in renamed]).distinct()
    dim = cast_by_name(dim, {}, default="string")
    facts = [cast_by_name(s.drop(*UNODC_COUNTRY_COLUMNS[1:])) for s in renamed]
    return dim, align_union(facts, allow_missing=True)


# ------------------------------------------------------------------- G6 GEM

def _year_column(df: DataFrame) -> str:
    for c in df.columns:
        if c.lower() == "year":
            return c
    raise ValueError(f"no Year column in {df.columns}")


_PERIOD = "__statlake_period"


def gem_to_long(sheets: Sequence[tuple[str, DataFrame]], frequency: str) -> DataFrame:
    """One frequency of macro series: ``(indicator, wide sheet)`` pairs ->
    ``year, period, country, value, indicator, frequency``.

    Each sheet is unpivoted (a narrow Expand, no shuffle); empty cells stay
    as NULL values; ``year`` keeps the label's text, ``period`` is its date.
    """
    longs = []
    for indicator, sheet in sheets:
        sheet = drop_audit(sheet)
        year = _year_column(sheet)
        # the label is dated once per sheet row, before it is repeated per country
        dated = sheet.withColumn(_PERIOD, parse_period(year, frequency))
        long = unpivot_entities(dated, year, "country", "value", value_type="double", keep=[_PERIOD])
        longs.append(
            long.selectExpr(
                f"CAST({ident(year)} AS STRING) AS year",
                f"{_PERIOD} AS period",
                "country",
                "value",
                f"{string(indicator)} AS indicator",
                f"{string(frequency)} AS frequency",
            )
        )
    return align_union(longs)


# --------------------------------------------------------------- G7 EdStats

def edstats_to_long(df: DataFrame) -> DataFrame:
    """``yrNNNN`` columns -> ``year`` (text, prefix removed) and ``value``."""
    return unpivot_matching(drop_audit(df), EDSTATS_YEAR_HEADER, "year", "value", strip_prefix=2)


# ----------------------------------------------------------- G8 statistics

def _standard_ids(df: DataFrame, renames: Sequence[tuple[str, str]]) -> DataFrame:
    for old, new in renames:
        df = df.withColumnRenamed(old, new)
    return drop_audit(df)


def stats_to_long(
    sources: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]], years: tuple[int, int] = STATS_YEARS
) -> DataFrame:
    """Wide statistics tables -> ``country_code, indicator_code, year, value``.

    Only the four id columns are kept; year headers outside ``years`` (first
    and last, inclusive; the publishers' 1960-2029 by default) are ignored;
    ``year`` INT and ``value`` FLOAT (unreadable text -> NULL).
    """
    longs = []
    for df, renames in sources:
        df = _standard_ids(df, renames)
        long = unpivot_matching(df, year_headers(*years), "year", "value", ids=list(STATS_ID_COLUMNS), full_match=True)
        longs.append(long.select("country_code", "indicator_code", "year", "value"))
    return cast_by_name(align_union(longs), {"year": "int", "value": "float"}, default=None)


def stats_dims(sources: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]]) -> tuple[DataFrame, DataFrame]:
    """(dim_country_wb, dim_indicator_wb) from the wide tables' id columns.

    Taken before the unpivot, so the scan reads only two columns and does
    not pay for the (rows x years) expansion. Indicators keep one name per
    code, so a code published by two sources cannot fan out a later join.
    """
    ids = align_union([_standard_ids(df, r).select(*STATS_ID_COLUMNS) for df, r in sources])
    countries = extract_dim(ids, "country_code", ["country_name"])
    indicators = extract_dim(ids, "indicator_code", ["indicator_name"], one_per_key=True)
    return countries, indicators


# ------------------------------------------------------------------- runners

#: rows a run is checked by: facts and codes that lack what the gold layer joins on or measures
_FACT_CONTROLS = {"null_codes": "country_code IS NULL", "null_values": "value IS NULL"}


def run_silver(spark: SparkSession, layout: Layout) -> None:
    create_namespaces(spark, {"silver": layout.namespaces()["silver"]})
    # bronze tables are read by their stored contract: nothing is inferred from files or folder names
    # G5
    sheets = [read_table(spark, layout.bronze(name)) for name, _ in layout.unodc]
    dim, fact = unodc_to_silver(sheets)
    land(dim, layout, "silver", "dim_country_unodc", sanitize=False, controls={"null_codes": "country_code IS NULL"})
    land(fact, layout, "silver", "fact_crime_and_justice_unodc", partition_by="country_code", sanitize=False, controls=_FACT_CONTROLS)

    # One table per frequency, one write each
    for freq in ("annual", "quarterly", "monthly"):
        pairs = [
            (src.indicator, read_table(spark, layout.bronze(src.bronze_name(freq))))
            for src in layout.gem
            if freq in src.frequencies
        ]
        if pairs:
            unread = {"null_values": "value IS NULL", "undated": "period IS NULL"}
            land(gem_to_long(pairs, freq), layout, "silver", f"fact_gem_{freq}", controls=unread)

    # G7
    ed = read_table(spark, layout.bronze("wb_edstats"))
    land(edstats_to_long(ed), layout, "silver", "fact_wb_edstats", controls={"null_values": "value IS NULL"})

    # G8
    sources = [(read_table(spark, layout.bronze(s.name)), s.renames) for s in layout.stats]
    countries, indicators = stats_dims(sources)
    land(countries, layout, "silver", "dim_country_wb", controls={"null_codes": "country_code IS NULL"})
    land(indicators, layout, "silver", "dim_indicator_wb")
    land(stats_to_long(sources), layout, "silver", "fact_wb_stats_non_gem", partition_by="country_code", controls=_FACT_CONTROLS)
