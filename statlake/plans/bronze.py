"""Bronze jobs (G1-G4): land raw workbooks and CSV files as parquet tables.

Bronze keeps the source's content as text, with sanitised headers (except
the macro-series sheets, whose headers are country names, i.e. data).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from statlake.functions.names import sanitize_columns
from statlake.layout import GemSource, Layout, StatsSource
from statlake.operators.shape import align_union, common_columns
from statlake.sources.csv import read_csv
from statlake.sources.tables import create_namespaces, write_table
from statlake.sources.xlsx import read_xlsx

UNODC_HEADER_ROW = 2  # two title rows above the header


# ---------------------------------------------------------------- transforms

def country_metadata(frames: list[tuple[DataFrame, StatsSource]]) -> DataFrame:
    """The four country metadata files as one de-duplicated table."""
    cleaned = []
    for df, src in frames:
        if src.country_renames:
            df = df.withColumnsRenamed(dict(src.country_renames))
        df = df.drop(*src.country_drop)
        cleaned.append(sanitize_columns(df))
    return align_union(cleaned, allow_missing=True).distinct()


def series_metadata(frames: list[tuple[DataFrame, StatsSource]]) -> DataFrame:
    """The series metadata files, narrowed to the columns all of them share."""
    cleaned = []
    for df, src in frames:
        df = sanitize_columns(df)
        if src.series_renames:
            df = df.withColumnsRenamed(dict(src.series_renames))
        cleaned.append(df)
    names = common_columns(*cleaned)
    return align_union([d.select(*names) for d in cleaned]).distinct()


# ------------------------------------------------------------------- runners

def _at_once(jobs: Sequence[Callable[[], None]], threads: int = 8) -> None:
    """Submit independent jobs together: a workbook is one task, so a cluster
    would stand idle if they ran one after the other. The first failure is raised."""
    with ThreadPoolExecutor(threads) as pool:
        for done in [pool.submit(inheritable_thread_target(job)) for job in jobs]:
            done.result()


def bronze_unodc(spark: SparkSession, layout: Layout) -> None:
    """G1: crime/justice workbooks (header on the third row)."""

    def land(name: str, file: str) -> None:
        sheet = read_xlsx(spark, layout.raw(file), header_row=UNODC_HEADER_ROW, first_blank_header="_c0")
        write_table(sheet, layout.bronze(name), sanitize=True)

    _at_once([partial(land, name, file) for name, file in layout.unodc])


def bronze_wb_metadata(spark: SparkSession, layout: Layout) -> None:
    """Country and series metadata (quoted newlines: multi-line CSV)."""
    countries = [(read_csv(spark, layout.raw(s.country_file), multiline=True), s) for s in layout.stats]
    write_table(country_metadata(countries), layout.bronze("wb_non_gem_countries"), sanitize=False)
    series = [(read_csv(spark, layout.raw(s.series_file), multiline=True), s) for s in layout.stats]
    write_table(series_metadata(series), layout.bronze("wb_non_gem_indicators"), sanitize=False)


def bronze_wb_stats(spark: SparkSession, layout: Layout) -> None:
    """Wide statistics files and EdStats, as text, headers sanitised."""
    for s in layout.stats:
        write_table(read_csv(spark, layout.raw(s.data_file)), layout.bronze(s.name), sanitize=True)
    write_table(read_csv(spark, layout.raw(layout.edstats_file)), layout.bronze("wb_edstats"), sanitize=True)


def bronze_gem(spark: SparkSession, layout: Layout) -> None:
    """One table per (workbook, frequency sheet); headers kept verbatim.

    The first row under the header is dropped and the blank first header
    becomes ``Year``.
    """

    def land(src: GemSource, freq: str) -> None:
        sheet = read_xlsx(spark, layout.raw(src.file), sheet=freq, header_row=0, skip_rows_after_header=1)
        write_table(sheet, layout.bronze(src.bronze_name(freq)), sanitize=False)

    _at_once([partial(land, src, freq) for src in layout.gem for freq in src.frequencies])


def run_bronze(spark: SparkSession, layout: Layout) -> None:
    create_namespaces(spark, layout.namespaces())
    bronze_unodc(spark, layout)
    bronze_wb_metadata(spark, layout)
    bronze_wb_stats(spark, layout)
    bronze_gem(spark, layout)


def run_all(spark: SparkSession, layout: Layout) -> None:
    """raw -> bronze -> silver -> gold, in dependency order."""
    from statlake.plans.gold import run_gold
    from statlake.plans.silver import run_silver

    run_bronze(spark, layout)
    run_silver(spark, layout)
    run_gold(spark, layout)
