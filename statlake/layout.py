"""Table registry (S12): where every raw file and layer table lives.

``Layout(root)`` replaces hard-coded paths: raw files under ``root/raw``,
tables under ``root/{bronze,silver,gold}/<name>``. Each source carries its
family and frequencies as fields, so jobs never pick tables by matching
substrings of their names.
"""

from __future__ import annotations

from dataclasses import dataclass

FREQUENCIES = ("annual", "quarterly", "monthly")


@dataclass(frozen=True)
class GemSource:
    """One macro-series workbook: a sheet per frequency, a column per country."""

    indicator: str
    file: str
    frequencies: tuple[str, ...]

    def bronze_name(self, frequency: str) -> str:
        return f"{self.indicator}_{frequency}"


@dataclass(frozen=True)
class StatsSource:
    """One wide statistics CSV (a column per year) with its metadata files."""

    name: str
    data_file: str
    country_file: str
    series_file: str
    # header names that differ from the common ones in this source
    renames: tuple[tuple[str, str], ...] = ()
    country_renames: tuple[tuple[str, str], ...] = ()
    series_renames: tuple[tuple[str, str], ...] = ()
    country_drop: tuple[str, ...] = ("Alternative conversion factor",)


# The published source files the jobs land, as named by their
# publishers (World Bank GEM, EdStats, Gender/HNP/IDS/Jobs; UNODC CTS).
GEM_SOURCES = (
    GemSource("wb_gem_cpi_yoy_nominal", "GemDataEXTR/unzipped/CPI Price, % y-o-y, nominal, seas. adj..xlsx", ("annual", "monthly")),
    GemSource("wb_gem_core_cpi_seas_adj", "GemDataEXTR/unzipped/Core CPI, seas. adj..xlsx", ("annual", "monthly")),
    GemSource("wb_real_exchange_rate", "GemDataEXTR/unzipped/Real Effective Exchange Rate.xlsx", ("annual", "monthly")),
    GemSource(
        "wb_official_exchange_rate",
        "GemDataEXTR/unzipped/Official exchange rate, LCU per USD, period average.xlsx",
        ("annual", "monthly"),
    ),
    GemSource(
        "wb_gdp_current", "GemDataEXTR/unzipped/GDP at market prices, current US$, millions, seas. adj..xlsx", ("annual", "quarterly")
    ),
    GemSource(
        "wb_gdp_constant",
        "GemDataEXTR/unzipped/GDP at market prices, constant 2010 US$, millions, seas. adj..xlsx",
        ("annual", "quarterly"),
    ),
    GemSource(
        "wb_export_merch",
        "GemDataEXTR/unzipped/Exports Merchandise, Customs, current US$, millions, seas. adj..xlsx",
        ("annual", "quarterly", "monthly"),
    ),
    GemSource(
        "wb_import_merch",
        "GemDataEXTR/unzipped/Imports Merchandise, Customs, current US$, millions, seas. adj..xlsx",
        ("annual", "quarterly", "monthly"),
    ),
    GemSource("wb_unemployment", "GemDataEXTR/unzipped/Unemployment Rate, seas. adj..xlsx", ("annual", "monthly")),
    GemSource(
        "wb_industrial_production",
        "GemDataEXTR/unzipped/Industrial Production, constant 2010 US$, seas. adj..xlsx",
        ("annual", "monthly"),
    ),
    GemSource("wb_total_reserves", "GemDataEXTR/unzipped/Total Reserves.xlsx", ("annual", "monthly")),
    GemSource("wb_stock_markets", "GemDataEXTR/unzipped/Stock Markets, US$.xlsx", ("annual", "monthly")),
    GemSource("wb_foreign_reserves", "GemDataEXTR/unzipped/Foreign Reserves, Months Import Cover, Goods.xlsx", ("annual", "monthly")),
    GemSource(
        "wb_retail_sales_volume_index", "GemDataEXTR/unzipped/Retail Sales Volume Index, seas. adj..xlsx", ("annual", "monthly")
    ),
)

STATS_SOURCES = (
    StatsSource(
        "wb_gender_stats",
        "Gender_Stats_CSV/unzipped/Gender_StatsCSV.csv",
        "Gender_Stats_CSV/unzipped/Gender_StatsCountry.csv",
        "Gender_Stats_CSV/unzipped/Gender_StatsSeries.csv",
    ),
    StatsSource(
        "wb_hnp_stats",
        "HNP_Stats_CSV/unzipped/HNP_StatsCSV.csv",
        "HNP_Stats_CSV/unzipped/HNP_StatsCountry.csv",
        "HNP_Stats_CSV/unzipped/HNP_StatsSeries.csv",
    ),
    StatsSource(
        "wb_ids_stats",
        "IDS_CSV/unzipped/IDS_ALLCountries_Data.csv",
        "IDS_CSV/unzipped/IDS_CountryMetaData.csv",
        "IDS_CSV/unzipped/IDS_SeriesMetaData.csv",
        renames=(("series_name", "indicator_name"), ("series_code", "indicator_code")),
        country_renames=(("Code", "Country Code"), ("PPP survey years", "PPP survey year")),
        series_renames=(("code", "series_code"),),
        country_drop=(),
    ),
    StatsSource(
        "wb_jobs_stats",
        "Jobs_CSV/unzipped/JobsCSV.csv",
        "Jobs_CSV/unzipped/JobsCountry.csv",
        "Jobs_CSV/unzipped/JobsSeries.csv",
    ),
)

EDSTATS_FILE = "Edstats_Updated/Edstats_Updated.csv"

UNODC_SOURCES = (
    ("unodc_func_justice", "data_cts_access_and_functioning_of_justice/data_cts_access_and_functioning_of_justice.xlsx"),
    ("unodc_econ_crime", "data_cts_corruption_and_economic_crime/data_cts_corruption_and_economic_crime.xlsx"),
    ("unodc_sexual_violent", "data_cts_violent_and_sexual_crime/data_cts_violent_and_sexual_crime.xlsx"),
)

# The four identifier columns of a wide statistics table after
# sanitising, and the year headers read from it (first and last, inclusive).
STATS_ID_COLUMNS = ("country_name", "country_code", "indicator_name", "indicator_code")
STATS_YEARS = (1960, 2029)
# Fixed value: year headers in EdStats are 'yr' + four digits, any case.
EDSTATS_YEAR_HEADER = r"yr\d{4}"


def year_headers(first: int, last: int) -> str:
    """Pattern of the headers that name a year from ``first`` to ``last``."""
    return "|".join(str(y) for y in range(first, last + 1))


@dataclass(frozen=True)
class Layout:
    root: str
    gem: tuple[GemSource, ...] = GEM_SOURCES
    stats: tuple[StatsSource, ...] = STATS_SOURCES
    unodc: tuple[tuple[str, str], ...] = UNODC_SOURCES
    edstats_file: str = EDSTATS_FILE

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def raw(self, relative: str) -> str:
        return self._join("raw", relative)

    def bronze(self, name: str) -> str:
        return self._join("bronze", name)

    def silver(self, name: str) -> str:
        return self._join("silver", name)

    def gold(self, name: str) -> str:
        return self._join("gold", name)

    def ledger(self) -> str:
        """Folder of the run ledger (control totals of every table written)."""
        return self._join("ledger")

    def namespaces(self) -> dict[str, str]:
        return {layer: self._join(layer) for layer in ("bronze", "silver", "gold")}

    @classmethod
    def from_mapping(cls, mapping: dict) -> "Layout":
        """Build from a parsed config.

        ``root`` is required. Optional: ``edstats_file``; ``gem`` (list of
        ``{indicator, file, frequencies}``); ``stats`` (list of ``{name,
        data_file, country_file, series_file}`` plus optional ``renames``,
        ``country_renames``, ``series_renames`` as ``[old, new]`` pairs and
        ``country_drop``); ``unodc`` (list of ``{name, file}``). Lists that
        are given replace the defaults.
        """
        kwargs: dict = {"root": mapping["root"]}
        if "edstats_file" in mapping:
            kwargs["edstats_file"] = mapping["edstats_file"]
        if "gem" in mapping:
            kwargs["gem"] = tuple(
                GemSource(g["indicator"], g["file"], tuple(g["frequencies"])) for g in mapping["gem"]
            )
        if "stats" in mapping:
            pairs = lambda items: tuple(tuple(p) for p in items or ())
            kwargs["stats"] = tuple(
                StatsSource(
                    s["name"], s["data_file"], s["country_file"], s["series_file"],
                    renames=pairs(s.get("renames")),
                    country_renames=pairs(s.get("country_renames")),
                    series_renames=pairs(s.get("series_renames")),
                    country_drop=tuple(s.get("country_drop", ("Alternative conversion factor",))),
                )
                for s in mapping["stats"]
            )
        if "unodc" in mapping:
            kwargs["unodc"] = tuple((u["name"], u["file"]) for u in mapping["unodc"])
        return cls(**kwargs)

    @classmethod
    def from_yaml(cls, path: str) -> "Layout":
        """Build from a YAML file with the keys of ``from_mapping``."""
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - yaml is optional
            raise RuntimeError("PyYAML is needed to read a YAML layout; use from_mapping") from exc
        with open(path, encoding="utf-8") as fh:
            return cls.from_mapping(yaml.safe_load(fh))
