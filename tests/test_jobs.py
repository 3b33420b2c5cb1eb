import datetime as dt

from statlake.plans.bronze import run_all
from statlake.sources.tables import read_table

from .raw_fixtures import build


def _key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


def rows(spark, path, cols):
    df = read_table(spark, path)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_all_jobs_end_to_end_and_idempotent(spark, workdir):
    layout = build(workdir)
    for _ in range(2):  # a rerun overwrites, giving the same tables
        run_all(spark, layout)

        countries = read_table(spark, layout.bronze("wb_non_gem_countries"))
        assert countries.columns == ["country_code", "short_name", "ppp_survey_year", "insert_timestamp"]
        assert rows(spark, layout.bronze("wb_non_gem_countries"), ["country_code", "short_name"]) == [
            ("AFG", "Afghan\nistan"),  # the same row in two files: kept once
            ("BEL", 'Bel "gium"'),
        ]
        series = read_table(spark, layout.bronze("wb_non_gem_indicators"))
        assert series.columns == ["series_code", "topic", "indicator_name", "insert_timestamp"]  # common columns
        assert series.count() == 2

        dim = rows(spark, layout.gold("dim_country"), ["country_code", "country_name", "region", "subregion"])
        assert dim == [
            ("AFG", "Afghanistan", "Asia", "Southern Asia"),
            ("BEL", "Belgium", "Europe", "Western Europe"),
            ("XKX", "Kosovo", "Europe", "Eastern Europe"),
            ("ZZZ", "Nowhere", "Oceania", "Polynesia"),
        ]

        crime = rows(spark, layout.gold("fact_unodc_crime_global"), ["country_name", "indicator", "year", "value"])
        assert crime == [
            ("Afghanistan", "Bribery", 2015, 12.5),
            ("Belgium", "Prisoners", 2017, 200.0),
            ("Kosovo", "Bribery", 2016, 3.0),
            ("Kosovo", "Prisoners", 2017, 100.0),
            ("Nowhere", "Bribery", 2016, None),
        ]

        gem = rows(spark, layout.gold("fact_wb_gem_all_data"), ["indicator", "frequency", "country", "period", "value"])
        d = dt.date
        assert gem == sorted([
            ("wb_gdp_current", "annual", "St. Lucia", d(1987, 1, 1), 1.5),
            ("wb_gdp_current", "annual", "Cote d'Ivoire", d(1987, 1, 1), None),
            ("wb_gdp_current", "annual", "Korea, Rep.", d(1987, 1, 1), 3.0),
            ("wb_gdp_current", "annual", "St. Lucia", d(1988, 1, 1), 2.5),
            ("wb_gdp_current", "annual", "Cote d'Ivoire", d(1988, 1, 1), 4.0),
            ("wb_gdp_current", "annual", "Korea, Rep.", d(1988, 1, 1), None),
            ("wb_gdp_current", "quarterly", "St. Lucia", d(1987, 1, 1), 1.0),
            ("wb_gdp_current", "quarterly", "Cote d'Ivoire", d(1987, 1, 1), 2.0),
            ("wb_gdp_current", "quarterly", "Korea, Rep.", d(1987, 1, 1), 3.0),
            ("wb_gdp_current", "quarterly", "St. Lucia", None, 9.0),
            ("wb_gdp_current", "quarterly", "Cote d'Ivoire", None, 9.0),
            ("wb_gdp_current", "quarterly", "Korea, Rep.", None, 9.0),
            ("wb_gdp_current", "monthly", "St. Lucia", d(1987, 1, 1), 1.25),
            ("wb_gdp_current", "monthly", "Cote d'Ivoire", d(1987, 1, 1), None),
            ("wb_gdp_current", "monthly", "Korea, Rep.", d(1987, 1, 1), None),
            ("wb_gdp_current", "monthly", "St. Lucia", None, 5.0),
            ("wb_gdp_current", "monthly", "Cote d'Ivoire", None, 5.0),
            ("wb_gdp_current", "monthly", "Korea, Rep.", None, 5.0),
            ("wb_unemployment", "annual", "St. Lucia", d(2001, 1, 1), 7.5),
            ("wb_unemployment", "annual", "Notes", d(2001, 1, 1), None),
            ("wb_unemployment", "annual", "St. Lucia", None, 8.5),
            ("wb_unemployment", "annual", "Notes", None, None),
            ("wb_unemployment", "monthly", "St. Lucia", d(2001, 2, 1), 6.5),
        ], key=_key)

        non_gem = rows(spark, layout.gold("fact_wb_non_gem_all_data"), ["country_name", "indicator_name", "year", "value"])
        assert non_gem == sorted([
            ("Afghanistan", "Debt", 1960, 5.0),
            ("Afghanistan", "Debt", 1961, None),
            ("Afghanistan", "Population", 1960, 7.0),
            ("Afghanistan", "Population", 1960, 10.0),
            ("Afghanistan", "Population", 1961, 8.0),
            ("Afghanistan", "Population", 2029, 20.0),
            ("Belgium", "Population", 1960, 11.0),
            ("Belgium", "Population", 2029, None),
        ], key=_key)

        ed = rows(spark, layout.gold("fact_edstats"), ["country_name", "sex", "urbanization", "age", "period", "value"])
        assert ed == sorted([
            ("Afghanistan", "F", "T", "Y15T24", d(1970, 1, 1), -300.0),
            ("Afghanistan", "T", "T", "T", d(1970, 1, 1), None),
            ("Afghanistan", "T", "T", "T", d(1999, 1, 1), 1.0),
            ("Afghanistan", "T", "T", "T", d(2000, 1, 1), 0.5),
            ("Belgium", "M", "U", "T", d(1970, 1, 1), -999.999),
            ("Belgium", "M", "U", "T", d(2000, 1, 1), 12.0),
        ], key=_key)


def test_default_layout_with_published_names(spark, workdir):
    """All 14 series and 3 crime workbooks under their published names, from a file:// root."""
    import os

    from statlake.layout import GEM_SOURCES, STATS_SOURCES, UNODC_SOURCES, Layout

    from .raw_fixtures import write_text
    from .xlsx_fixture import write_xlsx

    local = Layout(workdir)
    label = {"annual": 1987.0, "quarterly": "1987Q2", "monthly": "1987M03"}
    for i, g in enumerate(GEM_SOURCES):
        os.makedirs(os.path.dirname(local.raw(g.file)), exist_ok=True)
        write_xlsx(local.raw(g.file), {f: [[None, "Korea, Rep."], ["%"], [label[f], i + 0.5]] for f in g.frequencies})
    header = ["Iso3_code", "Country", "Region", "Subregion", "Indicator", "Dimension", "Category", "Sex", "Age", "Year", "VALUE", "Source"]
    for i, (name, file) in enumerate(UNODC_SOURCES):
        os.makedirs(os.path.dirname(local.raw(file)), exist_ok=True)
        row = ["KOR", "Korea", "Asia", "Eastern Asia", name, "Total", "Total", "Total", "Total", 2015, i + 1, "CTS"]
        write_xlsx(local.raw(file), {"data": [["title"], [], header, row]})
    for i, s in enumerate(STATS_SOURCES):
        ids = "Series Name,Series Code" if s.renames else "Indicator Name,Indicator Code"
        write_text(local.raw(s.data_file), f"Country Name,Country Code,{ids},1960\nKorea,KOR,Population,P{i},{i}\n")
        code, survey = ("Code", "PPP survey years") if s.country_renames else ("Country Code", "PPP survey year")
        write_text(local.raw(s.country_file), f"{code},Short Name,{survey}\nKOR,Korea,2011\n")
        write_text(local.raw(s.series_file), ("Code" if s.series_renames else "Series Code") + ",Topic\nP,Health\n")
    write_text(local.raw(local.edstats_file), "country_name,indicator_name,sex,urbanization,age,unit_type,unit_measure,YR1970\nKorea,Enrolment,_T,_T,_T,NUM,PS,7\n")

    layout = Layout("file://" + workdir)
    run_all(spark, layout)
    gem = rows(spark, layout.gold("fact_wb_gem_all_data"), ["indicator", "frequency", "value", "period"])
    day = {"annual": dt.date(1987, 1, 1), "quarterly": dt.date(1987, 4, 1), "monthly": dt.date(1987, 3, 1)}
    assert gem == sorted([(g.indicator, f, i + 0.5, day[f]) for i, g in enumerate(GEM_SOURCES) for f in g.frequencies], key=_key)
    crime = rows(spark, layout.gold("fact_unodc_crime_global"), ["country_name", "indicator", "value"])
    assert crime == sorted([("Korea", name, i + 1.0) for i, (name, _) in enumerate(UNODC_SOURCES)], key=_key)
    assert rows(spark, layout.gold("fact_wb_non_gem_all_data"), ["country_name", "indicator_name", "year", "value"]) == [
        ("Korea", "Population", 1960, float(i)) for i in range(4)
    ]
    assert rows(spark, layout.gold("fact_edstats"), ["country_name", "value"]) == [("Korea", 7.0)]


def test_gold_edstats_partitions_prune(spark, workdir):
    layout = build(workdir)
    run_all(spark, layout)
    from pyspark.sql import functions as F

    df = read_table(spark, layout.gold("fact_edstats")).filter(F.col("period") == "2000-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    assert df.count() == 2


def test_command_line_runs_all_layers_from_yaml(workdir):
    import os
    import subprocess
    import sys

    import yaml

    from .conftest import ROOT
    from .raw_fixtures import GEM, STATS, UNODC

    layout = build(workdir + "/lake")
    config = {
        "root": layout.root,
        "edstats_file": layout.edstats_file,
        "gem": [{"indicator": g.indicator, "file": g.file, "frequencies": list(g.frequencies)} for g in GEM],
        "stats": [
            {"name": s.name, "data_file": s.data_file, "country_file": s.country_file, "series_file": s.series_file,
             "renames": [list(p) for p in s.renames], "country_renames": [list(p) for p in s.country_renames],
             "series_renames": [list(p) for p in s.series_renames], "country_drop": list(s.country_drop)}
            for s in STATS
        ],
        "unodc": [{"name": n, "file": f} for n, f in UNODC],
    }
    path = workdir + "/lake.yaml"
    with open(path, "w") as fh:
        yaml.safe_dump(config, fh)
    env = dict(os.environ, PYTHONPATH=ROOT + os.pathsep + os.environ.get("PYTHONPATH", ""))
    proc = subprocess.run([sys.executable, "-m", "statlake", "--config", path], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=900)
    assert proc.returncode == 0, proc.stderr[-3000:]
    for table in ("dim_country", "fact_unodc_crime_global", "fact_wb_gem_all_data", "fact_wb_non_gem_all_data",
                  "fact_edstats"):
        assert os.path.isdir(layout.gold(table)), table


def test_command_line_keeps_the_submitted_master(workdir):
    """``--local`` sets a master; without it the submitted one stays."""
    import os
    import subprocess
    import sys

    from .conftest import ROOT

    code = (
        "import sys; from statlake.session import job_session\n"
        "s = job_session(local=sys.argv[1] if len(sys.argv) > 1 else None)\n"
        "print('MASTER', s.sparkContext.master, s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.advisoryPartitionSizeInBytes'))"
    )
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS="--master local[3] --conf spark.ui.enabled=false pyspark-shell")
    for args, master in ((), "local[3]"), (("2",), "local[2]"):
        out = subprocess.run([sys.executable, "-c", code, *args], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
        assert f"MASTER {master} UTC 128m" in out.stdout, out.stderr[-2000:]
