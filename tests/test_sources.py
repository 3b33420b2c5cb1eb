import os

import pytest

from pyspark.sql.types import DateType, StringType, StructField, StructType

from statlake.sources.csv import read_csv, write_csv
from statlake.sources.tables import accumulate, append_each, create_namespaces, read_table, write_table
from statlake.sources.xlsx import column_index, literal_path, read_xlsx

from .xlsx_fixture import Inline, write_xlsx


def test_column_index():
    assert [column_index(r) for r in ("A1", "Z9", "AA10", "AZ1", "BA2")] == [0, 25, 26, 51, 52]


def test_xlsx_gem_sheet(spark, workdir):
    path = write_xlsx(os.path.join(workdir, "g.xlsx"), {
        "annual": [[None, "St. Lucia", "Korea, Rep."], ["units", "x", "y"], [1987.0, 1.5, None], [1988, None, "n/a"], []],
        "monthly": [[None, "A"], ["u"], ["1987M01", Inline("2.5")]],
    })
    df = read_xlsx(spark, path, sheet="annual", header_row=0, skip_rows_after_header=1)
    assert df.columns == ["Year", "St. Lucia", "Korea, Rep."]
    assert [tuple(r) for r in df.collect()] == [("1987.0", "1.5", None), ("1988", None, "n/a")]
    m = read_xlsx(spark, path, sheet="monthly", header_row=0, skip_rows_after_header=1)
    assert [tuple(r) for r in m.collect()] == [("1987M01", "2.5")]


def test_xlsx_header_offset_and_missing_rows(spark, workdir):
    # title rows above the header; a blank (absent) row right after the header
    path = write_xlsx(os.path.join(workdir, "u.xlsx"), {"data": [
        ["title"], [], ["Iso3_code", "Country", "VALUE"], ["skip me", None, None], ["AFG", "Afghanistan", 1], ["BEL", None, 2.5],
    ]}, blank_row_numbers={4})
    df = read_xlsx(spark, path, header_row=2)
    assert df.columns == ["Iso3_code", "Country", "VALUE"]
    assert [tuple(r) for r in df.collect()] == [("AFG", "Afghanistan", "1"), ("BEL", None, "2.5")]
    # positional skip: the absent row 4 is the one skipped
    df2 = read_xlsx(spark, path, header_row=2, skip_rows_after_header=1)
    assert df2.count() == 2


def test_xlsx_many_workbooks_one_task_each(spark, workdir):
    d = os.path.join(workdir, "books")
    os.makedirs(d)
    write_xlsx(os.path.join(d, "a.xlsx"), {"s": [["k", "v"], ["a", 1]]})
    write_xlsx(os.path.join(d, "b.xlsx"), {"s": [["v", "k", "extra"], [2, "b", "e"]]})
    df = read_xlsx(spark, d)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.select("k", "v", "extra").collect())) == [("a", "1", None), ("b", "2", "e")]


def test_xlsx_paths_are_literal(spark, workdir):
    assert literal_path("a,b [1]*?.xlsx") == r"a,b \[1\]\*\?.xlsx"
    names = ["CPI Price, % y-o-y, nominal.xlsx", "Stock Markets, US$ [1].xlsx", "a*b.xlsx", "aXb.xlsx"]
    for i, name in enumerate(names):
        write_xlsx(os.path.join(workdir, name), {"s": [["k"], [f"v{i}"]]})
    for i, name in enumerate(names):
        for root in (workdir, "file://" + workdir):
            assert [tuple(r) for r in read_xlsx(spark, f"{root}/{name}").collect()] == [(f"v{i}",)]
    both = read_xlsx(spark, [f"{workdir}/{n}" for n in names[:2]], source_column="file")
    assert sorted((r.k, os.path.basename(r.file).replace("%25", "%")[:9]) for r in both.collect()) == [("v0", "CPI Price"), ("v1", "Stock Mar")]


def test_csv_multiline_and_quotes(spark, workdir):
    p = os.path.join(workdir, "c.csv")
    with open(p, "w") as fh:
        fh.write('Country Code,Long Name\nAFG,"Afghan\nistan"\nBEL,"Bel ""gium"""\n')
    df = read_csv(spark, p, multiline=True)
    assert [tuple(r) for r in df.collect()] == [("AFG", "Afghan\nistan"), ("BEL", 'Bel "gium"')]
    out = os.path.join(workdir, "c_out")
    write_csv(df, out)
    assert sorted(map(tuple, read_csv(spark, out, multiline=True).collect())) == sorted(map(tuple, df.collect()))


def test_partition_values_keep_declared_types(spark, workdir):
    df = spark.createDataFrame([("001", "a"), ("010", "b")], "code string, v string")
    path = os.path.join(workdir, "p")
    write_table(df, path, partition_by="code", sanitize=False, audit=False)
    schema = StructType([StructField("v", StringType()), StructField("code", StringType())])
    assert sorted(r.code for r in read_table(spark, path, schema).collect()) == ["001", "010"]


def test_partition_by_date(spark, workdir):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2000, 1, 1), 1.0)], "period date, value double")
    path = os.path.join(workdir, "d")
    write_table(df, path, partition_by="period")
    schema = StructType([StructField("value", StringType()), StructField("period", DateType())])
    back = read_table(spark, path, StructType([StructField("period", DateType())]))
    assert back.first().period == dt.date(2000, 1, 1)
    assert "insert_timestamp" in read_table(spark, path).columns
    assert schema


def test_accumulate_and_append(spark, workdir):
    a = spark.createDataFrame([(1, "x")], "K int, V string")
    b = spark.createDataFrame([("y", 2)], "V string, K int")
    p1, p2 = os.path.join(workdir, "acc"), os.path.join(workdir, "app")
    accumulate([a, b], p1)
    append_each([a, b], p2)
    for p in (p1, p2):
        assert sorted(map(tuple, read_table(spark, p).select("k", "v").collect())) == [(1, "x"), (2, "y")]


def test_namespaces(spark, workdir):
    create_namespaces(spark, {"bronze_t": os.path.join(workdir, "bronze")})
    assert "bronze_t" in [d.name for d in spark.catalog.listDatabases()]


def test_xlsx_without_row_and_cell_references(spark, workdir):
    import zipfile

    path = os.path.join(workdir, "plain.xlsx")
    write_xlsx(path, {"s": [["a"]]})  # valid package; replace the sheet with one without refs
    sheet = (
        '<?xml version="1.0" encoding="UTF-8"?>'
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        '<row><c t="inlineStr"><is><t>k</t></is></c><c t="inlineStr"><is><t>v</t></is></c></row>'
        '<row><c t="inlineStr"><is><t>x</t></is></c><c><v>1.5</v></c></row>'
        "</sheetData></worksheet>"
    )
    rebuilt = os.path.join(workdir, "plain2.xlsx")
    with zipfile.ZipFile(path) as src, zipfile.ZipFile(rebuilt, "w") as dst:
        for item in src.namelist():
            data = sheet if item == "xl/worksheets/sheet1.xml" else src.read(item)
            dst.writestr(item, data)
    df = read_xlsx(spark, rebuilt)
    assert df.columns == ["k", "v"]
    assert [tuple(r) for r in df.collect()] == [("x", "1.5")]


def test_layout_from_yaml(workdir):
    from statlake.layout import Layout

    path = os.path.join(workdir, "lake.yaml")
    with open(path, "w") as fh:
        fh.write("root: /shared/lake\nedstats_file: ed/Ed.csv\n")
    layout = Layout.from_yaml(path)
    assert layout.bronze("wb_edstats") == "/shared/lake/bronze/wb_edstats"
    assert layout.raw(layout.edstats_file) == "/shared/lake/raw/ed/Ed.csv"
    assert set(layout.namespaces()) == {"bronze", "silver", "gold"}


def test_csv_torn_records(spark, workdir):
    """Each record is in one part: whole ones unchanged, torn ones with file, reason and text."""
    from statlake.sources.csv import land_csv, read_csv_checked

    for name, body in (("a.csv", 'k,v\n1,"x, y"\n2\n3,z,more\n'), ("b.csv", 'k,v\n4,\n"5","multi\nline"\n')):
        os.makedirs(workdir + "/raw", exist_ok=True)
        with open(f"{workdir}/raw/{name}", "w") as fh:
            fh.write(body)
    rows, torn = land_csv(spark, workdir + "/raw", ["k", "v"], workdir + "/landed", multiline=True)
    assert sorted(map(tuple, rows.collect()), key=repr) == [("1", "x, y"), ("4", None), ("5", "multi\nline")]
    assert sorted((os.path.basename(r.file), r.reason, r.record.strip()) for r in torn.collect()) == [
        ("a.csv", "too few fields", "2"), ("a.csv", "too many fields", "3,z,more"),
    ]
    assert "PartitionFilters: [isnotnull(torn" in rows._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        read_csv_checked(spark, workdir + "/raw", ["k", "file"])
