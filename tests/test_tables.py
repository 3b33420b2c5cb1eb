"""Tables that a failed or repeated write cannot spoil: replacement, delivery, contract, ledger, catalogue."""

import os

import pytest
from pyspark.sql import functions as F

from statlake.sources import tables
from statlake.sources.catalog import register_table
from statlake.sources.contract import ADDED, MISSING, RETYPED, ContractError, compare, contract_drift, stored_contract
from statlake.sources.files import Files, sibling
from statlake.sources.ledger import Controls, latest_totals, read_ledger
from statlake.sources.tables import accumulate, append_each, deliver, read_table, write_table


def rows(spark, n, code="id % 3"):
    return spark.range(n).selectExpr("id AS k", f"lpad(CAST({code} AS STRING), 3, '0') AS code")


def failing(df):
    """Fails in its tasks, after some rows were written."""
    return df.withColumn("k", F.when(F.col("k") == 7, F.raise_error(F.lit("input is torn")).cast("bigint")).otherwise(F.col("k")))


def keys(df):
    return sorted(r.k for r in df.select("k").collect())


@pytest.mark.parametrize("parts", [None, "code"])
def test_failed_overwrite_leaves_the_old_table(spark, workdir, parts):
    path = workdir + "/lake/t"
    write_table(rows(spark, 10), path, partition_by=parts)
    with pytest.raises(Exception, match="input is torn"):
        write_table(failing(rows(spark, 20)), path, partition_by=parts)
    with pytest.raises(Exception, match="input is torn"):
        accumulate([rows(spark, 3), failing(rows(spark, 20))], path, partition_by=parts)
    assert keys(read_table(spark, path)) == list(range(10))
    assert os.listdir(workdir + "/lake") == ["t"]  # nothing staged is left
    write_table(rows(spark, 4), path, partition_by=parts)
    assert keys(read_table(spark, path)) == list(range(4))


def test_first_write_that_fails_leaves_no_table(spark, workdir):
    with pytest.raises(Exception, match="input is torn"):
        write_table(failing(rows(spark, 20)), workdir + "/t")
    assert os.listdir(workdir) == []


def test_writer_that_dies_between_its_renames(spark, workdir, monkeypatch):
    """The old table is read from where it is kept, and the next write of any kind goes on from it."""
    path = workdir + "/t"
    write_table(rows(spark, 10), path)
    move = Files.move

    def dies(self, old, new):
        if "next-" in old:
            raise KeyboardInterrupt
        move(self, old, new)

    for repeat in range(2):
        monkeypatch.setattr(Files, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            write_table(rows(spark, 5), path)
        assert keys(read_table(spark, path)) == list(range(10))
    monkeypatch.setattr(Files, "move", move)
    write_table(rows(spark, 12).filter("k >= 10"), path, mode="append")
    assert keys(read_table(spark, path)) == list(range(12))
    monkeypatch.setattr(Files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        write_table(rows(spark, 5), path)
    monkeypatch.setattr(Files, "move", move)
    write_table(rows(spark, 3), path)
    assert keys(read_table(spark, path)) == [0, 1, 2]


def test_replaced_table_is_kept_until_the_next(spark, workdir):
    path = workdir + "/t"
    write_table(rows(spark, 10), path)
    old = read_table(spark, path)
    write_table(rows(spark, 5), path)
    assert keys(read_table(spark, sibling(path, "previous"))) == list(range(10))
    assert old.schema == read_table(spark, path).schema


def test_batch_lands_once_however_often(spark, workdir):
    path, df = workdir + "/t", rows(spark, 10)
    deliver(df.filter("k < 3"), path, "2024-01")
    deliver(df.filter("k BETWEEN 5 AND 6"), path, "2024-02")
    deliver(df.filter("k < 5"), path, "2024-01")
    deliver(df.filter("k < 5"), path, "2024-01")
    assert keys(read_table(spark, path)) == [0, 1, 2, 3, 4, 5, 6]
    deliver(df.filter("k > 6"), path, "2023-12")  # late
    assert keys(read_table(spark, path)) == list(range(10))
    deliver(df.filter("false"), path, "2024-02")  # withdrawn
    assert keys(read_table(spark, path)) == [0, 1, 2, 3, 4, 7, 8, 9]
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["batch=2023-12", "batch=2024-01"]


def test_failed_and_dead_deliveries(spark, workdir, monkeypatch):
    path = workdir + "/t"
    deliver(rows(spark, 4), path, "a", partition_by="code")
    deliver(rows(spark, 2), path, "b", partition_by="code")
    with pytest.raises(Exception, match="input is torn"):
        deliver(failing(rows(spark, 20)), path, "a", partition_by="code")
    assert keys(read_table(spark, path).filter("batch = 'a'")) == [0, 1, 2, 3]
    move = Files.move

    def dies(self, old, new):
        if "next-" in old:
            raise KeyboardInterrupt
        move(self, old, new)

    monkeypatch.setattr(Files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        deliver(rows(spark, 9), path, "a", partition_by="code")
    monkeypatch.setattr(Files, "move", move)
    # the batch waits where it was moved to; the table is whole for readers
    assert keys(read_table(spark, path)) == [0, 0, 1, 1, 2, 3]
    deliver(rows(spark, 9), path, "a", partition_by="code")
    assert keys(read_table(spark, path)) == sorted([*range(9), 0, 1])
    for bad in ("", "a/b", "..", "a=b", "a b"):
        with pytest.raises(ValueError):
            deliver(rows(spark, 1), path, bad, partition_by="code")


def test_contract_replaces_inference(spark, workdir):
    """Codes, dates and an empty table keep their types without any schema at the reader."""
    path = workdir + "/t"
    df = rows(spark, 6).withColumn("day", F.expr("DATE'2000-01-01'"))
    write_table(df, path, partition_by=["code", "day"], audit=False)
    assert read_table(spark, path).dtypes == [("k", "bigint"), ("code", "string"), ("day", "date")]
    assert {r.code for r in read_table(spark, path).collect()} == {"000", "001", "002"}
    write_table(df.filter("false"), path, partition_by=["code", "day"], audit=False)
    assert read_table(spark, path).collect() == [] and len(read_table(spark, path).columns) == 3
    assert stored_contract(spark, path).partition_by == ("code", "day")


def test_drift_is_reported_by_column(spark, workdir):
    path = workdir + "/t"
    write_table(rows(spark, 5), path)
    declared = "K bigint, code int, note string"
    found = {r.column: (r.change, r.stored, r.given) for r in contract_drift(spark, path, declared).collect()}
    assert found == {
        "code": (RETYPED, "string", "int"), "note": (ADDED, None, "string"), "insert_timestamp": (MISSING, "timestamp", None),
    }
    with pytest.raises(ContractError, match="code retyped"):
        read_table(spark, path, declared)
    some = read_table(spark, path, "k bigint, note string")
    assert [tuple(r) for r in some.orderBy("k").take(2)] == [(0, None), (1, None)]
    with pytest.raises(ContractError, match="note added"):
        read_table(spark, path, "k bigint, code string, note string", strict=True)
    assert read_table(spark, path, "k bigint, code string", strict=True).count() == 5
    with pytest.raises(ContractError):
        contract_drift(spark, workdir, declared)
    assert compare(read_table(spark, path).schema, read_table(spark, path).schema) == []


def test_append_must_fit(spark, workdir):
    path, df = workdir + "/t", rows(spark, 3)
    write_table(df, path, partition_by="code")
    for wrong in (df.withColumn("extra", F.lit(1)), df.withColumn("k", F.lit("x"))):
        with pytest.raises(ContractError):
            write_table(wrong, path, mode="append", partition_by="code")
    with pytest.raises(ContractError, match="partitioned"):
        write_table(df, path, mode="append")
    with pytest.raises(ValueError):
        write_table(df, path, mode="ignore")
    assert read_table(spark, path).count() == 3
    write_table(df.withColumn("extra", F.lit(1)).drop("k"), path, mode="append", partition_by="code", evolve=True)
    got = read_table(spark, path)
    assert sorted(map(tuple, got.select("k", "extra").collect()), key=repr) == sorted([(0, None), (1, None), (2, None)] + [(None, 1)] * 3, key=repr)
    append_each([df, df], workdir + "/u", partition_by="code")
    assert keys(read_table(spark, workdir + "/u")) == [0, 0, 1, 1, 2, 2]


def test_tables_written_elsewhere_are_read(spark, workdir):
    path = workdir + "/t"
    rows(spark, 4).write.parquet(path)
    assert read_table(spark, path).count() == 4
    write_table(rows(spark, 6).filter("k > 3"), path, mode="append", audit=False)
    assert keys(read_table(spark, path)) == list(range(6))


def test_totals_are_counted_by_the_write(spark, workdir):
    """The last run of a table counts; a failed write enters nothing; hot partitions count once."""
    ledger, path = workdir + "/ledger", workdir + "/t"
    control = {"odd": "k % 2 = 1", "none": "k < 0"}
    write_table(rows(spark, 9), path, counted=Controls("t", control, ledger))
    with pytest.raises(Exception, match="input is torn"):
        write_table(failing(rows(spark, 20)), path, counted=Controls("t", control, ledger))
    counted = Controls("t", control, ledger)
    write_table(rows(spark, 1000, "least(id, 3)"), path, partition_by="code", counted=counted)
    assert counted.totals == {"rows": 1000, "odd": 500, "none": 0}
    deliver(rows(spark, 5), workdir + "/d", "x", counted=Controls("d", {}, ledger))
    deliver(rows(spark, 0), workdir + "/d", "y", counted=Controls("d", {}, ledger))
    got = {(r.table, r.batch, r.control): r.n for r in latest_totals(spark, ledger).collect()}
    assert got == {("t", None, "rows"): 1000, ("t", None, "odd"): 500, ("t", None, "none"): 0, ("d", "x", "rows"): 5, ("d", "y", "rows"): 0}
    assert read_ledger(spark, ledger).count() == 8
    with pytest.raises(ValueError):
        Controls("t", {"rows": "true"})


def test_tables_by_name(spark, workdir):
    """A registered table follows replacement, new partitions and new columns; its data is not the catalogue's."""
    tables.create_namespaces(spark, {"named": workdir + "/named_db"})
    path, name = workdir + "/t", "named.facts"
    write_table(rows(spark, 6), path, partition_by="code", audit=False)
    register_table(spark, name, path)
    assert keys(spark.table(name).filter("code = '001'")) == [1, 4]
    write_table(rows(spark, 8, "5 + id % 2"), path, partition_by="code", audit=False)
    register_table(spark, name, path)
    assert {r.code for r in spark.table(name).select("code").distinct().collect()} == {"005", "006"}
    write_table(rows(spark, 2).withColumn("extra", F.lit("x")), path, mode="append", partition_by="code", audit=False, evolve=True)
    register_table(spark, name, path)
    assert spark.table(name).filter("extra = 'x'").count() == 2 and spark.table(name).count() == 10
    assert spark.table(name).columns == ["k", "extra", "code"]
    spark.sql(f"DROP TABLE {name}")
    assert read_table(spark, path).count() == 10
    with pytest.raises(ContractError):
        register_table(spark, name, workdir)
