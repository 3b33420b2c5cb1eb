"""A task that dies on its first attempt (a lost executor) must not change results.

Runs in a separate process with master ``local[4,3]`` (up to 3 attempts per
task; the shared test session allows none). A pass-through stage fails the
first attempt of one partition; the unpivot, rebalance and partitioned write
must still produce exactly the right rows, with nothing from the failed
attempt committed.
"""

import os
import subprocess
import sys
import textwrap

from .conftest import ROOT

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession

    from statlake.operators.shape import unpivot_entities
    from statlake.sources.tables import read_table, write_table

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())

    def flaky(batches):
        ctx = TaskContext.get()
        for batch in batches:
            if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
                raise RuntimeError("simulated executor loss")
            yield batch

    plain = spark.range(0, 10000, numPartitions=4).selectExpr(
        "CAST(id % 7 AS STRING) AS year", "id * 1.0 AS a", "id * 2.0 AS b")
    plain = plain.mapInPandas(flaky, plain.schema)
    # publisher-style headers after the flaky stage (mapInPandas needs plain names)
    wide = plain.selectExpr("year", "a AS `St. Lucia`", "b AS `Korea, Rep.`")
    out = {out!r}
    write_table(unpivot_entities(wide, "year"), out, partition_by="country")
    back = read_table(spark, out)
    rows = back.count()
    total = back.selectExpr("CAST(SUM(value) AS BIGINT)").first()[0]
    print("RESULT", rows, total)
    spark.stop()
    """
)


def test_job_survives_a_failed_task(workdir):
    script = os.path.join(workdir, "flaky_job.py")
    out = os.path.join(workdir, "out")
    with open(script, "w") as fh:
        fh.write(SCRIPT.format(root=ROOT, out=out))
    env = dict(os.environ, PYTHONPATH=ROOT + os.pathsep + os.environ.get("PYTHONPATH", ""))
    proc = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600, env=env)
    result = [line for line in proc.stdout.splitlines() if line.startswith("RESULT")]
    assert proc.returncode == 0 and result, proc.stderr[-3000:]
    _, rows, total = result[0].split()
    assert int(rows) == 20000
    assert int(total) == 3 * sum(range(10000))  # a + b = 3 * id, every id exactly once
    assert "simulated executor loss" in proc.stderr  # the failure really happened and was retried
