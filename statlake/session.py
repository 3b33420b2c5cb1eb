"""Session helpers for tests, the bench and command-line runs.

Library functions never build a session; they receive one. ``local_session``
is what tests and ``bench.py`` use. On a cluster the job submitter owns the
session, and ``scratch_dir`` reads the shared folder it names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every statlake job relies on, whatever the cluster size.
#  - ANSI stays on (Spark 4 default); all parsing of source text uses try_*.
#  - AQE re-plans joins at runtime (broadcast conversion, skew split) and
#    sizes shuffle partitions from real map output, so the static
#    shuffle.partitions value is only an upper bound.
#  - REBALANCE (used before partitioned writes) splits skewed partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # size coalesced partitions by bytes, not by maximum parallelism: on a
    # shared cluster this avoids thousands of tiny reduce tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def job_session(app_name: str = "statlake", local: str | None = None) -> SparkSession:
    """The submitted session (or a new one) with the job settings applied.

    No master is set unless ``local`` names the threads of a local run, so the
    master given to spark-submit stays.
    """
    _export_package_path()
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if local:
        builder = builder.master(f"local[{local}]")
    spark = builder.getOrCreate()
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = 8,
    shuffle_partitions: int = 8,
    app_name: str = "statlake",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with the job settings; the UI stays off.

    The package's parent folder is put on PYTHONPATH before the JVM starts,
    so Python workers (the workbook source) can import ``statlake``. On a
    cluster, ship the package with ``--py-files`` instead.
    """
    _export_package_path()
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _export_package_path() -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *parts])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster sets it to storage every executor can reach. Only when it is
    unset (local tests) do we create one, so lineage cuts and round-trip
    tables never land on one machine's disk in a real deployment.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                "set spark.checkpoint.dir to storage shared by all executors; "
                "statlake writes scratch and round-trip tables there"
            )
        current = tempfile.mkdtemp(prefix="statlake-ckpt-")  # local mode only
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"

