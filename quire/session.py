"""SparkSession helpers: tuned defaults, and a shared checkpoint directory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files of intermediate results are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # rows are long texts (bodies up to 15,000 chars, prompts up to ~450 KB): keep
    # scan splits and post-shuffle partitions near 128 MB, and Arrow batches to the
    # model small enough that one batch of prompts stays far below executor memory
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quire", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only on a local master may it be unset; a scratch folder then takes its place.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table, inside the shared checkpoint folder."""
    base = (spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)).rstrip("/")
    return f"{base}/{name}"


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to the rows of ``DEFAULT_CONF``, whoever built it: what goes to
    Python are long texts, and a worker holds a whole batch of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(DEFAULT_CONF[key])
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in executor Python workers (``mapInPandas`` and
    ``applyInPandas`` functions refer to it): zip the package once per SparkContext
    and register it with ``addPyFile``, which Spark distributes to every executor."""
    import zipfile

    import quire
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(quire.__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="quire-pkg-"), "quire.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
