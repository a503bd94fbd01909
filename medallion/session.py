"""Session construction and shared-storage settings.

Library code never creates a session; it takes the caller's.  ``build_session``
is for tests, the bench and local runs.  ``checkpoint_dir`` reads the cluster's
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local runs, tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session used with this library should carry (applied to a
# caller's session too, so only what results depend on, plus AQE).  UTC keeps
# to_date() of a "...Z" timestamp string equal to its literal date.  Writes
# set their own overwrite mode and compression per write.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "medallion") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no per-call Python call-site capture while building plans (several
        # extra JVM round trips per function call); errors still carry the
        # plan context
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the library's SQL defaults on an existing session (idempotent).

    This changes the caller's session, its time zone included."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def configured_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as configured (the same for every application).

    Where it is unset, a session with a local master gets one scratch folder;
    any other master is an error, since executors would not share the folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="medallion-ckpt-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is unset (tests, local runs) is a scratch folder
    created and registered, so that ``DataFrame.checkpoint()`` works.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a local context)
        return configured_dir(spark)
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    path = configured_dir(spark)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_tables_dir(spark: SparkSession) -> str:
    """Folder holding the intermediate tables written by ranks and sequences."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables"


def drop_scratch_tables(spark: SparkSession) -> bool:
    """Delete the intermediate tables under ``<spark.checkpoint.dir>/tables``.

    Call it after a run, once no DataFrame built by the library in this
    session is still to be read (they read those tables lazily).  Uses the
    Hadoop FileSystem of the folder, so it works on any store Spark writes to."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_tables_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.delete(path, True))


def delete_paths(spark: SparkSession, paths) -> int:
    """Delete the given folders (Hadoop FileSystem of each path)."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path) and fs.delete(path, True):
            n += 1
    return n
