"""Silver and Gold storage.

Silver tables live under ``<root>/<table>/snapshot_date=YYYY-MM-DD/``.  A
read takes the newest snapshot by default (the reference's glob reads every
dated file and so duplicates keys on the second day, R2); its date comes from
the folder names, so only that partition's files are scanned.  Writes are staged,
the quality gate checks what was staged, and publishing replaces only the
partitions it carries (dynamic partition overwrite), never a path being read.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import REJECTED
from ..operators.ranking import scratch_table_path
from ..plans import quality as q
from ..session import delete_paths


def content(columns: Sequence[str], schema: T.StructType) -> list[Column]:
    """K6: row count and an order-free checksum over the columns (maps left out), as aggregates."""
    whole = [F.col(f"`{c}`") for c in columns if "map<" not in schema[c].dataType.simpleString()]
    total = F.sum(F.xxhash64(*whole).cast("decimal(38,0)")) if whole else F.lit(0)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(total, F.lit(0)).alias("checksum")]


def observed(df: DataFrame, metrics: Sequence[Column], write) -> dict:
    """Run ``write(df)`` and return the metrics taken over the rows it wrote.

    They are taken in the writing tasks, above every shuffle, so a task that is run again
    after a lost executor is counted once."""
    seen = Observation()
    write(df.observe(seen, *metrics))
    return dict(seen.get)


def verify_written(spark: SparkSession, path: str, expected_columns: Sequence[str] | None = None,
                   sent: Mapping | None = None) -> dict:
    """K6: read a written table back and report rows, columns, bytes on
    storage (from ``_metadata.file_size``) and the check time.  With ``sent`` (what
    ``observed`` saw being written) row count and checksum are compared.  One small
    aggregate reaches the driver."""
    back = spark.read.parquet(path)
    sums = content(back.columns, back.schema) if sent is not None else [F.count(F.lit(1)).alias("rows"), F.lit(0).alias("checksum")]
    per_file = back.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.max("_metadata.file_size").alias("_size"), *sums)
    stats = per_file.agg(F.sum("rows").alias("rows"), F.sum("_size").alias("bytes"), F.sum("checksum").alias("checksum")).first()
    rows = int(stats["rows"] or 0)
    return {"path": path, "rows": rows, "columns": len(back.columns),
            "bytes": int(stats["bytes"] or 0),
            "columns_ok": expected_columns is None or list(expected_columns) == back.columns,
            "content_ok": sent is None or (rows == int(sent.get("rows") or 0)
                                           and int(stats["checksum"] or 0) == int(sent.get("checksum") or 0)),
            "written_at": _dt.datetime.now().isoformat()}


def stored_places(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an exported table with ``_file`` and ``_row``: part files are numbered in the
    order of their ranges, and rows within a file keep theirs."""
    back = spark.read.parquet(path)
    return back.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def order_kept(spark: SparkSession, path: str, order: Sequence[str]) -> bool:
    """Whether an exported table's rows, file by file, stand in the given order.

    Each file is compared row by row in one task (a file is one task's output); files with
    one another by their first and last keys, one row each."""
    keys = [-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in order]
    placed = stored_places(spark, path).select("_file", "_row", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"))
    before = F.lag("k").over(Window.partitionBy("_file").orderBy("_row"))
    files = placed.withColumn("wrong", F.coalesce(before > F.col("k"), F.lit(False))).groupBy("_file").agg(
        F.max("wrong").alias("wrong"), F.min("k").alias("low"), F.max("k").alias("high"))
    across = F.lag("high").over(Window.orderBy("_file"))
    found = files.select((F.col("wrong") | F.coalesce(across > F.col("low"), F.lit(False))).alias("wrong")).agg(F.max("wrong")).first()
    return not found[0]


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The largest value of a first-level partition column, from the folder
    names alone (one name per snapshot reaches the driver; no file is opened)."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    head = f"{column}="
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return max((n[len(head):] for n in names if n.startswith(head) and not n.endswith("__HIVE_DEFAULT_PARTITION__")),
               default=None)


def silver_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_silver(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None,
                all_snapshots: bool = False) -> DataFrame:
    """Silver table with its declared column list; newest snapshot unless
    ``all_snapshots``.  With a schema the read never infers types."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(list(schema.fields)
                                            + [T.StructField("snapshot_date", T.DateType())]))
    df = reader.parquet(silver_path(root, table))
    if not all_snapshots:
        newest = newest_partition(spark, silver_path(root, table), "snapshot_date")
        df = df.filter(F.col("snapshot_date") == F.lit(newest).cast("date"))
    cols = schema.fieldNames() if schema is not None else [c for c in df.columns if c != "snapshot_date"]
    return df.select(*cols)


def staged(df: DataFrame, table: str, write, checks: Sequence[q.Check]) -> list:
    """Evaluate ``df`` once into a staging table of the shared checkpoint
    folder, gate what was written, then hand it (without helper columns) to
    ``write``.  The scalar checks are observed in the staging write itself; only
    the uniqueness of keys reads the staged key columns again.  The staging table
    goes afterwards, published or not."""
    spark = df.sparkSession
    path = scratch_table_path(spark)
    try:
        checks = q.applicable(checks, df.columns)
        scalar = [c for c in checks if c.kind != "unique"]
        sent = observed(df, q.check_metrics(scalar) or [F.count(F.lit(1)).alias("rows")],
                        lambda x: x.write.option("compression", "snappy").parquet(path))
        stage = spark.read.schema(df.schema).parquet(path)
        rest = [c for c in checks if c.kind == "unique" or not sent]
        found = {r["check"]: r for r in q.check_results(stage, table, rest).collect()} if rest else {}
        found.update({r["check"]: r for r in q.observed_rows(table, scalar, sent)} if sent else {})
        rows = q.enforce_rows([found[c.name] for c in checks])
        write(stage.drop(REJECTED))
    finally:
        delete_paths(spark, [path])
    return rows


def write_silver(df: DataFrame, root: str, table: str, snapshot_date: str,
                 checks: Sequence[q.Check]) -> list:
    """K3: stage, gate, then publish one dated snapshot (snappy Parquet,
    dynamic partition overwrite).  Returns the check rows; raises before
    publishing when a FAIL check fails, and afterwards when the published rows are not the
    staged ones.  ``verify_written`` on ``snapshot_path(...)`` gives the K6 read-back."""
    def publish(stage: DataFrame) -> None:
        sent = observed(stage, content(stage.columns, stage.schema), lambda x: (
            x.withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date").option("compression", "snappy")
            .parquet(silver_path(root, table))))
        if sent.get("rows") and not verify_written(df.sparkSession, snapshot_path(root, table, snapshot_date), sent=sent)["content_ok"]:
            raise q.QualityGateError(f"{table} {snapshot_date}: the published rows are not the staged ones")
    return staged(df, table, publish, checks)


def snapshot_path(root: str, table: str, snapshot_date: str) -> str:
    return f"{silver_path(root, table)}/snapshot_date={snapshot_date}"


def register_staging(spark: SparkSession, models: Mapping[str, DataFrame]) -> None:
    """S8 + K4: staging models as temp views (the ``ref()`` targets)."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


VERSION = "__v"


def materialize_mart(df: DataFrame, name: str, keep: int = 2) -> str:
    """K4: a mart rebuilt in full on each run and swapped in whole.

    Every build writes a table of its own; then the view that carries the mart's name is
    replaced in one catalogue operation, so a reader sees the old or the new mart, never a
    missing or half-built one.  The newest ``keep`` builds stay for readers under way.
    Returns the name of the table built."""
    spark = df.sparkSession
    database, _, short = name.rpartition(".")
    prefix = f"{database}." if database else ""
    built = f"{prefix}{short}{VERSION}{int(time.time() * 1000):013d}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(built)
    known = {t.name: t for t in (spark.catalog.listTables(database) if database else spark.catalog.listTables()) if not t.isTemporary}
    if short in known and known[short].tableType != "VIEW":     # a mart stored as a table before
        spark.sql(f"drop table {name}")
    spark.sql(f"create or replace view {name} as select * from {built}")
    builds = sorted(t for t in known if t.startswith(f"{short}{VERSION}"))
    for old in builds[:-keep]:
        spark.sql(f"drop table if exists {prefix}{old}")
    return built


def drop_mart(spark: SparkSession, name: str) -> None:
    """Drop a mart: its view and all its builds."""
    database, _, short = name.rpartition(".")
    spark.sql(f"drop view if exists {name}")
    for t in spark.catalog.listTables(database) if database else spark.catalog.listTables():
        if t.name.startswith(f"{short}{VERSION}") and not t.isTemporary:
            spark.sql(f"drop table if exists {database + '.' if database else ''}{t.name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A stored table, whole."""
    return spark.table(name)
