"""Incremental Bronze -> Silver with Structured Streaming.

The reference re-runs its notebooks and skips snapshots that already exist.
Here the Bronze folder is a file stream: the stream's checkpoint records
which documents were processed, so each snapshot file is flattened once, and
a run with ``availableNow`` processes whatever arrived since the last run and
stops.  Each micro-batch goes through the same Silver pipeline and quality
gate as the batch path; a failing FAIL check stops the stream before that
batch is written, and the batch is retried on the next run.  Batches write
with dynamic partition overwrite on ``(snapshot_date, batch_id)``, so a
replayed batch (after a failure between write and commit) rewrites its own
partition instead of duplicating rows, and documents of the same day (other
seasons, or pages of one snapshot) are all kept.

The checkpoint lives under the cluster's ``spark.checkpoint.dir``, at the same
place for every application, unless a location is given.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import scratch_scope
from ..plans import quality as q
from ..plans.ingest import read_stored
from ..session import configured_dir
from ..sources import bronze, layers


def bronze_document_stream(spark: SparkSession, bronze_dir: str, doc_schema: T.StructType,
                           max_files_per_trigger: int | None = None, multi_line: bool = True,
                           glob: str = "*.json", on_damage: str = bronze.RAISE) -> DataFrame:
    """Streaming read of Bronze documents (declared schema).  Pretty-printed
    documents (``multi_line``) are one per file; otherwise each line of a
    file is one document.  A document that cannot be parsed stops the stream, or is
    marked (``bronze.mark_damage``) and gives no records."""
    reader = (spark.readStream.schema(bronze.with_corrupt(doc_schema)).option("multiLine", multi_line)
              .option("columnNameOfCorruptRecord", bronze.CORRUPT).option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(bronze_dir)
    return bronze.mark_damage(docs.select("*", F.col("_metadata.file_path").alias("source_blob"),
                                          F.col("_metadata.file_name").alias("file_name")), doc_schema, on_damage)


def snapshot_of(blob: str) -> Column:
    """The snapshot that a document belongs to: the date and season in its name."""
    return F.concat_ws("/", F.regexp_extract(blob, r"/(\d{4}-\d{2}-\d{2})[^/]*$", 1),
                       F.regexp_extract(blob, bronze.SEASON_IN_NAME, 1))


def unique_in_snapshot(stage: DataFrame, silver_dir: str, key: str, epoch_id: int) -> None:
    """Raise when a key of this batch is already stored, by another batch, in
    the same snapshot (the gate alone sees one micro-batch)."""
    stored = read_stored(stage.sparkSession, silver_dir, T.StructType(
        [*stage.schema.fields, T.StructField("batch_id", T.LongType())]))
    if stored is None:
        return
    days = [r[0] for r in stage.select("snapshot_date").distinct().collect()]   # the batch's documents
    known = [d for d in days if d is not None]
    stored = stored.where((F.col("batch_id") != epoch_id) & (
        F.col("snapshot_date").isin(known) | (F.col("snapshot_date").isNull() if None in days else F.lit(False))))
    have = stored.select(F.col(key).alias("_key"), snapshot_of("source_blob").alias("_snap"))
    again = stage.join(have, (F.col(key) == F.col("_key")) & (snapshot_of("source_blob") == F.col("_snap")), "left_semi")
    if not again.limit(1).isEmpty():
        raise q.QualityGateError(f"{key} of this batch is already stored for the same snapshot")


def silver_batch_writer(array_field: str, flatten: Callable[..., DataFrame],
                        checks: Sequence[q.Check], table: str, silver_dir: str):
    """``foreachBatch`` function: explode, flatten, gate, write by snapshot."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        with scratch_scope(batch.sparkSession):     # drop any rank table once written
            _write(batch, epoch_id)

    def _write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        recs = bronze.records(batch, array_field)
        silver = flatten(recs, source=F.col("source_blob"), count_rejects=True)
        day = F.regexp_extract("source_blob", r"/(\d{4}-\d{2}-\d{2})[^/]*$", 1)
        silver = silver.withColumn("snapshot_date", F.try_to_date(F.nullif(day, F.lit(""))))

        def publish(stage: DataFrame) -> None:
            for check in checks:
                if check.kind == "unique" and check.severity == q.FAIL:
                    unique_in_snapshot(stage, silver_dir, check.column, epoch_id)
            # Partitioned by snapshot and micro-batch: a replayed batch (same id
            # after a failure before commit) rewrites only its own partition, and
            # two documents of the same day never overwrite each other.
            (stage.withColumn("batch_id", F.lit(epoch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("snapshot_date", "batch_id").option("compression", "snappy")
             .parquet(silver_dir))

        layers.staged(silver, table, publish, checks)
    return write


def stream_location(spark: SparkSession, bronze_dir: str, silver_dir: str, table: str) -> str:
    """Where the stream keeps its progress: below the configured
    ``spark.checkpoint.dir`` itself (the same for every application), by table,
    source and target."""
    ends = hashlib.sha256(f"{bronze_dir}\n{silver_dir}".encode()).hexdigest()[:16]
    return f"{configured_dir(spark).rstrip('/')}/streams/{table}-{ends}"


def run_bronze_to_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, table: str,
                         doc_schema: T.StructType, array_field: str,
                         flatten: Callable[..., DataFrame], checks: Sequence[q.Check],
                         checkpoint_location: str | None = None,
                         available_now: bool = True,
                         files_per_batch: int = 1, multi_line: bool = True,
                         glob: str = "*.json") -> StreamingQuery:
    """Start (and with ``available_now``, finish) the incremental load.

    A Bronze document is a whole snapshot, so by default each micro-batch
    takes one document and the gate (key uniqueness, ...) applies to that
    snapshot alone."""
    location = checkpoint_location or stream_location(spark, bronze_dir, silver_dir, table)
    docs = bronze_document_stream(spark, bronze_dir, doc_schema, files_per_batch, multi_line, glob)
    writer = (docs.writeStream.foreachBatch(
        silver_batch_writer(array_field, flatten, checks, table, silver_dir))
        .option("checkpointLocation", location).queryName(f"bronze_to_silver_{table}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
