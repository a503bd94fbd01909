"""Bronze ingestion and Gold publication as Spark jobs.

* ``annotate`` (K1): attach the ingestion-metadata struct and snapshot keys.
* ``new_snapshots`` (K2): keep incoming rows whose snapshot key is not yet
  stored: a left-anti join against the *distinct* stored keys (a partial
  aggregate reduces the stored side to one row per key first).
* ``bronze_ingest`` (C8): annotate, leave committed snapshots alone, replace
  unfinished ones, partitioned by snapshot date and season.
* ``season_index_ingest`` (C9): filter the competition index, list the season
  files, read the wanted ones by a semi-join, write by competition and season.
* ``publish_gold`` (C10, K5-K7): write each mart under a dated partition,
  read it back and record rows and columns in a run log; a table that fails
  is logged with ``ok=false`` and the others go on.
* ``run_log_summary`` (K7): items, failures and the overall flag (an empty
  log is a failure, as in the reference).

Writes go through Spark's commit protocol, so retried tasks after a lost
executor do not leave partial or duplicate files.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import PySparkException

from ..operators.ranking import scratch_table_path
from ..schemas import INGESTION_METADATA
from ..sources import bronze
from ..sources.commits import SnapshotStore
from .quality import QualityGateError, require_rows

SNAPSHOT_KEYS = ("snapshot_date", "snapshot_season")


def annotate(records: DataFrame, snapshot_date: str, season: int | None, source: str,
             layer: str = "bronze", extra: Mapping[str, object] | None = None) -> DataFrame:
    """K1: snapshot keys (``snapshot_date``, ``snapshot_season``; records
    may carry their own ``season`` field) + ingestion metadata struct."""
    values = {"ingested_at": _dt.datetime.now().isoformat(), "season": season,
              "source": source, "layer": layer, **(extra or {})}
    meta = F.struct(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
                      for f in INGESTION_METADATA.fields])
    return records.select("*", F.lit(snapshot_date).cast("date").alias("snapshot_date"),
                          F.lit(season).cast("int").alias("snapshot_season"),
                          meta.alias("_ingestion_metadata"))


def read_stored(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The store under ``path`` with its declared schema, None where there is none yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.format(fmt).schema(schema).load(path)


def stored_keys(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                fmt: str = "parquet") -> DataFrame | None:
    """Distinct keys already written under ``path`` (None if nothing is).  A
    store whose files lack a key column is an error, not an empty store."""
    if read_stored(spark, path, schema, fmt) is None:
        return None
    missing = set(keys) - set(spark.read.format(fmt).load(path).columns)
    if missing:
        raise ValueError(f"{path} lacks the key columns {sorted(missing)}")
    return read_stored(spark, path, schema, fmt).select(*keys).distinct()


def new_snapshots(incoming: DataFrame, existing_keys: DataFrame | None,
                  keys: Sequence[str] = SNAPSHOT_KEYS) -> DataFrame:
    """K2: rows of ``incoming`` whose key tuple is not in ``existing_keys``."""
    if existing_keys is None:
        return incoming
    have = existing_keys.select(*keys).distinct()
    cond = [incoming[k].eqNullSafe(have[k]) for k in keys]
    return incoming.join(have, cond, "left_anti")


def bronze_ingest(spark: SparkSession, records: DataFrame, target: str, snapshot_date: str,
                  season: int | None, source: str, fmt: str = "parquet", entity: str | None = None,
                  ingested_by: str | None = None, endpoint: str | None = None,
                  allow_empty: bool = True) -> DataFrame:
    """Store one snapshot's records, whole and once.

    A committed snapshot (its mark's row count equals the rows stored under its key) is
    left as it is.  Otherwise the records are staged, committed by an exclusive mark and
    moved into place (``sources.commits``): a fragment of an earlier run is replaced, a cut-off
    publication is finished, and of concurrent runs one stores its copy.  A store from before
    there were marks keeps snapshots whose metadata count (``entity``) equals their rows.

    Returns the run-log row for this snapshot (rows now stored under its key); an empty
    snapshot logs ``ok=false``, or raises unless ``allow_empty`` (Q13).  ``entity``
    ("match", "team" or "scorer") names the metadata count that the number of records
    fills (B2)."""
    store = SnapshotStore(spark, target)
    key = store.key(snapshot_date, season)
    mine = ((F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
            & F.col("snapshot_season").eqNullSafe(F.lit(season).cast("int")))
    extra = {"ingested_by": ingested_by, "endpoint": endpoint}
    schema = annotate(records, snapshot_date, season, source).schema

    def rows_stored() -> tuple[int, int | None]:
        stored = read_stored(spark, target, schema, fmt)
        if stored is None:
            return 0, None
        said = F.max(f"_ingestion_metadata.{entity}_count") if entity else F.lit(None).cast("long")
        r = stored.filter(mine).agg(F.count(F.lit(1)), said).first()
        return r[0], r[1]

    mark = store.publish(key)           # finishes a publication that was cut off
    n, said = rows_stored()
    if mark is None and n and said == n:
        store.adopt(key, n)
        mark = store.mark(key)
    if mark is None or mark["rows"] != n:
        known = records.count() if entity else 0    # tells an empty snapshot too
        if known or require_rows(records, f"{source} {snapshot_date}", allow_empty):
            if entity:
                extra[f"{entity}_count"] = known
            attempt, folder = store.staging()
            seen = Observation(f"ingest-{attempt}")
            (annotate(records, snapshot_date, season, source, extra=extra).drop(*SNAPSHOT_KEYS)
             .observe(seen, F.count(F.lit(1)).alias("rows"))
             .write.format(fmt).option("compression", "snappy").save(folder))
            if not store.commit(key, attempt, int(seen.get["rows"]), after=mark):
                store.drop(attempt)     # another run committed this snapshot meanwhile
            mark = store.publish(key)
            n, _ = rows_stored()
    ok = n > 0 and mark is not None and mark["rows"] == n
    return spark.createDataFrame([(f"{snapshot_date}/{season}", n, ok)], "item string, rows long, ok boolean")


SEASON_KEYS = ("competition_id", "season_id")
SEASON_STORE = T.StructType([T.StructField("source_blob", T.StringType()), T.StructField("match_json", T.StringType()),
                             T.StructField("competition_id", T.IntegerType()), T.StructField("season_id", T.IntegerType())])
SEASON_MARKS = T.StructType([T.StructField("competition_id", T.IntegerType()), T.StructField("season_id", T.IntegerType()),
                             T.StructField("rows", T.LongType())])


def season_marks(spark: SparkSession, target: str) -> DataFrame | None:
    """Seasons whose load was finished, with their rows (newest load of each)."""
    return read_stored(spark, f"{target.rstrip('/')}/_loads", SEASON_MARKS)


def season_index_ingest(spark: SparkSession, index_path: str, matches_root: str,
                        competition_id: int, target: str, on_damage: str = bronze.RAISE) -> DataFrame:
    """Competition index -> per-season match lists -> season partitions.

    Wanted are the index's seasons of one competition whose load was not finished yet.
    Files of other competitions are pruned by path, the wanted seasons are kept by a
    semi-join, and the season partitions they carry are replaced whole (so a fragment of a
    broken run goes); then the loads are marked as finished.  Nothing but the emptiness of
    the work list reaches the driver.  One run per competition at a time.

    A season file that cannot be read, or has no content, raises; with ``quarantine`` its
    season is left out, is tried again next time, and the log names the file and the reason.
    Returns the per-season run log."""
    index = bronze.filter_competition(bronze.read_competition_index(spark, index_path),
                                      competition_id)
    if index.isEmpty():
        raise ValueError(f"no seasons for competition {competition_id}")
    seasons = index.select(*SEASON_KEYS, "season_name").distinct()
    files = bronze.list_season_files(spark, matches_root).join(seasons, list(SEASON_KEYS), "left_semi")
    work = scratch_table_path(spark)    # the work list is used several times, the files are listed once
    new_snapshots(files, season_marks(spark, target), SEASON_KEYS).write.parquet(work)
    todo = spark.read.schema(files.schema).parquet(work)
    log = None
    if not todo.isEmpty():
        found = bronze.read_season_matches(spark, matches_root, competition_id, bronze.QUARANTINE).join(
            todo.select(*SEASON_KEYS).distinct(), list(SEASON_KEYS), "left_semi")
        bad = (found.where(F.col(bronze.PROBLEM).isNotNull()).select(*SEASON_KEYS, "source_blob", bronze.PROBLEM)
               .unionByName(todo.where("bytes = 0").select(*SEASON_KEYS, "source_blob", F.lit("empty").alias(bronze.PROBLEM))))
        reason = F.concat("source_blob", F.lit(": "), bronze.PROBLEM)
        first = bad.agg(F.min(reason)).first()[0]
        if first is not None and on_damage == bronze.RAISE:
            raise QualityGateError(f"unreadable season file {first}")
        good = found.where(F.col(bronze.PROBLEM).isNull())
        if first is not None:
            good = good.join(bad.select(*SEASON_KEYS).distinct(), list(SEASON_KEYS), "left_anti")
            log = bad.select(reason.alias("item"), F.lit(0).cast("long").alias("rows"), F.lit(False).alias("ok"))
        (good.select("source_blob", "match_json", *SEASON_KEYS).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*SEASON_KEYS).option("compression", "snappy").parquet(target))
        loaded = read_stored(spark, target, SEASON_STORE).join(todo.select(*SEASON_KEYS).distinct(), list(SEASON_KEYS), "left_semi")
        (loaded.groupBy(*SEASON_KEYS).agg(F.count(F.lit(1)).alias("rows")).write.mode("append")
         .parquet(f"{target.rstrip('/')}/_loads"))
    marks = season_marks(spark, target)
    rows = F.coalesce("rows", F.lit(0))
    counts = (spark.createDataFrame([], SEASON_MARKS) if marks is None
              else marks.groupBy(*SEASON_KEYS).agg(F.max("rows").alias("rows")))
    out = seasons.join(counts, list(SEASON_KEYS), "left").select(
        F.col("season_name").alias("item"), rows.alias("rows"), (rows > 0).alias("ok"))
    return out if log is None else out.unionByName(log)


RUN_LOG = T.StructType([
    T.StructField("item", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("columns", T.IntegerType()),
    T.StructField("ok", T.BooleanType()), T.StructField("bytes", T.LongType()),
    T.StructField("written_at", T.StringType())])


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def publish_gold(tables: Mapping[str, DataFrame], root: str, snapshot_date: str,
                 orders: Mapping[str, Sequence[str]] | None = None, writer=write_parquet) -> DataFrame:
    """C10 + K5 + K6: write each table as dated Parquet, verify by reading back, and
    return the run log; one small aggregate per table reaches the driver.

    Row count and a checksum over all columns are observed in the writing job itself and
    compared with what is read back, so rows lost or altered on the way are logged
    ``ok=false``, as are changed columns.  ``orders`` names sort columns (``-`` before a
    descending number) of tables that are exported in order (O1-O3): their part files,
    numbered by range, must hold the rows in that order.  ``writer(df, path)`` must run
    ``df`` once."""
    from ..sources.layers import content, observed, order_kept, verify_written
    if not tables:
        raise ValueError("publish_gold needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    log = []
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}/snapshot_date={snapshot_date}"
        try:
            sent = observed(df, content(df.columns, df.schema), lambda x, p=path: writer(x, p))
            v = verify_written(spark, path, df.columns, sent)
            in_order = order_kept(spark, path, orders[name]) if orders and name in orders else True
        except PySparkException:       # this table failed; the others still go out
            log.append((name, path, None, None, False, None, None))
            continue
        log.append((name, path, v["rows"], v["columns"], bool(v["columns_ok"] and v["content_ok"] and in_order), v["bytes"],
                    v["written_at"]))
    return spark.createDataFrame(log, RUN_LOG)


def run_log_summary(log: DataFrame, ok_col: str = "ok") -> DataFrame:
    """K7: one row: items, succeeded, failed, overall (false when empty)."""
    ok = F.col(ok_col)
    n = F.count(F.lit(1))
    return log.agg(n.alias("items"), F.count_if(ok).alias("succeeded"),
                   F.count_if(~ok | ok.isNull()).alias("failed"),
                   (F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(False)) & (n > 0))
                   .alias("overall"))
