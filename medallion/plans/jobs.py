"""The reference's runnable steps as Spark jobs.

* ``silver_job``: one entity (matches, teams or players) from its newest
  Bronze document to a dated, gated Silver snapshot (C5 + C6 + K3).
* ``gold_job``: newest Silver snapshots as staging views, the three marts,
  the declarative tests, and the dated Gold publication with its run log
  (S4, S8, C1-C4, C7, C10).

Both only move small, bounded results to the driver: check rows, test
failure counts and the run log.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (BRONZE_MATCHES_DOC, BRONZE_PLAYERS_DOC, BRONZE_TEAMS_DOC, SILVER_MATCHES,
                       SILVER_PLAYERS, SILVER_TEAMS)
from ..operators.ranking import scratch_scope
from ..sources import bronze, layers
from ..sources.commits import SnapshotStore
from . import gold, ingest
from . import quality as q
from .silver import silver_matches, silver_players, silver_teams


@dataclass(frozen=True)
class Entity:
    folder: str
    doc_schema: object
    array_field: str
    flatten: object
    checks: tuple
    silver_schema: object
    by_season: bool = True      # keys repeat across seasons, so seasons are kept apart


ENTITIES = {
    "matches": Entity("matches", BRONZE_MATCHES_DOC, "matches", silver_matches, q.MATCH_CHECKS,
                      SILVER_MATCHES, by_season=False),
    "teams": Entity("teams", BRONZE_TEAMS_DOC, "teams", silver_teams, q.TEAM_CHECKS, SILVER_TEAMS),
    "players": Entity("players", BRONZE_PLAYERS_DOC, "scorers", silver_players, q.PLAYER_CHECKS,
                      SILVER_PLAYERS),
}


def newest_records(spark: SparkSession, entity: str, bronze_root: str, per_season: bool = False,
                   layout: str = "documents", on_damage: str = bronze.RAISE, snapshots: list | None = None) -> DataFrame:
    """Records of the newest Bronze snapshot of ``entity`` with a
    ``source_blob`` column naming the snapshot within the store.

    ``layout="documents"``: JSON documents ``<entity>/<date>_..._season_<n>.json``
    (the reference's layout) or pages in folders of such names; all pages of the newest
    snapshot are read.  ``layout="records"``: the record-per-row Parquet written by
    ``ingest.bronze_ingest``, partitioned by ``snapshot_date`` / ``snapshot_season``; the
    newest committed snapshot is chosen by its mark (per season with ``per_season``).
    ``_season`` is the snapshot's season."""
    e = ENTITIES[entity]
    path = os.path.join(bronze_root, e.folder)
    if layout == "documents":
        # List first (no contents read), then parse only the newest snapshot's documents.
        if snapshots is None:
            snapshots = bronze.newest_snapshots(spark, path, per_season)
        if not snapshots:
            raise q.QualityGateError(f"bronze {entity}: no snapshot under {path}")
        newest = bronze.read_snapshots(spark, path, snapshots, e.doc_schema, on_damage=on_damage)
        if on_damage == bronze.QUARANTINE:
            newest = newest.where(F.col(bronze.PROBLEM).isNull())
        q.require_rows(newest, f"bronze {entity}")
        recs = bronze.records(newest, e.array_field, keep=("source_blob",))
        inside = F.regexp_extract("source_blob", rf"/{e.folder}/((?:[^/]*\d{{4}}-\d{{2}}-\d{{2}}[^/]*/)?[^/]+)$", 1)
        return recs.withColumns({"source_blob": F.concat(F.lit(f"{e.folder}/"), inside),
                                 "_season": bronze.snapshot_keys(F.col("source_blob"))[1]})
    if layout != "records":
        raise ValueError(f"unknown Bronze layout {layout!r}")
    record = e.doc_schema[e.array_field].dataType.elementType
    schema = T.StructType(list(record.fields) + [
        T.StructField("snapshot_date", T.DateType()), T.StructField("snapshot_season", T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    committed = SnapshotStore(spark, path).committed()
    if committed is not None:           # one name per snapshot
        best = {s: d for d, s in sorted(committed, key=lambda k: k[0])}
        last = max(best.values(), default=None)
        wanted = [(d, s) for s, d in best.items() if per_season or d == last]
        if not per_season:
            wanted = [(d, s) for d, s in committed if d == last]
        newest = stored.where(reduce(lambda a, b: a | b, [
            (F.col("snapshot_date") == F.lit(d).cast("date")) & F.col("snapshot_season").eqNullSafe(F.lit(s).cast("int"))
            for d, s in wanted], F.lit(False)))
    elif per_season:
        newest = bronze.latest_snapshot(stored, "snapshot_date", ["snapshot_season"])
    else:
        day = layers.newest_partition(spark, path, "snapshot_date")
        newest = stored.where(F.col("snapshot_date") == F.lit(day).cast("date"))
    q.require_rows(newest, f"bronze {entity}")
    return newest.withColumns({"source_blob": F.concat(
        F.lit(f"{e.folder}/snapshot_date="), F.col("snapshot_date").cast("string")), "_season": F.col("snapshot_season")})


def check_documents(spark: SparkSession, entity: str, bronze_root: str, snapshots: list, on_damage: str,
                    silver_root: str, snapshot_date: str) -> list:
    """Q13: hold the listing of the newest snapshot's files against what parses.

    ``raise``: fails, naming the first damaged file.  ``quarantine``: path and reason of
    every damaged file go to ``<silver_root>/_quarantine/<entity>/snapshot_date=...`` and one
    check row says how many."""
    e = ENTITIES[entity]
    log = bronze.document_log(spark, os.path.join(bronze_root, e.folder), e.array_field, snapshots=snapshots)
    bad = log.where(F.col(bronze.PROBLEM).isNotNull())
    n, damaged, first = log.agg(F.count(F.lit(1)), F.count(bronze.PROBLEM), F.min(F.when(
        F.col(bronze.PROBLEM).isNotNull(), F.concat("source_blob", F.lit(": "), bronze.PROBLEM)))).first()
    if damaged and on_damage == bronze.RAISE:
        raise q.QualityGateError(f"bronze {entity}: {damaged} of {n} documents cannot be read, first {first}")
    if damaged:
        bad.select("source_blob", "bytes", bronze.PROBLEM).write.mode("overwrite").parquet(
            f"{silver_root.rstrip('/')}/_quarantine/{entity}/snapshot_date={snapshot_date}")
    return [Row(table=entity, check="documents_readable", severity=q.WARN, passed=not damaged, value=f"{n - damaged}/{n}")]


def silver_job(spark: SparkSession, entity: str, bronze_root: str, silver_root: str,
               snapshot_date: str, per_season: bool = False, verify: dict | None = None,
               layout: str = "documents", on_damage: str = bronze.RAISE) -> list:
    """Newest Bronze snapshot of ``entity`` -> Silver snapshot ``snapshot_date``.

    With ``per_season`` the newest snapshot of every season is taken.  Matches,
    whose keys are unique over all seasons, share one table; teams and players
    are flattened, checked and ranked season by season and written to
    ``<entity>_season_<n>`` (one round per season).  Raises ``QualityGateError``
    (nothing published) when a FAIL check fails; returns the check rows otherwise.
    Documents that cannot be read, or are empty, stop the job; with
    ``on_damage="quarantine"`` they are listed below ``<silver_root>/_quarantine`` and
    the job goes on without them (``check_documents``).
    Pass a dict as ``verify`` to receive the K6 read-back of the written snapshot
    (rows, columns, bytes, time), by table where there are several."""
    e = ENTITIES[entity]
    rows, snapshots = [], None
    if layout == "documents":
        snapshots = bronze.newest_snapshots(spark, os.path.join(bronze_root, e.folder), per_season)
        if snapshots:
            found = check_documents(spark, entity, bronze_root, snapshots, on_damage, silver_root, snapshot_date)
            rows += [r for r in found if not r["passed"]]
    recs_all = newest_records(spark, entity, bronze_root, per_season, layout, on_damage, snapshots)
    for table, recs in _by_season(recs_all, entity, per_season):
        with scratch_scope(spark):      # the players rank's table is dropped after the write
            silver = e.flatten(recs, source=F.col("source_blob"), count_rejects=True)
            rows += layers.write_silver(silver, silver_root, table, snapshot_date, e.checks)
        if verify is not None:
            found = layers.verify_written(spark, layers.snapshot_path(silver_root, table, snapshot_date),
                                          e.silver_schema.fieldNames())
            verify.update(found if table == entity else {table: found})
    return rows


def _by_season(recs: DataFrame, entity: str, per_season: bool) -> list[tuple[str, DataFrame]]:
    if not (per_season and ENTITIES[entity].by_season):
        return [(entity, recs)]
    seasons = sorted((r[0] for r in recs.select("_season").distinct().collect()), key=lambda x: (x is None, x))
    return [(f"{entity}_season_{'none' if s is None else s}", recs.where(F.col("_season").eqNullSafe(F.lit(s).cast("int"))))
            for s in seasons]


def staging(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """S4 + S8: newest Silver snapshot of each entity as staging views."""
    models = {f"stg_{name}": layers.read_silver(spark, silver_root, name, e.silver_schema)
              for name, e in ENTITIES.items()}
    layers.register_staging(spark, models)
    return models


def gold_job(spark: SparkSession, silver_root: str, gold_root: str, snapshot_date: str,
             fail_on_tests: bool = False, mart_database: str | None = None) -> DataFrame:
    """Staging -> marts -> declarative tests -> dated Gold tables; returns the
    run log (one row per table plus one per failing declarative test).  With
    ``mart_database`` the marts are rebuilt as managed tables there first (K4)
    and exported from those tables."""
    models = staging(spark, silver_root)
    tests = q.run_tests(models, q.STAGING_TESTS).filter(F.col("failures") > 0).collect()
    if tests and fail_on_tests:
        raise q.QualityGateError(f"declarative tests failed: {[tuple(t) for t in tests]}")
    with scratch_scope(spark):          # rank tables are dropped once the marts are written
        marts = {  # whole tables, rebuilt on each run
            "standings": gold.standings(models["stg_matches"], sort=True),
            "team_form": gold.team_form(models["stg_matches"], sort=True),
            "top_scorers": gold.top_scorers(models["stg_players"], models["stg_teams"], sort=True),
        }
        if mart_database:
            for name, df in marts.items():
                layers.materialize_mart(df, f"{mart_database}.{name}")
            marts = {name: gold.in_export_order(layers.read_table(spark, f"{mart_database}.{name}"), name) for name in marts}
        log = ingest.publish_gold(marts, gold_root, snapshot_date, orders=gold.EXPORT_ORDERS)
    if not tests:
        return log
    failed = spark.createDataFrame(
        [(f"test {t['model']}.{t['column']} {t['test']}", None, int(t["failures"]), None, False,
          None, None) for t in tests], log.schema)
    return log.unionByName(failed)
