"""Rules of the file side: what is read, what is gated, what a failure leaves."""

import json
import os

import pytest
from pyspark.sql import functions as F

from medallion.plans import ingest, jobs
from medallion.plans import quality as q
from medallion.plans.silver import silver_matches, silver_teams
from medallion.schemas import BRONZE_MATCHES_DOC
from medallion.sources import bronze, layers
from medallion.streaming.bronze_stream import run_bronze_to_silver, stream_location

from .test_streaming import doc, put


def write(path, payload):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(payload, f)


def test_competitions_that_share_a_season_id_stay_apart(spark, tmp_path):
    root, store = str(tmp_path / "m"), str(tmp_path / "store")
    write(f"{root}/16/4.json", [{"id": 1}, {"id": 2}])
    write(f"{root}/11/4.json", [{"id": 3}, {"id": 4}, {"id": 5}])
    write(str(tmp_path / "index.json"), {"all_competitions": [
        {"competition_id": c, "season_id": 4, "season_name": f"s{c}"} for c in (11, 16)]})
    args = (spark, str(tmp_path / "index.json"), root)
    assert [tuple(r) for r in ingest.season_index_ingest(*args, 16, store).collect()] == [("s16", 2, True)]
    assert spark.read.parquet(store).count() == 2
    # the other competition goes into the same store, and a rerun adds nothing
    assert [tuple(r) for r in ingest.season_index_ingest(*args, 11, store).collect()] == [("s11", 3, True)]
    assert [tuple(r) for r in ingest.season_index_ingest(*args, 11, store).collect()] == [("s11", 3, True)]
    got = spark.read.parquet(store).groupBy("competition_id", "season_id").count()
    assert sorted(tuple(r) for r in got.collect()) == [(11, 4, 3), (16, 4, 2)]


def test_ids_beyond_32_bits_are_counted_and_block(spark, tmp_path):
    bad = doc([1])
    bad["matches"][0]["homeTeam"]["id"] = 3_000_000_000
    write(str(tmp_path / "b" / "2024-09-01_matches_season_2024.json"), bad)
    recs = bronze.records(bronze.read_documents(spark, str(tmp_path / "b"), BRONZE_MATCHES_DOC), "matches")
    flat = silver_matches(recs, count_rejects=True)
    rows = {r["check"]: r for r in q.check_results(flat, "matches", q.MATCH_CHECKS).collect()}
    assert not rows["no_rejected_values"]["passed"] and rows["no_rejected_values"]["value"] == "1"
    with pytest.raises(q.QualityGateError, match="no_rejected_values"):
        layers.write_silver(flat, str(tmp_path / "s"), "matches", "2024-09-01", q.MATCH_CHECKS)
    assert not os.path.exists(str(tmp_path / "s"))


def test_what_is_gated_is_what_is_written_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).select(F.col("id").cast("int").alias("team_id")).mapInArrow(count, "team_id int")
    layers.write_silver(df, str(tmp_path), "t", "2024-09-01", [q.Check("u", "unique", q.FAIL, "team_id")])
    assert seen.value == 100
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_stream_progress_has_one_place_for_all_applications(spark, tmp_path):
    here = stream_location(spark, "/b", "/s", "matches")
    assert here.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.sparkContext.getCheckpointDir().rsplit("/", 1)[-1] not in here  # not the application's own folder
    assert here != stream_location(spark, "/b", "/other", "matches")
    src, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    os.makedirs(src)
    put(src, "2024-09-01_matches_season_2024.json", doc([1, 2]))
    args = (spark, src, out, "matches", BRONZE_MATCHES_DOC, "matches", silver_matches, q.MATCH_CHECKS)
    run_bronze_to_silver(*args)
    run_bronze_to_silver(*args)
    assert spark.read.parquet(out).count() == 2


def test_a_key_repeated_across_batches_of_a_snapshot_is_stopped(spark, tmp_path):
    src, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    os.makedirs(src)
    args = (spark, src, out, "matches", BRONZE_MATCHES_DOC, "matches", silver_matches, q.MATCH_CHECKS)
    put(src, "2024-09-01_matches_page1_season_2024.json", doc([1, 2]))
    run_bronze_to_silver(*args, checkpoint_location=ck)
    put(src, "2024-09-01_matches_season_2023.json", doc([1]))      # another season: kept
    run_bronze_to_silver(*args, checkpoint_location=ck)
    put(src, "2024-09-01_matches_page2_season_2024.json", doc([2, 3]))
    with pytest.raises(Exception, match="already stored"):
        run_bronze_to_silver(*args, checkpoint_location=ck)
    assert spark.read.parquet(out).count() == 3


def test_a_store_without_the_keys_is_an_error(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="lacks the key columns"):
        ingest.stored_keys(spark, str(tmp_path / "x"), ingest.SEASON_STORE, ingest.SEASON_KEYS)
    assert ingest.stored_keys(spark, str(tmp_path / "none"), ingest.SEASON_STORE, ingest.SEASON_KEYS) is None


def test_empty_first_snapshot_and_metadata(spark, tmp_path):
    recs = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    target = str(tmp_path / "t")
    log = ingest.bronze_ingest(spark, recs.limit(0), target, "2024-09-01", 2024, "api")
    assert [tuple(r) for r in log.collect()] == [("2024-09-01/2024", 0, False)]
    with pytest.raises(q.QualityGateError, match="no rows"):
        ingest.bronze_ingest(spark, recs.limit(0), target, "2024-09-01", 2024, "api", allow_empty=False)
    for _ in range(2):
        log = ingest.bronze_ingest(spark, recs, target, "2024-09-01", 2024, "api", entity="team",
                                   ingested_by="job", endpoint="/teams")
        assert [tuple(r) for r in log.collect()] == [("2024-09-01/2024", 2, True)]
    meta = spark.read.parquet(target).select("_ingestion_metadata.*").first()
    assert (meta.team_count, meta.ingested_by, meta.endpoint, meta.match_count) == (2, "job", "/teams", None)


def test_one_failing_table_is_logged_and_the_others_go_out(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    log = {r["item"]: r for r in ingest.publish_gold({"bad": bad, "good": good}, str(tmp_path), "2024-09-01").collect()}
    assert (log["bad"]["ok"], log["good"]["ok"], log["good"]["rows"]) == (False, True, 3)


def test_extra_columns_fail_the_read_back(spark, tmp_path):
    spark.range(2).select("id", F.lit(1).alias("extra")).write.parquet(str(tmp_path / "p"))
    assert not layers.verify_written(spark, str(tmp_path / "p"), ["id"])["columns_ok"]
    assert layers.verify_written(spark, str(tmp_path / "p"), ["id", "extra"])["columns_ok"]


def test_record_counts_without_ansi(spark):
    docs = spark.createDataFrame([("a", [1, 2]), ("b", None)], "source_blob string, xs array<int>")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert {r[0]: r[1] for r in bronze.record_counts(docs, "xs").collect()} == {"a": 2, "b": 0}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_one_club_in_two_seasons(spark, tmp_path):
    for y in (2023, 2024):
        write(str(tmp_path / "b" / "teams" / f"{y}-09-01_teams_season_{y}.json"),
              {"teams": [{"id": 1, "name": f"Club {y}", "area": {"name": "X"}, "tla": "CLB"}]})
        write(str(tmp_path / "b" / "players" / f"{y}-09-01_scorers_season_{y}.json"),
              {"scorers": [{"player": {"id": p, "name": f"P{p}"}, "team": {"id": 1}, "goals": p * (y - 2022)} for p in (1, 2)]})
    for entity in ("teams", "players"):
        checks = {}
        jobs.silver_job(spark, entity, str(tmp_path / "b"), str(tmp_path / "s"), "2024-09-02", per_season=True, verify=checks)
        assert set(checks) == {f"{entity}_season_2023", f"{entity}_season_2024"}
        assert all(v["columns_ok"] for v in checks.values())
    for y in (2023, 2024):
        t = spark.read.parquet(str(tmp_path / "s" / f"teams_season_{y}")).collect()
        assert [r["team_name"] for r in t] == [f"Club {y}"]
        p = spark.read.parquet(str(tmp_path / "s" / f"players_season_{y}")).collect()
        assert {r["player_id"]: r["scorer_rank"] for r in p} == {2: 1, 1: 2}


def test_newest_snapshot_comes_from_the_folder_names(spark, tmp_path):
    flat = spark.createDataFrame([(1,)], "team_id int")
    for day in ("2024-09-01", "2024-10-01"):
        layers.write_silver(flat, str(tmp_path), "t", day, [])
    assert layers.newest_partition(spark, str(tmp_path / "t"), "snapshot_date") == "2024-10-01"
    assert layers.newest_partition(spark, str(tmp_path / "none"), "snapshot_date") is None
    assert silver_teams is not None


def test_marts_as_tables_then_exported(spark, tmp_path):
    spark.sql("create database if not exists marts_t")
    flat = spark.range(3).withColumnRenamed("id", "x")
    layers.materialize_mart(flat, "marts_t.m")
    layers.materialize_mart(flat.limit(1), "marts_t.m")     # rebuilt in full
    assert layers.read_table(spark, "marts_t.m").count() == 1
    spark.sql("drop database marts_t cascade")
