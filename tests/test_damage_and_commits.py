"""Damaged documents never vanish; unfinished snapshots are repaired; concurrent ingests store one copy."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from medallion.plans import ingest, jobs
from medallion.plans import quality as q
from medallion.schemas import BRONZE_MATCHES_DOC
from medallion.sources import bronze
from medallion.sources.commits import SnapshotStore

from .test_silver_bronze import match, write_doc

CUT = '{"matches": [{"id": 1}, {"id": 2}], "_ingestion_metadata": {"source": '


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.fixture
def damaged_root(tmp_path):
    root = str(tmp_path / "bronze" / "matches")
    write_doc(root, "2024-09-08_matches_season_2024_page_1.json", {"matches": [match(1), match(2)]})
    put(root, "2024-09-08_matches_season_2024_page_2.json", CUT)
    put(root, "2024-09-08_matches_season_2024_page_3.json", "")
    put(root, "2024-09-08_matches_season_2024_page_4.json", " \n")
    put(root, "2024-09-08_matches_season_2024_page_5.json", '{"matches": "none"}')
    write_doc(root, "2024-09-08_matches_season_2024_page_6.json", {"matches": [match(3, matchday="first")]})  # one bad value
    write_doc(root, "2024-09-08_matches_season_2024_page_7.json", {"matches": []})
    return str(tmp_path / "bronze")


def test_listing_against_parse(spark, damaged_root):
    log = bronze.document_log(spark, f"{damaged_root}/matches", "matches")
    got = {int(r.file_name[-6]): (r.documents, r.records, r.problem) for r in log.collect()}
    assert got == {1: (1, 2, None), 2: (1, 0, "unreadable"), 3: (0, 0, "empty"), 4: (0, 0, "empty"), 5: (1, 0, "unreadable"),
                   6: (1, 1, None), 7: (1, 0, None)}


def test_reading_raises_or_marks(spark, damaged_root):
    with pytest.raises(Exception, match="unreadable document: .*page_"):
        bronze.records(bronze.read_documents(spark, f"{damaged_root}/matches", BRONZE_MATCHES_DOC), "matches").collect()
    docs = bronze.read_documents(spark, f"{damaged_root}/matches", BRONZE_MATCHES_DOC, on_damage="quarantine")
    assert sorted(r.file_name[-6] for r in docs.where("problem is not null").collect()) == ["2", "5"]
    assert sorted(r.id for r in bronze.records(docs, "matches").select("id").collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="on_damage"):
        bronze.read_documents(spark, f"{damaged_root}/matches", BRONZE_MATCHES_DOC, on_damage="ignore")


def test_job_raises_or_quarantines(spark, damaged_root, tmp_path):
    silver = str(tmp_path / "silver")
    with pytest.raises(q.QualityGateError, match="4 of 7 documents cannot be read"):
        jobs.silver_job(spark, "matches", damaged_root, silver, "2024-09-08")
    assert not os.path.exists(silver)
    rows = jobs.silver_job(spark, "matches", damaged_root, silver, "2024-09-08", on_damage="quarantine")
    assert [(r["check"], r["passed"], r["value"]) for r in rows if r["check"] == "documents_readable"] == [("documents_readable", False, "3/7")]
    assert spark.read.parquet(f"{silver}/matches").count() == 3
    held = spark.read.parquet(f"{silver}/_quarantine/matches/snapshot_date=2024-09-08").collect()
    assert sorted((r.source_blob[-6], r.problem) for r in held) == [("2", "unreadable"), ("3", "empty"), ("4", "empty"), ("5", "unreadable")]


def test_an_empty_newest_snapshot_is_not_passed_over(spark, tmp_path):
    root = str(tmp_path / "b" / "matches")
    write_doc(root, "2024-09-01_matches_season_2024.json", {"matches": [match(1)]})
    put(root, "2024-09-08_matches_season_2024.json", "")
    with pytest.raises(q.QualityGateError, match="2024-09-08.*: empty"):
        jobs.silver_job(spark, "matches", str(tmp_path / "b"), str(tmp_path / "s"), "2024-09-08")


def test_damaged_season_files_and_index(spark, tmp_path):
    root, store = str(tmp_path / "m"), str(tmp_path / "store")
    for s in (1, 2, 3, 4):
        put(f"{root}/16", f"{s}.json", json.dumps([{"id": s}, {"id": 10 + s}]) if s in (1, 4) else "")
    put(f"{root}/16", "3.json", CUT)
    put(f"{root}/11", "3.json", "not of this competition")
    put(str(tmp_path), "index.json", json.dumps([{"competition_id": 16, "season_id": s, "season_name": f"s{s}"} for s in (1, 2, 3, 4)]))
    args = (spark, str(tmp_path / "index.json"), root, 16, store)
    with pytest.raises(q.QualityGateError, match="unreadable season file"):
        ingest.season_index_ingest(*args)
    assert not os.path.exists(store)
    log = {r["item"].rsplit("/", 1)[-1]: (r["rows"], r["ok"]) for r in ingest.season_index_ingest(*args, on_damage="quarantine").collect()}
    assert log == {"s1": (2, True), "s2": (0, False), "s3": (0, False), "s4": (2, True), "2.json: empty": (0, False),
                   "3.json: unreadable": (0, False)}
    for s in (2, 3):        # repaired files are taken by the next run
        put(f"{root}/16", f"{s}.json", json.dumps({"matches": [{"id": s}]}))
    assert {r["item"]: (r["rows"], r["ok"]) for r in ingest.season_index_ingest(*args).collect()} == {
        "s1": (2, True), "s2": (1, True), "s3": (1, True), "s4": (2, True)}
    put(str(tmp_path), "bad_index.json", '[{"competition_id": 16')
    with pytest.raises(Exception, match="unreadable index"):
        bronze.read_competition_index(spark, str(tmp_path / "bad_index.json")).collect()


def ten(spark):
    return spark.range(10).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"))


def ids(spark, target):
    return sorted(r.id for r in spark.read.parquet(target).collect())


def run(spark, target, rows=None):
    log = ingest.bronze_ingest(spark, ten(spark) if rows is None else rows, target, "2024-09-01", 2024, "api", entity="team")
    return [tuple(r) for r in log.collect()]


GOOD = [("2024-09-01/2024", 10, True)]
KEY = SnapshotStore.key("2024-09-01", 2024)


def test_a_fragment_is_replaced(spark, tmp_path):
    target = str(tmp_path / "t")
    ingest.annotate(ten(spark).limit(3), "2024-09-01", 2024, "api").drop(*ingest.SNAPSHOT_KEYS).write.parquet(f"{target}/{KEY}")
    assert run(spark, target) == GOOD and ids(spark, target) == list(range(10))


def test_a_whole_snapshot_without_a_mark_is_kept(spark, tmp_path):
    target = str(tmp_path / "t")
    ingest.annotate(ten(spark).limit(3), "2024-09-01", 2024, "old", extra={"team_count": 3}).drop(
        *ingest.SNAPSHOT_KEYS).write.parquet(f"{target}/{KEY}")
    assert run(spark, target) == [("2024-09-01/2024", 3, True)] and ids(spark, target) == [0, 1, 2]


def test_every_cut_off_step_is_finished(spark, tmp_path):
    target = str(tmp_path / "t")
    store = SnapshotStore(spark, target)
    _, folder = store.staging()             # staged, never committed
    ten(spark).limit(4).write.parquet(folder)
    assert run(spark, target) == GOOD
    first = store.mark(KEY)
    for f in os.listdir(f"{target}/{KEY}"):  # files lost after the commit
        if f.endswith(".parquet"):
            os.remove(f"{target}/{KEY}/{f}")
            break
    assert run(spark, target) == GOOD and store.mark(KEY)["generation"] == first["generation"] + 1
    attempt, folder = store.staging()       # committed, half moved into place
    ingest.annotate(ten(spark).repartition(4), "2024-09-01", 2024, "api").drop(*ingest.SNAPSHOT_KEYS).write.parquet(folder)
    assert store.commit(KEY, attempt, 10, after=store.mark(KEY))
    part = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    os.rename(f"{folder}/{part}", f"{target}/{KEY}/{attempt}-{part}")
    assert run(spark, target) == GOOD and ids(spark, target) == list(range(10))
    assert store.committed() == [("2024-09-01", 2024)]


def test_concurrent_ingests_store_one_copy(spark, tmp_path):
    target, out = str(tmp_path / "t"), []
    gate = threading.Barrier(3)

    def one():
        gate.wait()
        out.append(run(spark, target))

    threads = [threading.Thread(target=one) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert out == [GOOD] * 3 and ids(spark, target) == list(range(10))


def test_paged_snapshots_and_pruning(spark, tmp_path):
    root = str(tmp_path / "b")
    pages = spark.range(20).select(F.struct(F.col("id"), F.concat(F.lit("club "), F.col("id")).alias("name")).alias("r"), "id")
    for day, low in (("2024-08-01", 0), ("2024-09-01", 5)):
        grouped = pages.where(F.col("id") >= low).groupBy(F.floor(F.col("id") / 4).alias("p")).agg(F.collect_list("r").alias("r"))
        bronze.write_pages(grouped, f"{root}/teams", F.lit(f"{day}_teams_season_2024"), F.col("r"), "teams")
    assert bronze.newest_snapshots(spark, f"{root}/teams") == [(dt.date(2024, 9, 1), 2024)]
    recs = jobs.newest_records(spark, "teams", root)
    assert sorted(r.id for r in recs.select("id").collect()) == list(range(5, 20))
    assert {r.source_blob.rsplit("/", 1)[0] for r in recs.select("source_blob").collect()} == {"teams/snapshot=2024-09-01_teams_season_2024"}
    listed = bronze.list_snapshots(spark, f"{root}/teams").groupBy("snapshot_date").count().collect()
    assert sorted(r["count"] for r in listed) == [4, 5]


def test_newest_records_layout_reads_committed_snapshots_only(spark, tmp_path):
    target = str(tmp_path / "teams")
    recs = ten(spark).withColumn("shortName", F.lit("x"))
    ingest.bronze_ingest(spark, recs, target, "2024-09-01", 2024, "api")
    fragment = f"{target}/{SnapshotStore.key('2024-09-08', 2024)}"      # a newer one that never finished
    ingest.annotate(recs.limit(2), "2024-09-08", 2024, "api").drop(*ingest.SNAPSHOT_KEYS).write.parquet(fragment)
    for per_season in (False, True):
        got = jobs.newest_records(spark, "teams", str(tmp_path), per_season, layout="records")
        assert got.count() == 10
