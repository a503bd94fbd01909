"""Incremental Bronze -> Silver: each document is processed once; a failing
gate stops the stream before its batch is written."""

import json
import os

import pytest

from medallion.plans import quality as q
from medallion.plans.silver import silver_matches
from medallion.schemas import BRONZE_MATCHES_DOC
from medallion.streaming.bronze_stream import run_bronze_to_silver


def doc(ids, date="2024-09-17T20:00:00Z"):
    return {"matches": [{"id": i, "utcDate": date, "status": "FINISHED",
                         "homeTeam": {"id": 1, "name": "A"}, "awayTeam": {"id": 2, "name": "B"},
                         "score": {"winner": "DRAW", "fullTime": {"home": 1, "away": 1}}}
                        for i in ids]}


def put(folder, name, payload):
    with open(os.path.join(folder, name), "w") as f:
        json.dump(payload, f, indent=2)


def test_incremental_load(spark, tmp_path):
    src, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    os.makedirs(src)
    put(src, "2024-09-01_matches_season_2024.json", doc([1, 2]))
    put(src, "2024-09-08_matches_season_2024.json", doc([1, 2, 3]))
    args = (spark, src, out, "matches", BRONZE_MATCHES_DOC, "matches", silver_matches,
            q.MATCH_CHECKS)
    run_bronze_to_silver(*args, checkpoint_location=ck)
    got = spark.read.parquet(out)
    assert sorted((str(r["snapshot_date"]), r["n"]) for r in
                  got.groupBy("snapshot_date").count().withColumnRenamed("count", "n").collect()) == \
        [("2024-09-01", 2), ("2024-09-08", 3)]
    run_bronze_to_silver(*args, checkpoint_location=ck)          # nothing new: no change
    assert spark.read.parquet(out).count() == 5
    put(src, "2024-09-15_matches_season_2024.json", doc([4]))
    run_bronze_to_silver(*args, checkpoint_location=ck)
    assert spark.read.parquet(out).count() == 6
    put(src, "2024-09-22_matches_season_2024.json", doc([5, 5]))   # duplicate ids
    with pytest.raises(Exception, match="match_id_unique"):
        run_bronze_to_silver(*args, checkpoint_location=ck)
    assert spark.read.parquet(out).count() == 6


def test_same_day_documents_are_all_kept(spark, tmp_path):
    src, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    os.makedirs(src)
    put(src, "2024-09-08_matches_season_2023.json", doc([1, 2]))
    put(src, "2024-09-08_matches_season_2024.json", doc([3]))
    run_bronze_to_silver(spark, src, out, "matches", BRONZE_MATCHES_DOC, "matches",
                         silver_matches, q.MATCH_CHECKS, checkpoint_location=ck)
    assert sorted(r["match_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_stream_output_reads_as_silver(spark, tmp_path):
    from medallion.schemas import SILVER_MATCHES
    from medallion.sources.layers import read_silver
    src, root, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    os.makedirs(src)
    put(src, "2024-09-01_matches_season_2024.json", doc([1, 2]))
    put(src, "2024-09-08_matches_season_2024.json", doc([1, 2, 3]))
    run_bronze_to_silver(spark, src, os.path.join(root, "matches"), "matches", BRONZE_MATCHES_DOC,
                         "matches", silver_matches, q.MATCH_CHECKS, checkpoint_location=ck)
    newest = read_silver(spark, root, "matches", SILVER_MATCHES)
    assert newest.columns == SILVER_MATCHES.fieldNames()
    assert sorted(r["match_id"] for r in newest.collect()) == [1, 2, 3]
    assert read_silver(spark, root, "matches", SILVER_MATCHES, all_snapshots=True).count() == 5
