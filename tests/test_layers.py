"""Silver storage (S4, K3, R2), staging views (S8, K4), B3, R9, F2/O6."""

import json
import os

import pytest
from pyspark.sql import functions as F

from medallion.operators.sequence import dedup_latest
from medallion.plans import quality as q
from medallion.plans.dashboards import sample_where
from medallion.plans.gold import standings
from medallion.schemas import BRONZE_PLAYERS_DOC
from medallion.sources import bronze, layers
from medallion.sources import fixtures as fx


def test_silver_snapshots_newest_by_default(spark, sf_small, tmp_path):
    root = str(tmp_path / "silver")
    m = fx.matches(spark, sf_small)
    layers.write_silver(m, root, "matches", "2024-09-01", q.MATCH_CHECKS)
    layers.write_silver(m.limit(10), root, "matches", "2024-09-08", q.MATCH_CHECKS)
    assert layers.read_silver(spark, root, "matches").count() == 10          # R2
    assert layers.read_silver(spark, root, "matches", all_snapshots=True).count() == m.count() + 10
    # rewriting one snapshot replaces only that partition
    layers.write_silver(m.limit(3), root, "matches", "2024-09-08", q.MATCH_CHECKS)
    assert layers.read_silver(spark, root, "matches", all_snapshots=True).count() == m.count() + 3
    bad = m.withColumn("match_id", F.lit(1))
    with pytest.raises(q.QualityGateError):
        layers.write_silver(bad, root, "matches", "2024-09-15", q.MATCH_CHECKS)
    assert layers.read_silver(spark, root, "matches").count() == 3


def test_staging_views_and_mart(spark, sf_small):
    layers.register_staging(spark, {"stg_matches": fx.matches(spark, sf_small)})
    n = spark.sql("select count(*) from stg_matches where is_finished").collect()[0][0]
    assert n == fx.matches(spark, sf_small).filter("is_finished").count()
    layers.materialize_mart(standings(spark.table("stg_matches")), "standings_test")
    assert layers.read_table(spark, "standings_test").count() > 0
    layers.drop_mart(spark, "standings_test")


def test_leading_scorers(spark, tmp_path):
    doc = {"scorers": [{"player": {"name": "A"}, "team": {"name": "X"}, "goals": 3},
                       {"player": {}, "goals": None},
                       {"player": {"name": "C"}, "team": {"name": "Z"}, "goals": 1},
                       {"player": {"name": "D"}, "goals": 9}]}
    os.makedirs(tmp_path / "p")
    (tmp_path / "p" / "2024-09-08_x.json").write_text(json.dumps(doc, indent=2))
    docs = bronze.read_documents(spark, str(tmp_path / "p"), BRONZE_PLAYERS_DOC)
    got = [(r["place"], r["name"], r["team"], r["goals"])
           for r in bronze.leading_scorers(docs).orderBy("place").collect()]
    assert got == [(1, "A", "X", 3), (2, "Unknown", "Unknown", 0), (3, "C", "Z", 1)]


def test_dedup_latest_and_sample(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (2, "2024-01-01", "c")],
                               "id int, snap string, v string")
    got = sorted((r["id"], r["v"]) for r in dedup_latest(df, ["id"], [F.col("snap").desc()]).collect())
    assert got == [(1, "b"), (2, "c")]
    assert sample_where(df, "id", 1, 5).count() == 2
