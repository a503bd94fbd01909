"""Ingestion (K1, K2, C8, C9), publication (C10, K5-K7) and the declarative
tests (T1-T4) on small frames."""

import json
import os

import pytest

from medallion.plans import ingest
from medallion.plans import quality as q
from medallion.plans.gold import standings, team_form
from medallion.sources import fixtures as fx


def test_bronze_ingest_is_idempotent(spark, sf_small, tmp_path):
    target = str(tmp_path / "bronze_matches")
    recs = fx.bronze_match_records(fx.matches(spark, sf_small))
    n = recs.count()
    log1 = ingest.bronze_ingest(spark, recs, target, "2024-09-08", 2024, "fixture").collect()[0]
    assert log1["rows"] == n and log1["ok"]
    log2 = ingest.bronze_ingest(spark, recs, target, "2024-09-08", 2024, "fixture").collect()[0]
    assert log2["rows"] == n                       # rerun appends nothing
    ingest.bronze_ingest(spark, recs.limit(5), target, "2024-09-15", 2024, "fixture")
    stored = spark.read.parquet(target)
    assert stored.count() == n + 5
    meta = stored.select("_ingestion_metadata.source", "_ingestion_metadata.layer").distinct().collect()
    assert [tuple(r) for r in meta] == [("fixture", "bronze")]


def test_season_index_ingest(spark, tmp_path):
    idx = tmp_path / "competitions.json"
    idx.write_text(json.dumps({"all_competitions": [
        {"competition_id": 16, "season_id": 4, "season_name": "2018/2019"},
        {"competition_id": 16, "season_id": 1, "season_name": "2017/2018"},
        {"competition_id": 11, "season_id": 90, "season_name": "other"}]}, indent=2))
    root = tmp_path / "matches" / "16"
    os.makedirs(root)
    (root / "4.json").write_text(json.dumps([{"match_id": 1}, {"match_id": 2}], indent=2))
    (root / "1.json").write_text(json.dumps({"matches": [{"match_id": 3}]}, indent=2))
    (root / "90.json").write_text(json.dumps([{"match_id": 9}], indent=2))
    target = str(tmp_path / "out")
    log = {r["item"]: r for r in ingest.season_index_ingest(
        spark, str(idx), str(tmp_path / "matches"), 16, target).collect()}
    assert {k: v["rows"] for k, v in log.items()} == {"2018/2019": 2, "2017/2018": 1}
    again = ingest.season_index_ingest(spark, str(idx), str(tmp_path / "matches"), 16, target)
    assert sorted(r["rows"] for r in again.collect()) == [1, 2]     # nothing appended twice
    summary = ingest.run_log_summary(again).collect()[0]
    assert summary["overall"] and summary["items"] == 2
    with pytest.raises(ValueError):
        ingest.season_index_ingest(spark, str(idx), str(tmp_path / "matches"), 99, target)


def test_publish_gold_and_run_log(spark, sf_small, tmp_path):
    m = fx.matches(spark, sf_small)
    tables = {"standings": standings(m), "team_form": team_form(m)}
    log = ingest.publish_gold(tables, str(tmp_path / "gold"), "2024-09-08")
    rows = {r["item"]: r for r in log.collect()}
    assert rows["standings"]["rows"] == spark.read.parquet(rows["standings"]["path"]).count() > 0
    assert all(r["ok"] for r in rows.values())
    assert all(r["bytes"] > 0 and r["written_at"] for r in rows.values())
    s = ingest.run_log_summary(log).collect()[0]
    assert (s["items"], s["succeeded"], s["failed"], s["overall"]) == (2, 2, 0, True)
    empty = ingest.run_log_summary(log.filter("false")).collect()[0]
    assert empty["overall"] is False                               # empty log is a failure


def test_new_snapshots_anti_join(spark):
    inc = spark.createDataFrame([(1, "2024-01"), (2, "2024-02"), (3, None)], "id int, k string")
    have = spark.createDataFrame([("2024-01",), (None,)], "k string")
    got = sorted(r["id"] for r in ingest.new_snapshots(inc, have, ["k"]).collect())
    assert got == [2]


def test_checks_fail_warn_info(spark):
    df = spark.createDataFrame([(1, "FINISHED", None), (1, "WEIRD", 3), (None, None, 2)],
                               "match_id int, status string, goals int")
    checks = (q.Check("ids", "not_null", q.FAIL, "match_id"),
              q.Check("uniq", "unique", q.FAIL, "match_id"),
              q.Check("status", "accepted", q.WARN, "status", param=("FINISHED",)),
              q.Check("neg", "non_negative", q.FAIL, "goals"),
              q.Check("n", "row_count_min", q.WARN, param=5))
    res = {r["check"]: r for r in q.check_results(df, "t", checks).collect()}
    assert res["ids"]["value"] == "1" and not res["ids"]["passed"]
    assert res["uniq"]["value"] == "2/3" and not res["uniq"]["passed"]   # null counts as one
    assert res["status"]["value"] == "1" and res["neg"]["passed"]
    with pytest.raises(q.QualityGateError) as e:
        q.enforce(q.check_results(df, "t", checks))
    assert "ids" in str(e.value) and "status" not in str(e.value)      # R7: WARN not listed
    ok = q.enforce(q.check_results(df.filter("match_id is not null"), "t", checks[2:]))
    assert {r["check"] for r in ok} == {"status", "neg", "n"}
    with pytest.raises(q.QualityGateError):
        q.require_rows(df.filter("false"), "snapshot")
    assert q.require_rows(df.filter("false"), "snapshot", allow_empty=True) is False


def test_declarative_tests(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, 99), (None, None)], "id int, team int")
    parent = spark.createDataFrame([(10, "a"), (11, None)], "team int, name string")
    spec = [q.ColumnTest("c", "not_null", "id"), q.ColumnTest("c", "unique", "id"),
            q.ColumnTest("c", "accepted_values", "team", values=(10,)),
            q.ColumnTest("c", "relationships", "team", to="p", parent_key="team"),
            q.ColumnTest("p", "not_null", "name")]
    got = {(r["model"], r["test"], r["column"]): r["failures"]
           for r in q.run_tests({"c": child, "p": parent}, spec).collect()}
    assert got == {("c", "not_null", "id"): 1, ("c", "unique", "id"): 1,
                   ("c", "accepted_values", "team"): 1, ("c", "relationships", "team"): 1,
                   ("p", "not_null", "name"): 1}
    orphan = q.orphans(child, "team", parent, "team").collect()
    assert [(r["_fk"], r["count"]) for r in orphan] == [(99, 1)]


def test_run_tests_empty_spec(spark):
    df = spark.createDataFrame([(1,)], "id int")
    out = q.run_tests({"c": df}, [])
    assert out.count() == 0 and out.columns == ["model", "test", "column", "failures"]


def test_check_results_no_checks(spark):
    out = q.check_results(spark.createDataFrame([(1,)], "id int"), "t", [])
    assert out.count() == 0 and out.columns == ["table", "check", "severity", "passed", "value"]
    assert q.enforce(out) == []
