"""End to end: Bronze documents -> Silver jobs -> Gold job -> published marts."""

import os

from pyspark.sql import functions as F

from medallion.plans import jobs
from medallion.plans import quality as q

from .test_silver_bronze import bronze_root  # noqa: F401  (fixture)


def test_bronze_to_gold(spark, bronze_root, tmp_path):  # noqa: F811
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    for entity in ("matches", "teams", "players"):
        verify = {}
        rows = jobs.silver_job(spark, entity, bronze_root, silver_root, "2024-09-08", verify=verify)
        assert all(r["passed"] or r["severity"] != q.FAIL for r in rows)
        assert verify["rows"] > 0 and verify["bytes"] > 0 and verify["columns_ok"]   # K6
    log = {r["item"]: r for r in jobs.gold_job(spark, silver_root, gold_root, "2024-09-08").collect()}
    assert log["standings"]["rows"] == 2 and log["team_form"]["rows"] == 2
    assert log["top_scorers"]["rows"] == 3
    # declarative tests that fail on this small snapshot are reported in the log
    failing = [k for k, r in log.items() if k.startswith("test ")]
    assert failing == ["test stg_teams.area_name not_null"]       # club C has no area
    st = spark.read.parquet(os.path.join(gold_root, "standings", "snapshot_date=2024-09-08"))
    top = st.orderBy("position").first()
    assert top["team_name"] == "Real Madrid CF" and top["points"] == 3 and top["played"] == 2
    sm = spark.read.parquet(os.path.join(silver_root, "matches"))
    assert {r["source_blob"] for r in sm.collect()} == {"matches/2024-09-08_matches_season_2024.json"}
    sc = spark.read.parquet(os.path.join(gold_root, "top_scorers", "snapshot_date=2024-09-08"))
    assert sc.filter(F.col("player_id") == 1).first()["team_country"] == "Spain"


def test_silver_job_blocks_bad_snapshot(spark, bronze_root, tmp_path):  # noqa: F811
    silver_root = str(tmp_path / "silver")
    try:
        jobs.silver_job(spark, "matches", bronze_root, silver_root, "2024-09-05", per_season=True)
    except q.QualityGateError as e:
        assert "no_nulls_match_date" in str(e)
    else:
        raise AssertionError("the 2023 snapshot has a null date and must be blocked")
    assert not os.path.exists(silver_root)


def test_command_line(spark, bronze_root, tmp_path, capsys):  # noqa: F811
    from medallion.__main__ import main
    silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
    for entity in ("matches", "teams", "players"):
        assert main(["silver", "--entity", entity, "--bronze", bronze_root, "--silver", silver,
                     "--date", "2024-09-08"]) == 0
    assert main(["gold", "--silver", silver, "--gold", gold, "--date", "2024-09-08"]) == 0
    assert '"item": "standings"' in capsys.readouterr().out


def _write_docs(folder, name_fmt, array_field, df, key):
    """Test helper: one pretty-printed document per key value (small data)."""
    import json
    os.makedirs(folder, exist_ok=True)
    groups = {}
    for row in df.toJSON().collect():
        rec = json.loads(row)
        groups.setdefault(key(rec), []).append(rec)
    for k, recs in groups.items():
        with open(os.path.join(folder, name_fmt.format(k)), "w") as f:
            json.dump({array_field: recs, "_ingestion_metadata": {"source": "fixture"}}, f, indent=2)


def test_fixture_documents_to_gold_match_direct_marts(spark, sf_small, tmp_path):
    from medallion.plans import gold
    from medallion.sources import fixtures as fx
    bronze, silver, goldp = str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "g")
    m = fx.matches(spark, sf_small)
    _write_docs(os.path.join(bronze, "matches"), "2024-09-08_matches_season_{}.json", "matches",
                fx.bronze_match_records(m), lambda r: r["season"]["id"])
    _write_docs(os.path.join(bronze, "teams"), "2024-09-08_teams_season_{}.json", "teams",
                fx.bronze_team_records(fx.teams(spark, sf_small)), lambda r: 2024)
    _write_docs(os.path.join(bronze, "players"), "2024-09-08_scorers_season_{}.json", "scorers",
                fx.bronze_scorer_records(fx.players(spark, sf_small)), lambda r: 2024)
    jobs.silver_job(spark, "matches", bronze, silver, "2024-09-08", per_season=True)
    jobs.silver_job(spark, "teams", bronze, silver, "2024-09-08")
    jobs.silver_job(spark, "players", bronze, silver, "2024-09-08")
    jobs.gold_job(spark, silver, goldp, "2024-09-08")
    cols = ["team_id", "team_name", "played", "won", "drawn", "lost", "goals_for",
            "goals_against", "points", "position", "win_pct", "points_per_game"]
    via_files = spark.read.parquet(os.path.join(goldp, "standings", "snapshot_date=2024-09-08"))
    direct = gold.standings(m).withColumn("team_id", F.col("team_id").cast("int"))
    a = sorted(tuple(r) for r in via_files.select(*cols).collect())
    b = sorted(tuple(r) for r in direct.select(*cols).collect())
    assert a == b and len(a) > 0
    form = spark.read.parquet(os.path.join(goldp, "team_form", "snapshot_date=2024-09-08"))
    assert form.count() == gold.team_form(m).count()


def test_ingested_records_to_silver(spark, sf_small, tmp_path):
    # Closed loop: bronze_ingest (record layout, two snapshots) -> silver_job
    # reads the newest snapshot -> same Silver rows as the direct flattening.
    from medallion.plans import ingest
    from medallion.plans.silver import silver_matches
    from medallion.sources import fixtures as fx
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    recs = fx.bronze_match_records(fx.matches(spark, sf_small))
    ingest.bronze_ingest(spark, recs.limit(10), os.path.join(bronze, "matches"), "2024-09-01", 2024, "t")
    ingest.bronze_ingest(spark, recs, os.path.join(bronze, "matches"), "2024-09-08", 2024, "t")
    jobs.silver_job(spark, "matches", bronze, silver, "2024-09-08", layout="records")
    got = spark.read.parquet(os.path.join(silver, "matches"))
    want = silver_matches(recs)
    cols = ["match_id", "match_date", "status", "home_team_id", "home_result", "total_goals",
            "referee_name", "group_name"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == \
        sorted(tuple(r) for r in want.select(*cols).collect())
    assert {r["source_blob"] for r in got.select("source_blob").distinct().collect()} == \
        {"matches/snapshot_date=2024-09-08"}


def test_jobs_drop_their_scratch_tables(spark, bronze_root, tmp_path):  # noqa: F811
    from medallion.session import scratch_tables_dir
    base = scratch_tables_dir(spark).replace("file:", "")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
    for entity in ("matches", "teams", "players"):     # players ranks through a scratch table
        jobs.silver_job(spark, entity, bronze_root, silver, "2024-09-08")
    jobs.gold_job(spark, silver, gold, "2024-09-08")    # standings ranks through one too
    after = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert after <= before


def test_command_line_stream_and_seasons(spark, bronze_root, tmp_path, capsys):  # noqa: F811
    import json as _json
    from medallion.__main__ import main
    assert main(["stream", "--entity", "teams", "--bronze", os.path.join(bronze_root, "teams"),
                 "--silver", str(tmp_path / "st"), "--checkpoint", str(tmp_path / "ck")]) == 0
    assert spark.read.parquet(str(tmp_path / "st")).count() == 3
    idx = tmp_path / "competitions.json"
    idx.write_text(_json.dumps([{"competition_id": 16, "season_id": 4, "season_name": "s4"}]))
    os.makedirs(tmp_path / "m" / "16")
    (tmp_path / "m" / "16" / "4.json").write_text(_json.dumps([{"a": 1}, {"a": 2}]))
    capsys.readouterr()
    assert main(["seasons", "--index", str(idx), "--matches", str(tmp_path / "m"),
                 "--competition", "16", "--target", str(tmp_path / "t")]) == 0
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == [{"item": "s4", "rows": 2, "ok": True}]
