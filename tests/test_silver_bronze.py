"""Bronze documents on disk -> newest snapshot -> Silver, with the edge rows
of FIXTURES §6 (E1-E12, E20, E22) and the quality gate around the write."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from medallion.plans import quality as q
from medallion.plans.silver import silver_matches, silver_players, silver_teams
from medallion.schemas import (BRONZE_MATCHES_DOC, BRONZE_PLAYERS_DOC, BRONZE_TEAMS_DOC,
                               SILVER_MATCHES, SILVER_PLAYERS, SILVER_TEAMS)
from medallion.sources import bronze


def write_doc(folder, name, payload):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(payload, f, indent=2)


def team(i, name, short=None):
    return {"id": i, "name": name, "shortName": short or name[:3]}


def match(i, status="FINISHED", winner="HOME_TEAM", home=2, away=1, **extra):
    m = {"id": i, "utcDate": "2024-09-17T23:45:00Z", "status": status, "matchday": 1,
         "stage": " LEAGUE_STAGE ", "group": "GROUP_A",
         "competition": {"id": 2001, "name": " Continental Cup ", "code": "CL"},
         "season": {"id": 2024}, "homeTeam": team(10, " Real Madrid CF "),
         "awayTeam": team(20, "Arsenal FC"),
         "score": {"winner": winner, "fullTime": {"home": home, "away": away},
                   "halfTime": {"home": 1, "away": 0}},
         "referees": [{"name": " Ref A "}]}
    m.update(extra)
    return m


@pytest.fixture
def bronze_root(tmp_path):
    root = str(tmp_path / "bronze")
    md = os.path.join(root, "matches")
    meta = {"ingested_at": "2024-09-08T10:00:00", "source": "api", "season": 2024}
    write_doc(md, "2024-09-01_matches_season_2024.json",
              {"matches": [match(1, home=0, away=0, winner="DRAW")], "_ingestion_metadata": meta})
    write_doc(md, "2024-09-08_matches_season_2024.json", {"matches": [
        match(1),
        match(2, status="SCHEDULED", score=None, referees=[], group=""),        # E1 E2 E3
        match(3, status=None, group=None, referees=None),                       # E3 E4
        match(4, winner=None, home=1, away=1),                                  # E5
    ], "_ingestion_metadata": meta})
    write_doc(md, "2024-09-05_matches_season_2023.json",
              {"matches": [match(7, utcDate=None)], "_ingestion_metadata": meta})  # E22
    write_doc(md, "notes.txt", {"matches": []})                                 # S9: ignored
    td = os.path.join(root, "teams")
    write_doc(td, "2024-09-08_teams_season_2024.json", {"teams": [
        {"id": 10, "name": " Real Madrid CF ", "shortName": "Real Madrid", "tla": " rma ",
         "founded": 1902, "area": {"id": 2224, "name": "Spain", "code": "esp"},
         "runningCompetitions": [{"id": 2014, "name": "National League A", "code": "PD"},
                                 {"id": 2001, "name": "Continental Cup", "code": "CL"}]},
        {"id": 20, "name": "Arsenal FC", "shortName": "", "tla": "ARS",                # E7
         "area": {"id": 2072, "name": "England", "code": "ENG"},
         "runningCompetitions": [{"id": 2021, "name": "National League B", "code": "PL"}]},  # E6
        {"id": 30, "name": "Club C", "tla": "CLUBC", "runningCompetitions": []},        # E6
    ], "_ingestion_metadata": meta})
    pd_ = os.path.join(root, "players")
    write_doc(pd_, "2024-09-08_top_scorers_season_2024.json", {"scorers": [
        {"player": {"id": 1, "name": " Harry K ", "firstName": "Harry", "dateOfBirth": "1993-07-28",
                    "position": None, "section": None, "shirtNumber": 0},            # E9 E11
         "team": {"id": 10, "name": "Real Madrid CF", "tla": " rma "},
         "goals": 5, "assists": 1, "penalties": 1},
        {"player": {"id": 2, "name": "B", "firstName": "Nobody", "position": "Offence",
                    "shirtNumber": None},                                           # E11
         "team": {"id": 20}, "goals": None, "assists": None, "penalties": 2},        # E10
        {"player": {"id": 3, "name": "C", "firstName": "Kylian", "section": "Midfield",
                    "shirtNumber": 7},
         "team": {"id": 20}, "goals": 5, "assists": 1, "penalties": 0},             # E12
    ], "ingestion_metadata": {"ingested_at": "2024-09-08T11:00:00", "source": "api"}})  # R4
    return root


def test_newest_snapshot_only(spark, bronze_root):
    docs = bronze.read_documents(spark, os.path.join(bronze_root, "matches"), BRONZE_MATCHES_DOC)
    assert docs.count() == 3                                       # notes.txt skipped (S9)
    newest = bronze.latest_documents(docs)
    assert [r["file_name"] for r in newest.collect()] == ["2024-09-08_matches_season_2024.json"]
    per_season = bronze.latest_documents(docs, per_season=True)
    assert sorted(r["season"] for r in per_season.collect()) == [2023, 2024]  # R3
    counts = {r["source_blob"].rsplit("/", 1)[-1]: r["record_count"]
              for r in bronze.record_counts(docs, "matches").collect()}
    assert counts["2024-09-08_matches_season_2024.json"] == 4
    prof = bronze.profile(newest, "matches").collect()[0]
    assert prof["ingested_at"] == "2024-09-08T10:00:00" and prof["record_count"] == 4
    assert '"id":1' in prof["first_record"]


def test_silver_matches_edges(spark, bronze_root):
    docs = bronze.read_documents(spark, os.path.join(bronze_root, "matches"), BRONZE_MATCHES_DOC)
    recs = bronze.records(bronze.latest_documents(docs), "matches")
    s = silver_matches(recs, source=F.col("source_blob"))
    assert s.columns == SILVER_MATCHES.fieldNames()
    got = {r["match_id"]: r for r in s.collect()}
    assert len(got) == 4                                           # E20: newest snapshot only
    m1 = got[1]
    assert m1["match_date"] == dt.date(2024, 9, 17)               # UTC date of ...T23:45Z
    assert m1["home_team_name"] == "Real Madrid CF" and m1["stage"] == "LEAGUE_STAGE"
    assert m1["home_result"] == "W" and m1["total_goals"] == 3 and m1["goal_difference"] == 1
    assert m1["referee_name"] == "Ref A" and m1["group_name"] == "GROUP_A"
    assert m1["source_blob"].endswith("2024-09-08_matches_season_2024.json")
    m2 = got[2]
    assert m2["home_score_ft"] is None and m2["home_result"] is None      # E1
    assert m2["referee_name"] is None and m2["group_name"] == "NA"        # E2 E3
    assert got[3]["is_finished"] is False and got[3]["group_name"] == "NA"  # E4 E3
    assert got[3]["referee_name"] is None
    assert got[4]["home_result"] is None and got[4]["is_finished"]        # E5
    rows = q.quality_gate(s, "matches", q.MATCH_CHECKS)
    warn = {r["check"]: r for r in rows}
    assert warn["finished_has_winner"]["passed"] is False                 # R6 as WARN
    assert warn["date_range"]["value"] == "2024-09-17..2024-09-17"


def test_quality_gate_blocks_null_date(spark, bronze_root, tmp_path):
    path = os.path.join(bronze_root, "matches", "2024-09-05_matches_season_2023.json")
    docs = bronze.read_documents(spark, path, BRONZE_MATCHES_DOC)
    s = silver_matches(bronze.records(docs, "matches"))
    out = str(tmp_path / "silver_matches")
    with pytest.raises(q.QualityGateError, match="no_nulls_match_date"):   # E22
        q.quality_gate(s, "matches", q.MATCH_CHECKS)
        s.write.parquet(out)
    assert not os.path.exists(out)


def test_silver_teams_edges(spark, bronze_root):
    docs = bronze.read_documents(spark, os.path.join(bronze_root, "teams"), BRONZE_TEAMS_DOC)
    s = silver_teams(bronze.records(docs, "teams"))
    assert s.columns == SILVER_TEAMS.fieldNames()
    got = {r["team_id"]: r for r in s.collect()}
    assert got[10]["team_tla"] == "RMA" and got[10]["area_code"] == "ESP"           # E8
    assert got[10]["competition_code"] == "CL" and got[10]["is_ucl_participant"]
    assert got[20]["team_display_name"] == "Arsenal FC"                            # E7
    assert got[20]["competition_code"] == "PL" and not got[20]["is_ucl_participant"]  # E6
    assert got[30]["competition_id"] is None and got[30]["is_ucl_participant"] is False
    rows = {r["check"]: r for r in q.quality_gate(s, "teams", q.TEAM_CHECKS)}
    assert rows["row_count_gte_32"]["passed"] is False and rows["tla_length_3"]["value"] == "1"


def test_silver_players_edges(spark, bronze_root):
    docs = bronze.read_documents(spark, os.path.join(bronze_root, "players"), BRONZE_PLAYERS_DOC)
    meta = docs.select(bronze.metadata(docs)["ingested_at"].alias("a")).collect()[0]["a"]
    assert meta == "2024-09-08T11:00:00"                                            # R4
    s = silver_players(bronze.records(docs, "scorers"))
    assert s.columns == SILVER_PLAYERS.fieldNames()
    got = {r["player_id"]: r for r in s.collect()}
    assert got[1]["position"] == "UNKNOWN" and got[1]["shirt_number"] == 9           # E9 E11
    assert got[1]["player_name"] == "Harry K" and got[1]["team_tla"] == "RMA"
    assert got[1]["player_dob"] == dt.date(1993, 7, 28)
    assert got[2]["goals"] == 0 and got[2]["non_penalty_goals"] == -2               # E10
    assert got[2]["shirt_number"] is None
    assert got[3]["position"] == "OFFENCE" or got[3]["position"] == "MIDFIELD"
    assert (got[1]["scorer_rank"], got[3]["scorer_rank"], got[2]["scorer_rank"]) == (1, 2, 3)  # E12
    rows = {r["check"]: r for r in q.quality_gate(s, "players", q.PLAYER_CHECKS)}
    assert all(r["passed"] for r in rows.values())


def test_silver_write_and_read_back(spark, bronze_root, tmp_path):
    docs = bronze.read_documents(spark, os.path.join(bronze_root, "matches"), BRONZE_MATCHES_DOC)
    keyed = bronze.with_snapshot_keys(bronze.latest_documents(docs))
    recs = bronze.records(keyed, "matches", keep=("source_blob", "snapshot_date"))
    s = silver_matches(recs, source=F.col("source_blob")).withColumn(
        "snapshot_date", F.lit("2024-09-08").cast("date"))
    q.quality_gate(s, "matches", q.MATCH_CHECKS)
    out = str(tmp_path / "silver" / "matches")
    bronze.to_record_layout(s, out, ["snapshot_date"])                             # K3
    back = spark.read.parquet(out)
    assert back.count() == 4                                                        # K6
    assert set(SILVER_MATCHES.fieldNames()) <= set(back.columns)
    assert dict(back.dtypes)["home_score_ft"] == "int"     # ints stay ints (1.4)


def test_competition_index_both_shapes(spark, tmp_path):
    entries = [{"competition_id": 16, "season_id": 4, "season_name": "2018/2019"},
               {"competition_id": 16, "season_id": 1, "season_name": "2017/2018"},
               {"competition_id": 11, "season_id": 90, "season_name": "2020/2021"}]
    write_doc(str(tmp_path / "a"), "competitions.json", {"all_competitions": entries})
    write_doc(str(tmp_path / "b"), "competitions.json", entries)
    for sub in ("a", "b"):
        idx = bronze.read_competition_index(spark, str(tmp_path / sub / "competitions.json"))
        comp = bronze.filter_competition(idx, 16)                                     # B1
        assert sorted(r["season_id"] for r in comp.collect()) == [1, 4]


def test_list_snapshots_without_reading(spark, bronze_root):
    snaps = bronze.list_snapshots(spark, os.path.join(bronze_root, "matches"))
    got = sorted((r["file_name"], str(r["snapshot_date"]), r["season"]) for r in snaps.collect())
    assert got == [("2024-09-01_matches_season_2024.json", "2024-09-01", 2024),
                   ("2024-09-05_matches_season_2023.json", "2024-09-05", 2023),
                   ("2024-09-08_matches_season_2024.json", "2024-09-08", 2024)]
    newest = bronze.latest_snapshot(snaps, "file_name")
    assert [r["file_name"] for r in newest.collect()] == ["2024-09-08_matches_season_2024.json"]
    plan = snaps._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1][:200]
