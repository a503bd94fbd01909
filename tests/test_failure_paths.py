"""Failure paths: every FAIL check blocks the Silver write and
leaves no output; every WARN check lets it through and is recorded."""

import datetime as dt
import os

import pytest

from medallion.plans import quality as q
from medallion.sources import layers

MATCH_SCHEMA = ("match_id int, match_date date, home_team_name string, away_team_name string, "
                "status string, is_finished boolean, home_score_ft int, away_score_ft int, "
                "home_result string")
TEAM_SCHEMA = "team_id int, team_name string, area_name string, team_tla string"
PLAYER_SCHEMA = "player_id int, goals int, scorer_rank int"


def match_rows():
    d = dt.date(2024, 9, 17)
    return [dict(match_id=1, match_date=d, home_team_name="A", away_team_name="B",
                 status="FINISHED", is_finished=True, home_score_ft=1, away_score_ft=0,
                 home_result="W"),
            dict(match_id=2, match_date=d, home_team_name="B", away_team_name="A",
                 status="SCHEDULED", is_finished=False, home_score_ft=None, away_score_ft=None,
                 home_result=None)]


def team_rows():
    return [dict(team_id=i, team_name=f"T{i}", area_name="X", team_tla="ABC") for i in range(32)]


def player_rows():
    return [dict(player_id=1, goals=3, scorer_rank=1), dict(player_id=2, goals=1, scorer_rank=2)]


def set_(i, **kw):
    def f(rows):
        rows[i].update(kw)
        return rows
    return f


CASES = {
    "matches": (MATCH_SCHEMA, match_rows, q.MATCH_CHECKS, {
        "row_count_gt_zero": lambda r: [],
        "no_nulls_match_id": set_(0, match_id=None),
        "no_nulls_match_date": set_(1, match_date=None),
        "no_nulls_home_team_name": set_(0, home_team_name=None),
        "no_nulls_away_team_name": set_(1, away_team_name=None),
        "match_id_unique": set_(1, match_id=1),
        "status_values_known": set_(1, status="WEIRD"),
        "finished_matches_have_scores": set_(0, away_score_ft=None),
        "finished_has_winner": set_(0, home_result=None),
    }),
    "teams": (TEAM_SCHEMA, team_rows, q.TEAM_CHECKS, {
        "row_count_gte_32": lambda r: r[:5],
        "team_id_not_null": set_(3, team_id=None),
        "team_id_unique": set_(3, team_id=4),
        "team_name_not_null": set_(3, team_name=None),
        "area_name_not_null": set_(3, area_name=None),
        "tla_length_3": set_(3, team_tla="ABCD"),
    }),
    "players": (PLAYER_SCHEMA, player_rows, q.PLAYER_CHECKS, {
        "row_count_gt_zero": lambda r: [],
        "player_id_not_null": set_(1, player_id=None),
        "player_id_unique": set_(1, player_id=1),
        "goals_non_negative": set_(1, goals=-1),
        "scorer_rank_starts_at_1": set_(0, scorer_rank=3),
    }),
}

PARAMS = [(table, check) for table, (_, _, _, muts) in CASES.items() for check in muts]


def test_every_check_has_a_case():
    for table, (_, _, checks, muts) in CASES.items():
        assert {c.name for c in checks if c.severity != q.INFO and c.kind != "none_rejected"} == set(muts)


@pytest.mark.parametrize("table,check", PARAMS)
def test_check_blocks_or_warns(spark, tmp_path, table, check):
    schema, base, checks, muts = CASES[table]
    clean = spark.createDataFrame(base(), schema)
    assert all(r["passed"] for r in q.check_results(clean, table, checks).collect())
    bad = spark.createDataFrame(muts[check](base()), schema)
    severity = {c.name: c.severity for c in checks}[check]
    root = str(tmp_path / "silver")
    if severity == q.FAIL:
        with pytest.raises(q.QualityGateError, match=check):
            layers.write_silver(bad, root, table, "2024-09-17", checks)
        assert not os.path.exists(os.path.join(root, table))
    else:
        rows = {r["check"]: r for r in layers.write_silver(bad, root, table, "2024-09-17", checks)}
        assert rows[check]["passed"] is False and rows[check]["severity"] == q.WARN
        assert spark.read.parquet(os.path.join(root, table)).count() == bad.count()


def test_with_severity_turns_a_warning_into_a_block(spark, tmp_path):
    bad = spark.createDataFrame(set_(1, status="WEIRD")(match_rows()), MATCH_SCHEMA)
    strict = q.with_severity(q.MATCH_CHECKS, status_values_known=q.FAIL)
    with pytest.raises(q.QualityGateError, match="status_values_known"):
        layers.write_silver(bad, str(tmp_path / "s"), "matches", "2024-09-17", strict)
    with pytest.raises(ValueError):
        q.with_severity(q.MATCH_CHECKS, no_such_check=q.FAIL)
