"""Gold marts on hand-written edge rows (FIXTURES §6) and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medallion.plans import gold
from medallion.sources import fixtures as fx

MATCH_SCHEMA = ("match_id long, match_date date, is_finished boolean, home_team_id long, "
                "home_team_name string, home_team_short string, away_team_id long, "
                "away_team_name string, away_team_short string, home_score_ft int, "
                "away_score_ft int, home_result string")


def d(day):
    return dt.date(2024, 9, day)


def m(mid, day, h, a, hs, as_, res, fin=True, hname=None, aname=None):
    return (mid, d(day) if day else None, fin, h, hname or f"T{h}", f"S{h}", a,
            aname or f"T{a}", f"S{a}", hs, as_, res)


@pytest.fixture
def matches(spark):
    rows = [
        m(1, 1, 1, 2, 2, 0, "W"),
        m(2, 2, 2, 1, 1, 1, "D"),
        m(3, 3, 1, 3, 0, 1, "L"),
        m(4, 4, 3, 2, 3, 3, None),                  # E5: finished, winner missing
        m(5, 5, 1, 2, 4, 1, "W", hname="T1 renamed"),  # E16: rename mid-season
        m(6, 5, 2, 3, 0, 0, "D"),                   # E14: same day as 5, ordered by id
        m(7, None, 3, 1, 1, 2, "L"),                # E15: null date counts as latest
        m(8, 6, None, 2, 1, 0, "W", hname="ghost"),  # E19: null team id
        m(9, 7, 1, 2, None, None, None, fin=False),  # unfinished: ignored
    ]
    return spark.createDataFrame(rows, MATCH_SCHEMA)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_standings_edges(spark, matches):
    st = gold.standings(matches)
    rows = st.collect()
    keyed = {(r["team_id"], r["team_name"]): r for r in rows}
    # The renamed team is two rows (grouped by name as the reference does)
    assert (1, "T1") in keyed and (1, "T1 renamed") in keyed
    # Null team id keeps a row
    assert (None, "ghost") in keyed
    # E5: a finished match without a result counts as played, 0 W/D/L, 0 points
    t3 = keyed[(3, "T3")]
    # team 3 plays matches 3, 4, 6 and 7; match 4 has no result
    assert t3["played"] == 4 and t3["won"] + t3["drawn"] + t3["lost"] == 3
    assert t3["points"] == 4
    assert sorted(r["position"] for r in rows) == list(range(1, len(rows) + 1))
    by_id = {r["team_id"]: r for r in gold.standings(matches, by_id=True).collect()}
    # by id: one row, named from the latest match; the null-dated match 7
    # counts as latest (E15), so the name there wins over match 5's rename
    assert by_id[1]["team_name"] == "T1" and by_id[1]["played"] == 5
    no_null_date = matches.filter("match_id <> 7")
    by_id = {r["team_id"]: r for r in gold.standings(no_null_date, by_id=True).collect()}
    assert by_id[1]["team_name"] == "T1 renamed" and by_id[1]["played"] == 4


def test_team_form_edges(spark, matches):
    tf = by(gold.team_form(matches), "team_id")
    assert None not in tf                                      # E19
    # Team 1's latest match is the null-dated one (match 7)
    assert tf[1]["last_match_date"] is None
    assert tf[1]["team_name"] == "T1"                          # name on match 7
    # Team 3 has 4 finished matches, the last-5 sums cover all 4:
    # match 3 (away win, 3), 4 (home, no result, 0), 6 (draw, 1), 7 (home loss, 0)
    t3 = tf[3]
    assert t3["matches_played"] == 4
    assert t3["points_last_5"] == t3["total_points"] == 4
    # E5 in form: away side of match 4 reads 'D' but earns 0 points
    roll = gold.rolling_form(matches).filter("match_id = 4").collect()
    res = {r["team_id"]: (r["result"], r["points_earned"]) for r in roll}
    assert res == {3: (None, 0), 2: ("D", 0)}


def test_rolling_form_distributed_equals_window(spark, matches):
    from .plain import rolling_form_window
    a = gold.rolling_form(matches).collect()
    b = rolling_form_window(matches).collect()
    key = lambda r: (r["team_id"] is None, r["team_id"] or 0, r["match_id"])
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert sorted(a, key=key)[0]["match_number"] == 1
    # Team 2 plays matches 5 and 6 on the same day; the lower id comes first
    t2 = {r["match_id"]: r["match_number"] for r in a if r["team_id"] == 2}
    assert t2[5] + 1 == t2[6]


def test_top_scorers_edges(spark):
    players = spark.createDataFrame(
        [(1, 1, "A", 10, None, 2, 8), (2, 2, "B", 0, 3, 0, 0), (3, 3, "C", None, 1, 2, -2)],
        "scorer_rank int, player_id int, player_name string, goals int, assists int, "
        "penalties int, non_penalty_goals int").select(
        "*", F.lit(None).cast("string").alias("nationality"), F.lit(None).cast("string").alias("position"),
        F.lit(None).cast("date").alias("player_dob"), F.lit(7).alias("team_id"),
        F.lit("Fallback").alias("team_name"), F.lit(None).cast("string").alias("team_tla"),
        F.lit(None).cast("string").alias("silver_processed_at"))
    teams = spark.createDataFrame([(8, "Club 8", "Spain", "Venue")],
                                  "team_id int, team_display_name string, area_name string, venue_name string")
    out = by(gold.top_scorers(players, teams), "player_id")
    assert out[1]["penalty_pct_of_goals"] == 20.0
    assert out[2]["penalty_pct_of_goals"] == 0.0               # E17
    assert out[3]["goals"] == 0 and out[3]["penalty_pct_of_goals"] == 0.0  # E10
    assert out[1]["team_name"] == "Fallback" and out[1]["team_country"] is None  # E18
    assert out[1]["goal_involvement"] == 10


def test_standings_invariants_on_fixture(spark, sf_small):
    st = gold.standings(fx.matches(spark, sf_small)).collect()
    assert sum(r["goals_for"] for r in st) == sum(r["goals_against"] for r in st)
    assert sum(r["goal_difference"] for r in st) == 0
    assert sum(r["won"] for r in st) == sum(r["lost"] for r in st)
    assert sum(r["drawn"] for r in st) % 2 == 0
    assert all(r["played"] == r["won"] + r["drawn"] + r["lost"] for r in st)
    assert sorted(r["position"] for r in st) == list(range(1, len(st) + 1))
    ordered = sorted(st, key=lambda r: r["position"])
    keys = [(-r["points"], -r["goal_difference"], -r["goals_for"]) for r in ordered]
    assert keys == sorted(keys)


def test_form_invariants_on_fixture(spark, sf_small):
    tf = gold.team_form(fx.matches(spark, sf_small)).collect()
    assert tf
    for r in tf:
        assert r["points_last_5"] <= r["total_points"]
        assert r["gd_last_5"] == r["goals_scored_last_5"] - r["goals_conceded_last_5"]


def test_team_form_plan_has_one_window_exchange(spark, sf_small):
    df = gold.team_form(fx.matches(spark, sf_small))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    # no self-join on the match number: the only join is last-n with totals
    assert "match_number" not in plan


def test_standings_scans_matches_once(spark, sf_small, tmp_path):
    # C1 plan check: the two-sided expansion reads the fact table once
    # (the reference's UNION ALL reads it twice).
    path = str(tmp_path / "matches")
    fx.matches(spark, sf_small).write.parquet(path)
    rows = gold.standings_records(spark.read.parquet(path))
    agg = rows.groupBy("team_id").agg(F.sum("points_earned"))
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Generate inline" in plan
    assert "PushedFilters: [IsNotNull(is_finished), EqualTo(is_finished,true)]" in plan


def test_team_form_exchanges(spark, sf_small, tmp_path):
    # C2 plan check on a Parquet match table: two hash exchanges on team_id
    # (partially limited window, partial aggregate) and nothing else.
    path = str(tmp_path / "m")
    fx.matches(spark, sf_small).write.parquet(path)
    df = gold.team_form(spark.read.parquet(path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [ln.strip() for ln in plan.split("\n") if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 2 and all("team_id" in e for e in exchanges), exchanges
    assert plan.count("FileScan parquet") == 2        # one scan per branch, column-pruned


def test_hot_team_on_fixture(spark, sf_small):
    # One team forced into a third of all matches (home side of every third
    # match): results equal the plain per-team window.
    m = fx.matches(spark, sf_small)
    hot = (m.withColumn("home_team_id", F.when(F.col("match_id") % 3 == 0, F.lit(-1))
                        .otherwise(F.col("home_team_id")))
            .withColumn("home_team_name", F.when(F.col("match_id") % 3 == 0, F.lit("Hot"))
                        .otherwise(F.col("home_team_name"))))
    cols = ["team_id", "match_id", "match_number", "points_last_5", "goals_scored_last_5",
            "goals_conceded_last_5", "cumulative_points", "cumulative_played"]
    from .plain import rolling_form_window
    auto = gold.rolling_form(hot)
    plain = rolling_form_window(hot)
    a = sorted(tuple(r) for r in auto.select(*cols).collect())
    b = sorted(tuple(r) for r in plain.select(*cols).collect())
    assert a == b and any(r[0] == -1 for r in a)
    form = {r["team_id"]: r for r in gold.team_form(hot).collect()}
    hot_rows = sorted((r for r in b if r[0] == -1), key=lambda r: r[2])
    assert form[-1]["points_last_5"] == hot_rows[-1][3]
    assert form[-1]["matches_played"] == hot_rows[-1][7]
