"""Gold marts (C1-C4) over Silver-shaped inputs.

Each function takes DataFrames with the Silver column names (only the columns
it reads need to exist) and returns a DataFrame.  The
marts with a global rank or a running sum write one intermediate table while
they are built (see ``operators.ranking``); the others are lazy.  Plans:

* ``standings``: one scan, two-sided expansion in the scan's codegen stage,
  one partial+final hash aggregate (hot teams are combined map-side), then the
  distributed global rank.
* ``team_form``: last n rows per team via a partially limited window (at most
  n rows per team leave each map task) plus a partial aggregate for season
  totals; both sides are hash partitioned on ``team_id``, so they join
  without another exchange.  The reference's self-join is not needed.
* ``rolling_form``: per-match history with running and last-n sums by
  the skew-safe segmented scan ``running_stats``.
* ``top_scorers``: left join of the player facts to the team dimension.  The
  dimension is not assumed small: the planner broadcasts it when its size is
  under the threshold (AQE re-checks with runtime sizes) and otherwise uses
  a sort-merge join, whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (exact_round_ratio, flip_result, form_label, indicator, nz,
                                 points_for)
from ..operators.ranking import rank_by
from ..operators.sequence import last_n_per_group, running_stats
from ..operators.two_sided import two_sided


def finished(matches: DataFrame) -> DataFrame:
    """keep finished matches (``is_finished = true``; pushed to the scan)."""
    return matches.filter(F.col("is_finished") == F.lit(True))


def standings_records(matches: DataFrame) -> DataFrame:
    """U1 + P17-P20: one row per team and finished match."""
    hr = F.col("home_result")
    home = {
        "team_id": F.col("home_team_id"), "team_name": F.col("home_team_name"),
        "team_short": F.col("home_team_short"), "match_date": F.col("match_date"),
        "match_id": F.col("match_id"), "played": F.lit(1),
        "won": indicator(hr == "W"), "drawn": indicator(hr == "D"), "lost": indicator(hr == "L"),
        "goals_for": nz("home_score_ft"), "goals_against": nz("away_score_ft"),
        "points_earned": points_for(hr),
    }
    away = {
        "team_id": F.col("away_team_id"), "team_name": F.col("away_team_name"),
        "team_short": F.col("away_team_short"), "match_date": F.col("match_date"),
        "match_id": F.col("match_id"), "played": F.lit(1),
        "won": indicator(hr == "L"), "drawn": indicator(hr == "D"), "lost": indicator(hr == "W"),
        "goals_for": nz("away_score_ft"), "goals_against": nz("home_score_ft"),
        # Not points_for(flip_result(..)): a missing result is worth 0 here.
        "points_earned": F.when(hr == "L", 3).when(hr == "D", 1).otherwise(0),
    }
    return two_sided(finished(matches), [home, away])


def _latest(col: str):
    """Value on the team's latest row; a null date counts as the latest."""
    return F.max_by(col, F.struct(F.col("match_date").isNull(), "match_date", "match_id"))


def standings_totals(matches: DataFrame, by_id: bool = False) -> DataFrame:
    """A1: season totals per team (no position).  ``by_id=True`` groups by
    team id only and reports the latest name (R12); the default groups by id,
    name and short name as the reference does."""
    rows = standings_records(matches)
    sums = [F.sum(c).cast("long").alias(c) for c in ("played", "won", "drawn", "lost",
                                                     "goals_for", "goals_against")]
    extra = [(F.sum("goals_for") - F.sum("goals_against")).cast("long").alias("goal_difference"),
             F.sum("points_earned").cast("long").alias("points")]
    if by_id:
        totals = rows.groupBy("team_id").agg(
            _latest("team_name").alias("team_name"), _latest("team_short").alias("team_short"),
            *sums, *extra)
    else:
        totals = rows.groupBy("team_id", "team_name", "team_short").agg(*sums, *extra)
    return totals


def standings(matches: DataFrame, by_id: bool = False, rank_method: str = "row_number",
              sort: bool = False) -> DataFrame:
    """C1 league table: season totals, ratios and the global position."""
    totals = standings_totals(matches, by_id)
    order = [F.col("points").desc(), F.col("goal_difference").desc(), F.col("goals_for").desc(),
             F.col("team_id").asc_nulls_last(), F.col("team_name").asc_nulls_last(),
             F.col("team_short").asc_nulls_last()]
    keys = ["points", "goal_difference", "goals_for"]
    ranked = rank_by(totals, order if rank_method == "row_number" else order[:3], "position",
                     method=rank_method, keys=keys)
    out = ranked.select(
        "position", "team_id", "team_name", "team_short", "played", "won", "drawn", "lost",
        "goals_for", "goals_against", "goal_difference", "points",
        exact_round_ratio("won", "played", 1, scale=100).alias("win_pct"),
        exact_round_ratio("points", "played", 2).alias("points_per_game"),
        F.current_timestamp().alias("gold_created_at"))
    return out.orderBy("position") if sort else out


def form_records(matches: DataFrame) -> DataFrame:
    """One row per team and finished match with the form mart's rules."""
    hr = F.col("home_result")
    home = {
        "team_id": F.col("home_team_id"), "team_name": F.col("home_team_name"),
        "match_date": F.col("match_date"), "match_id": F.col("match_id"), "result": hr,
        "goals_scored": nz("home_score_ft"), "goals_conceded": nz("away_score_ft"),
        "points_earned": points_for(hr),
    }
    away = {
        "team_id": F.col("away_team_id"), "team_name": F.col("away_team_name"),
        "match_date": F.col("match_date"), "match_id": F.col("match_id"),
        # R6 preserved: a finished match without a result reads 'D' for the
        # away side yet earns 0 points.
        "result": flip_result(hr),
        "goals_scored": nz("away_score_ft"), "goals_conceded": nz("home_score_ft"),
        "points_earned": F.when(hr == "L", 3).when(hr == "D", 1).otherwise(0),
    }
    return two_sided(finished(matches), [home, away])


# O1-O3: the order of each exported mart (``-``: descending).
EXPORT_ORDERS = {"standings": ("position",), "team_form": ("-points_last_5", "-gd_last_5", "team_id"),
                 "top_scorers": ("scorer_rank",)}


def in_export_order(df: DataFrame, mart: str) -> DataFrame:
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in EXPORT_ORDERS[mart]])


# Chronological order of a team's matches; DuckDB sorts NULLS LAST ascending.
def chrono():
    return [F.col("match_date").asc_nulls_last(), F.col("match_id").asc_nulls_last()]


def latest_first():
    return [F.col("match_date").desc_nulls_first(), F.col("match_id").desc_nulls_first()]


def team_form(matches: DataFrame, n: int = 5, good: int = 10, average: int = 5,
              sort: bool = False) -> DataFrame:
    """One row per team: latest match, season totals, last-n sums, label.
    The output keeps the contractual ``*_last_5`` column names for any ``n``."""
    rows = form_records(matches).filter(F.col("team_id").isNotNull())
    recent = last_n_per_group(rows, ["team_id"], latest_first(), n, "_rd")
    last = recent.groupBy("team_id").agg(
        F.min_by("team_name", "_rd").alias("team_name"),
        F.min_by("match_date", "_rd").alias("last_match_date"),
        F.sum("points_earned").cast("long").alias("points_last_5"),
        F.sum("goals_scored").cast("long").alias("goals_scored_last_5"),
        F.sum("goals_conceded").cast("long").alias("goals_conceded_last_5"))
    totals = rows.groupBy("team_id").agg(
        F.count("match_id").alias("matches_played"),
        F.sum("points_earned").cast("long").alias("total_points"))
    out = last.join(totals, "team_id").select(
        "team_id", "team_name", "last_match_date", "matches_played", "total_points",
        "points_last_5", "goals_scored_last_5", "goals_conceded_last_5",
        (F.col("goals_scored_last_5") - F.col("goals_conceded_last_5")).alias("gd_last_5"),
        form_label("points_last_5", good, average).alias("form_label"),
        F.current_timestamp().alias("gold_created_at"))
    if sort:
        out = out.orderBy(F.col("points_last_5").desc(), F.col("gd_last_5").desc(), "team_id")
    return out


def rolling_form(matches: DataFrame, n: int = 5) -> DataFrame:
    """Every team-match row with its match number, last-n and running sums,
    by the segmented scan at every size (building it writes the ranged rows).
    The output keeps the contractual ``*_last_5`` column names for any ``n``."""
    rows = form_records(matches)
    values = {"points": F.col("points_earned"), "scored": F.col("goals_scored"),
              "conceded": F.col("goals_conceded"),
              "played": indicator(F.col("match_id").isNotNull())}
    seq = running_stats(rows, ["team_id"], chrono(), values, n, rn_name="match_number")
    return seq.select(
        "team_id", "team_name", "match_date", "match_id",
        F.col("match_number").cast("long").alias("match_number"), "result",
        "goals_scored", "goals_conceded", "points_earned",
        F.col("last_n_points").cast("long").alias("points_last_5"),
        F.col("last_n_scored").cast("long").alias("goals_scored_last_5"),
        F.col("last_n_conceded").cast("long").alias("goals_conceded_last_5"),
        F.col("cum_points").cast("long").alias("cumulative_points"),
        F.col("cum_played").cast("long").alias("cumulative_played"))


def top_scorers(players: DataFrame, teams: DataFrame, sort: bool = False) -> DataFrame:
    """C4: scorer leaderboard enriched by the team dimension."""
    t = teams.select(F.col("team_id").alias("_t_team_id"), "team_display_name",
                     F.col("area_name").alias("team_country"),
                     F.col("venue_name").alias("team_stadium"))
    p = players.alias("p")
    goals, pens = nz("p.goals"), nz("p.penalties")
    out = p.join(t, F.col("p.team_id") == F.col("_t_team_id"), "left").select(
        "p.scorer_rank", "p.player_id", "p.player_name", "p.nationality", "p.position",
        "p.player_dob", "p.team_id",
        F.coalesce("team_display_name", "p.team_name").alias("team_name"),
        "team_country", "team_stadium", "p.team_tla",
        goals.alias("goals"), nz("p.assists").alias("assists"),
        pens.alias("penalties_scored"), nz("p.non_penalty_goals").alias("non_penalty_goals"),
        (goals + nz("p.assists")).alias("goal_involvement"),
        F.when(goals == 0, F.lit(0.0))
         .otherwise(exact_round_ratio(pens, goals, 1, scale=100)).alias("penalty_pct_of_goals"),
        "p.silver_processed_at", F.current_timestamp().alias("gold_created_at"))
    return out.orderBy("scorer_rank") if sort else out
