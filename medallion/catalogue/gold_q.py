"""Gold-mart queries: C1-C4, U1/U2, W1-W9, P11-P13, P17-P26, R12."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import gold
from ..plans.silver import conform, players_derived, silver_matches
from ..schemas import SILVER_PLAYERS
from ..sources import fixtures as fx
from . import register

M = fx.fixture_ctes("matches")
MTP = fx.fixture_ctes("matches", "teams", "players")

# --------------------------------------------------------------------------
# SQL building blocks, from the definitions: a match is two rows, one per side,
# and a side's outcome is 1, 0 or -1 (null when the match has no result).
# --------------------------------------------------------------------------
SIDES_SQL = """
sides as (
  select m.match_date, m.match_id, m.home_result, s.at_home,
         if(s.at_home, m.home_team_id, m.away_team_id) as team_id,
         if(s.at_home, m.home_team_name, m.away_team_name) as team_name,
         if(s.at_home, m.home_team_short, m.away_team_short) as team_short,
         coalesce(if(s.at_home, m.home_score_ft, m.away_score_ft), 0) as scored,
         coalesce(if(s.at_home, m.away_score_ft, m.home_score_ft), 0) as conceded,
         if(m.home_result = 'D', 0, if((m.home_result = 'W') = s.at_home, 1, -1)) as raw_outcome
  from matches m cross join (values (true), (false)) as s(at_home)
  where m.is_finished),
played as (
  select *, if(home_result is null, null, raw_outcome) as outcome,
         row_number() over (partition by team_id
                            order by match_date desc nulls first, match_id desc nulls first) as back
  from sides)
"""

TOTALS_COLS = """
         count(*) as played,
         count(*) filter (where outcome = 1) as won, count(*) filter (where outcome = 0) as drawn,
         count(*) filter (where outcome = -1) as lost,
         cast(sum(scored) as bigint) as goals_for, cast(sum(conceded) as bigint) as goals_against,
         cast(sum(scored - conceded) as bigint) as goal_difference,
         3 * count(*) filter (where outcome = 1) + count(*) filter (where outcome = 0) as points"""

RATIO_COLS = """
       cast((2000 * won + played) // (2 * played) as double) / 10 as win_pct,
       cast((200 * points + played) // (2 * played) as double) / 100 as points_per_game"""

SEASON_SQL = f"""{SIDES_SQL},
season as (select team_id, team_name, team_short, {TOTALS_COLS}
           from played group by team_id, team_name, team_short)
"""

LEAGUE_ORDER = "points desc, goal_difference desc, goals_for desc"
TEAM_ORDER = "team_id asc nulls last, team_name asc nulls last, team_short asc nulls last"

# The sequence of a team's matches counts from its first; a finished match
# without a result reads 'D' for the away side and nothing for the home side.
FORM_SQL = f"""{SIDES_SQL},
history as (
  select team_id, team_name, match_date, match_id, scored, conceded, back, outcome,
         if(at_home, home_result, case outcome when 1 then 'W' when -1 then 'L' else 'D' end) as result,
         case outcome when 1 then 3 when 0 then 1 else 0 end as earned,
         row_number() over (partition by team_id
                            order by match_date asc nulls last, match_id asc nulls last) as match_number
  from played)
"""

RECENT_SQL = f"""{FORM_SQL},
recent as (
  select team_id, max(team_name) filter (where back = 1) as team_name,
         max(match_date) filter (where back = 1) as last_match_date,
         count(match_id) as matches_played, cast(sum(earned) as bigint) as total_points,
         cast(sum(earned) filter (where back <= 5) as bigint) as points_last_5,
         cast(sum(scored) filter (where back <= 5) as bigint) as goals_scored_last_5,
         cast(sum(conceded) filter (where back <= 5) as bigint) as goals_conceded_last_5
  from history where team_id is not null group by team_id)
"""

# The labels and their limits.
FORM_LABEL = "case when points_last_5 >= 10 then 'Good' when points_last_5 >= 5 then 'Average' else 'Poor' end"

# Players with missing counts as zero, and their place among all players.
PLAYERS_SQL = """
counted as (
  select player_id, player_name, nationality, position, team_id, team_name,
         coalesce(goals, 0) as goals, coalesce(assists, 0) as assists, coalesce(penalties, 0) as penalties
  from players),
ranked as (
  select *, goals - penalties as non_penalty_goals,
         row_number() over (order by goals desc, assists desc, player_id asc nulls last) as scorer_rank
  from counted)
"""


def matches(spark, sf):
    return fx.matches(spark, sf)


# --------------------------------------------------------------------------
# C1 standings, R12 by id, U1 records
# --------------------------------------------------------------------------
@register("standings", f"""
with {M}, {SEASON_SQL}
select row_number() over (order by {LEAGUE_ORDER}, {TEAM_ORDER}) as position, *, {RATIO_COLS} from season""")
def q_standings(spark, sf):
    return gold.standings(matches(spark, sf)).drop("gold_created_at")


@register("standings_by_id", f"""
with {M}, {SIDES_SQL},
season as (select team_id, max(team_name) filter (where back = 1) as team_name,
                  max(team_short) filter (where back = 1) as team_short, {TOTALS_COLS}
           from played group by team_id)
select row_number() over (order by {LEAGUE_ORDER}, {TEAM_ORDER}) as position, *, {RATIO_COLS} from season""")
def q_standings_by_id(spark, sf):
    return gold.standings(matches(spark, sf), by_id=True).drop("gold_created_at")


@register("standings_dense_rank", f"""
with {M}, {SEASON_SQL}
select dense_rank() over (order by {LEAGUE_ORDER}) as position, *, {RATIO_COLS} from season""")
def q_standings_dense(spark, sf):
    return gold.standings(matches(spark, sf), rank_method="dense_rank").drop("gold_created_at")


@register("two_sided_records", f"""
with {M}, {SIDES_SQL}
select team_id, team_name, team_short, match_date, match_id, 1 as played,
       if(outcome = 1, 1, 0) as won, if(outcome = 0, 1, 0) as drawn, if(outcome = -1, 1, 0) as lost,
       scored as goals_for, conceded as goals_against,
       case outcome when 1 then 3 when 0 then 1 else 0 end as points_earned
from played""")
def q_two_sided(spark, sf):
    return gold.standings_records(matches(spark, sf))


# --------------------------------------------------------------------------
# C2 team form, C3 rolling history
# --------------------------------------------------------------------------
@register("team_form", f"""
with {M}, {RECENT_SQL}
select *, goals_scored_last_5 - goals_conceded_last_5 as gd_last_5, {FORM_LABEL} as form_label from recent""")
def q_team_form(spark, sf):
    return gold.team_form(matches(spark, sf)).drop("gold_created_at")


ROLLING_SQL = f"""
with {M}, {FORM_SQL}
select team_id, team_name, match_date, match_id, match_number, result, scored as goals_scored,
       conceded as goals_conceded, earned as points_earned,
       cast(sum(earned) over five as bigint) as points_last_5,
       cast(sum(scored) over five as bigint) as goals_scored_last_5,
       cast(sum(conceded) over five as bigint) as goals_conceded_last_5,
       cast(sum(earned) over so_far as bigint) as cumulative_points,
       count(match_id) over so_far as cumulative_played
from history
window five as (partition by team_id order by match_number rows between 4 preceding and current row),
       so_far as (partition by team_id order by match_number rows between unbounded preceding and current row)"""


@register("rolling_form", ROLLING_SQL)
def q_rolling_form(spark, sf):
    return gold.rolling_form(matches(spark, sf))


@register("rolling_form_skew_safe", ROLLING_SQL)
def q_rolling_form_skew_safe(spark, sf):
    """C3 with more ranges than teams, so that every team is cut into blocks."""
    from ..operators.sequence import running_stats
    rows = gold.form_records(matches(spark, sf))
    values = {"points": F.col("points_earned"), "scored": F.col("goals_scored"),
              "conceded": F.col("goals_conceded"), "played": F.col("match_id").isNotNull().cast("int")}
    seq = running_stats(rows, ["team_id"], gold.chrono(), values, 5, rn_name="match_number", num_partitions=24)
    long = {"points_last_5": "last_n_points", "goals_scored_last_5": "last_n_scored",
            "goals_conceded_last_5": "last_n_conceded", "cumulative_points": "cum_points",
            "cumulative_played": "cum_played", "match_number": "match_number"}
    return seq.select("team_id", "team_name", "match_date", "match_id", "result", "goals_scored", "goals_conceded",
                      "points_earned", *[F.col(c).cast("long").alias(n) for n, c in long.items()])


# --------------------------------------------------------------------------
# C4 top scorers, W2 / W9 scorer rank
# --------------------------------------------------------------------------
def players_silver(spark, sf, rank_method="row_number"):
    """Players fixture through the Silver derivations, as a staging view with
    the full Silver column list (columns the fixture lacks are typed nulls)."""
    return conform(players_derived(fx.players(spark, sf), rank_method), SILVER_PLAYERS, cast=False)


TOP_SCORERS_COLS = ["scorer_rank", "player_id", "player_name", "nationality", "position",
                    "team_id", "team_name", "team_country", "team_stadium", "goals", "assists",
                    "penalties_scored", "non_penalty_goals", "goal_involvement",
                    "penalty_pct_of_goals"]


@register("top_scorers", f"""
with {MTP}, {PLAYERS_SQL}
select r.scorer_rank, r.player_id, r.player_name, r.nationality, r.position, r.team_id,
       coalesce(t.team_display_name, r.team_name) as team_name,
       t.area_name as team_country, t.venue_name as team_stadium, r.goals, r.assists,
       r.penalties as penalties_scored, r.non_penalty_goals, r.goals + r.assists as goal_involvement,
       if(r.goals = 0, 0, cast((2000 * r.penalties + r.goals) // (2 * nullif(r.goals, 0)) as double) / 10)
         as penalty_pct_of_goals
from ranked r left join teams t using (team_id)""")
def q_top_scorers(spark, sf):
    return gold.top_scorers(players_silver(spark, sf), fx.teams(spark, sf)).select(*TOP_SCORERS_COLS)


@register("scorer_rank_row_number", f"""
with {MTP}, {PLAYERS_SQL}
select player_id, goals, assists, penalties, non_penalty_goals, scorer_rank from ranked""")
def q_scorer_rank(spark, sf):
    return players_silver(spark, sf).select("player_id", "goals", "assists", "penalties",
                                            "non_penalty_goals", "scorer_rank")


@register("scorer_rank_dense", f"""
with {MTP}, {PLAYERS_SQL}
select player_id, goals, assists, dense_rank() over (order by goals desc, assists desc) as scorer_rank
from counted""")
def q_scorer_rank_dense(spark, sf):
    return players_silver(spark, sf, "dense_rank").select("player_id", "goals", "assists",
                                                          "scorer_rank")


# --------------------------------------------------------------------------
# Flags and conditional arithmetic recomputed from status / winner
# --------------------------------------------------------------------------
@register("match_derived_columns", f"""
with {M}
select match_id,
       coalesce(status = 'FINISHED', false) as is_finished,
       cast(case when coalesce(status = 'FINISHED', false)
                 then home_score_ft + away_score_ft end as integer) as total_goals,
       cast(case when coalesce(status = 'FINISHED', false)
                 then home_score_ft - away_score_ft end as integer) as goal_difference,
       case when winner = 'HOME_TEAM' then 'W' when winner = 'AWAY_TEAM' then 'L'
            when winner = 'DRAW' then 'D' end as home_result
from matches""")
def q_match_derived(spark, sf):
    return silver_matches(fx.bronze_match_records(matches(spark, sf))).select(
        "match_id", "is_finished", "total_goals", "goal_difference", "home_result")
