"""Dashboard queries (D1-D6) over the Gold marts."""

from __future__ import annotations

from ..plans import dashboards as d
from ..plans import gold
from ..sources import fixtures as fx
from . import register
from .gold_q import (FORM_LABEL, M, MTP, PLAYERS_SQL, RECENT_SQL, SEASON_SQL, players_silver)


def totals(spark, sf):
    """Season totals per team; the dashboards below need no position, so
    the global rank is not computed for them."""
    return gold.standings_totals(fx.matches(spark, sf))


@register("season_goals", f"""
with {M}, {SEASON_SQL}
select cast(coalesce(sum(goals_for), 0) as bigint) as total_goals, count(*) as teams
from season""")
def q_season_goals(spark, sf):
    return d.season_goals(totals(spark, sf))


@register("top10_team_goals", f"""
with {M}, {SEASON_SQL}
select team_id, team_name, goals_for, goals_against, points from season
order by goals_for desc, team_id asc nulls last, team_name asc nulls last limit 10""")
def q_top10_team_goals(spark, sf):
    return d.top_teams_by_goals(totals(spark, sf), 10)


@register("form_label_counts", f"""
with {M}, {RECENT_SQL}
select {FORM_LABEL} as form_label, count(*) as teams from recent group by 1""")
def q_form_label_counts(spark, sf):
    return d.form_summary(gold.team_form(fx.matches(spark, sf)))


LEADERS_SQL = f"""
with {MTP}, {PLAYERS_SQL}
select r.scorer_rank, r.player_id, r.player_name, coalesce(t.team_display_name, r.team_name) as team_name,
       r.goals, r.assists
from ranked r left join teams t on t.team_id = r.team_id"""


def unranked(spark, sf):
    return players_silver(spark, sf, None)


@register("top_k_scorers", f"""{LEADERS_SQL}
order by r.goals desc, r.scorer_rank limit 10""")
def q_top_k_scorers(spark, sf):
    return d.top_k(unranked(spark, sf), fx.teams(spark, sf), "goals", 10)


@register("top_k_assists", f"""{LEADERS_SQL}
order by r.assists desc, r.scorer_rank limit 10""")
def q_top_k_assists(spark, sf):
    return d.top_k(unranked(spark, sf), fx.teams(spark, sf), "assists", 10)


@register("player_goal_share", f"""
with {MTP}, {PLAYERS_SQL},
tg as (select team_id, cast(sum(goals) as bigint) as team_goals from ranked group by team_id)
select p.player_id, p.team_id, p.goals, tg.team_goals,
       case when tg.team_goals = 0 then cast(0.0 as double)
            else cast((2000 * cast(p.goals as bigint) + tg.team_goals) // (2 * tg.team_goals) as double) / 10
       end as goal_share_pct
from ranked p join tg on p.team_id is not distinct from tg.team_id""")
def q_player_goal_share(spark, sf):
    return d.player_goal_share(unranked(spark, sf))


@register("teams_first10_by_name", f"""
with {fx.fixture_ctes('teams')}
select team_id, team_display_name, area_name, venue_name from teams
order by team_display_name asc nulls last, team_id asc nulls last limit 10""")
def q_teams_first10(spark, sf):
    t = fx.teams(spark, sf).select("team_id", "team_display_name", "area_name", "venue_name")
    return d.first_by_name(t, "team_display_name", "team_id", 10)
