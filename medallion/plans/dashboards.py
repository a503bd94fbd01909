"""Dashboard roll-ups (D1-D6) over the Gold marts.

Top-k reports use ``orderBy(...).limit(k)`` (TakeOrderedAndProject: each
task keeps its own k best rows; nothing else is shuffled).  The team-share
question uses a grouped sum joined back on the team key instead of a window
partitioned by team, so a team with a huge roster is summed map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact_round_ratio, nz


def season_goals(standings: DataFrame) -> DataFrame:
    """Total goals scored in the season (one row)."""
    return standings.agg(F.coalesce(F.sum("goals_for"), F.lit(0)).cast("long").alias("total_goals"),
                         F.count(F.lit(1)).alias("teams"))


def top_teams_by_goals(standings: DataFrame, k: int = 10) -> DataFrame:
    """D3: the k teams with most goals (ties broken by team id)."""
    return (standings.orderBy(F.col("goals_for").desc(), F.col("team_id").asc_nulls_last(),
                              F.col("team_name").asc_nulls_last())
            .limit(k).select("team_id", "team_name", "goals_for", "goals_against", "points"))


def form_summary(form: DataFrame) -> DataFrame:
    """Teams per form label."""
    return form.groupBy("form_label").agg(F.count(F.lit(1)).alias("teams"))


def top_k(players: DataFrame, teams: DataFrame, by: str, k: int = 10) -> DataFrame:
    """Leaderboard by goals or assists (ties broken by scorer rank).

    ``players`` is unranked: the k rows are taken first, then only they are
    joined to their teams and given their rank, which is one plus the players
    ahead of them (k conditional counts in one aggregate pass)."""
    order = [F.col("goals").desc(), F.col("assists").desc(), F.col("player_id").asc_nulls_last()]
    lead = order if by == "goals" else [F.col(by).desc(), *order]
    best = players.orderBy(*lead).limit(k).select("player_id", "player_name", "team_id", "team_name", "goals", "assists").collect()
    spark, kinds = players.sparkSession, players.schema

    def ahead(r):
        g, a, p = F.col("goals"), F.col("assists"), F.col("player_id")
        first = p.isNotNull() if r["player_id"] is None else p < r["player_id"]
        return (g > r["goals"]) | ((g == r["goals"]) & ((a > r["assists"]) | ((a == r["assists"]) & F.coalesce(first, F.lit(False)))))

    counts = players.agg(*[F.count_if(ahead(r)).alias(f"n{i}") for i, r in enumerate(best)]).first() if best else ()
    fields = ["player_id", "player_name", "team_id", "team_name", "goals", "assists"]
    schema = ", ".join(["scorer_rank long", *[f"{c} {kinds[c].dataType.simpleString()}" for c in fields]])
    few = spark.createDataFrame([(n + 1, *r) for n, r in zip(counts, best)], schema)
    t = teams.select(F.col("team_id").alias("_t"), "team_display_name")
    return (few.join(t, F.col("team_id") == F.col("_t"), "left")
            .select("scorer_rank", "player_id", "player_name",
                    F.coalesce("team_display_name", "team_name").alias("team_name"), "goals", "assists"))


def player_goal_share(scorers: DataFrame) -> DataFrame:
    """Each player's share of the team's goals (percent, 1 decimal).

    Team totals come from a grouped sum (partial aggregation collapses a
    hot team map-side); the join back on ``team_id`` is planned by size
    (broadcast when the totals are small, else a sort-merge join that AQE
    splits for skewed keys)."""
    totals = (scorers.groupBy(F.col("team_id").alias("_tg_team"))
              .agg(F.sum(nz("goals")).cast("long").alias("team_goals")))
    j = scorers.join(totals, F.col("team_id").eqNullSafe(F.col("_tg_team")))
    return j.select(
        "player_id", "team_id", nz("goals").alias("goals"), "team_goals",
        F.when(F.col("team_goals") == 0, F.lit(0.0))
         .otherwise(exact_round_ratio(nz("goals"), "team_goals", 1, scale=100))
         .alias("goal_share_pct"))


def sample_where(df: DataFrame, column: str, value, n: int = 5) -> DataFrame:
    """F2 + O6: up to ``n`` rows with ``column == value``, in no particular
    order (an inspection sample; the filter is pushed to the scan)."""
    return df.filter(F.col(column) == F.lit(value)).limit(n)


def first_by_name(df: DataFrame, name_col: str, key_col: str, k: int = 10) -> DataFrame:
    """The first ``k`` rows by name (key breaks ties)."""
    return df.orderBy(F.col(name_col).asc_nulls_last(), F.col(key_col).asc_nulls_last()).limit(k)
