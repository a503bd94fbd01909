"""Plain single-task windows: the oracle of the distributed operators."""
from pyspark.sql import Window
from pyspark.sql import functions as F


def running_stats_window(df, group, order, values, n, rn_name="seq_no", cum_prefix="cum_", last_prefix="last_n_"):
    w = Window.partitionBy(*group).orderBy(*order)
    return df.select(
        "*", F.row_number().over(w).alias(rn_name),
        *[F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{cum_prefix}{v}") for v, c in values.items()],
        *[F.sum(c).over(w.rowsBetween(-(n - 1), 0)).alias(f"{last_prefix}{v}") for v, c in values.items()])


def rolling_form_window(matches, n=5):
    """Rolling form by one window per team, from the mart's own records."""
    from medallion.plans import gold
    rows = gold.form_records(matches)
    values = {"points": F.col("points_earned"), "scored": F.col("goals_scored"), "conceded": F.col("goals_conceded"),
              "played": F.col("match_id").isNotNull().cast("int")}
    seq = running_stats_window(rows, ["team_id"], gold.chrono(), values, n, rn_name="match_number")
    long = {"points_last_5": "last_n_points", "goals_scored_last_5": "last_n_scored",
            "goals_conceded_last_5": "last_n_conceded", "cumulative_points": "cum_points", "cumulative_played": "cum_played"}
    return seq.select("team_id", "team_name", "match_date", "match_id", F.col("match_number").cast("long").alias("match_number"),
                      "result", "goals_scored", "goals_conceded", "points_earned",
                      *[F.col(c).cast("long").alias(k) for k, c in long.items()])
