"""Snapshot, idempotency and run-log queries: S3, K2, K7, B1, B2, O4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import gold
from ..plans.ingest import new_snapshots, run_log_summary
from ..sources import bronze
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import register

M = fx.fixture_ctes("matches")


def orders_snapshots(spark, sf):
    """Orders with a snapshot key (month of the order date) and a season key
    (order status): stands in for dated snapshot files of several seasons."""
    o = read_table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", F.col("o_orderstatus").alias("season"),
                    F.trunc(day, "month").alias("snapshot_date"), day.alias("d"))


@register("snapshot_latest", """
with s as (select o_orderkey, o_orderstatus as season,
                  cast(date_trunc('month', o_orderdate) as date) as snapshot_date from orders)
select * from s
where snapshot_date = (select max(i.snapshot_date) from s i where i.season = s.season)""")
def q_snapshot_latest(spark, sf):
    return bronze.latest_snapshot(orders_snapshots(spark, sf).drop("d"), "snapshot_date", ["season"])


@register("snapshot_latest_overall", """
with s as (select o_orderkey, o_orderstatus as season,
                  cast(date_trunc('month', o_orderdate) as date) as snapshot_date from orders)
select * from s where snapshot_date = (select max(snapshot_date) from s)""")
def q_snapshot_latest_overall(spark, sf):
    return bronze.latest_snapshot(orders_snapshots(spark, sf).drop("d"), "snapshot_date")


# Fixed parameters of the overlap: stored snapshots end before the second
# date, incoming ones start at the first, so half a year overlaps.
INCOMING_FROM, STORED_BEFORE = "2000-01-01", "2000-07-01"


@register("idempotent_append", f"""
with s as (select o_orderkey, o_orderstatus as season,
                  cast(date_trunc('month', o_orderdate) as date) as snapshot_date,
                  cast(o_orderdate as date) as d from orders),
incoming as (select o_orderkey, season, snapshot_date from s where d >= date '{INCOMING_FROM}'),
stored as (select season, snapshot_date from s where d < date '{STORED_BEFORE}')
select * from incoming i
where not exists (select 1 from stored x
                  where x.season = i.season and x.snapshot_date = i.snapshot_date)""")
def q_idempotent_append(spark, sf):
    s = orders_snapshots(spark, sf)
    incoming = s.filter(F.col("d") >= F.lit(INCOMING_FROM).cast("date")).select(
        "o_orderkey", "season", "snapshot_date")
    stored = s.filter(F.col("d") < F.lit(STORED_BEFORE).cast("date")).select("season", "snapshot_date")
    return new_snapshots(incoming, stored, ["season", "snapshot_date"])


def season_log(m):
    """Per-season load log over the match facts: a season loads when it has
    at least one finished match and no match lacks a team name."""
    return m.groupBy(F.year("match_date").alias("season")).agg(
        F.count(F.lit(1)).alias("rows"),
        ((F.count_if(F.col("is_finished")) > 0)
         & (F.count_if(F.col("home_team_name").isNull() | F.col("away_team_name").isNull()) == 0))
        .alias("ok"))


@register("run_log_summary", f"""
with {M},
log as (select year(match_date) as season, count(*) as n,
               count_if(is_finished) > 0
               and count_if(home_team_name is null or away_team_name is null) = 0 as ok
        from matches group by 1)
select count(*) as items, count_if(ok) as succeeded, count_if(not ok or ok is null) as failed,
       coalesce(bool_and(coalesce(ok, false)), false) and count(*) > 0 as overall
from log""")
def q_run_log_summary(spark, sf):
    return run_log_summary(season_log(fx.matches(spark, sf)))


@register("season_filter_counts", f"""
with {M}
select cast(year(match_date) as integer) as season_id, count(*) as match_count
from matches where status = 'FINISHED' group by 1""")
def q_season_filter_counts(spark, sf):
    m = fx.matches(spark, sf).filter(F.col("status") == "FINISHED")
    return m.groupBy(F.year("match_date").cast("int").alias("season_id")).agg(
        F.count(F.lit(1)).alias("match_count"))


@register("latest_matches_top10", f"""
with {M}
select match_date, match_id, home_team_name, home_score_ft, away_score_ft, away_team_name, home_result
from matches where is_finished
order by match_date desc, match_id desc limit 10""")
def q_latest_matches_top10(spark, sf):
    m = gold.finished(fx.matches(spark, sf))
    return (m.orderBy(F.col("match_date").desc(), F.col("match_id").desc()).limit(10)
            .select("match_date", "match_id", "home_team_name", "home_score_ft", "away_score_ft",
                    "away_team_name", "home_result"))


@register("first_matches_top10", f"""
with {M}
select match_date, cast(match_id % 8 + 1 as integer) as matchday, match_id, home_team_name, home_score_ft,
       away_score_ft, away_team_name, home_result
from matches where is_finished order by match_date, match_id % 8, match_id limit 10""")
def q_first_matches_top10(spark, sf):
    """O4 in the reference's order: finished matches by date, then matchday."""
    from ..plans.silver import silver_matches
    flat = silver_matches(fx.bronze_match_records(fx.matches(spark, sf)))
    return (gold.finished(flat).orderBy("match_date", "matchday", "match_id").limit(10)
            .select("match_date", "matchday", "match_id", "home_team_name", "home_score_ft", "away_score_ft",
                    "away_team_name", "home_result"))


@register("dedup_latest_per_key", """
select o_orderkey, o_custkey, cast(o_orderdate as date) as order_date, o_orderstatus
from (select *, row_number() over (partition by o_custkey
                                   order by o_orderdate desc, o_orderkey desc) as rn
      from orders)
where rn = 1""")
def q_dedup_latest(spark, sf):
    """One row per key, the newest (top-1 WindowGroupLimit, partial
    before the shuffle, so a customer with many orders costs one row per
    map task)."""
    from ..operators.sequence import dedup_latest
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
        "o_orderdate", "o_orderstatus")
    out = dedup_latest(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return out.select("o_orderkey", "o_custkey", "order_date", "o_orderstatus")
