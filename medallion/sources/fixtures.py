"""Domain tables derived from the driver tables.

The driver ships no match data, so matches, teams and players are defined
over the TPC-H-style tables: an order with at least two distinct suppliers is
a match, a supplier is a team, a customer is a player.  The Spark versions are
defined once, as SQL text (``FIXTURE_SQL``) that Spark and the DuckDB oracle
both run; in Spark every scan is pruned to the columns used and filters are
pushed to the Parquet reader.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

_TABLES = ("lineitem", "orders", "supplier", "customer", "nation")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table, from the shared SQL text below.

    The driver tables are passed to ``spark.sql`` as DataFrame parameters
    (read with declared schemas), so Spark runs exactly the statement the
    oracle runs; Catalyst plans it like the equivalent DataFrame chain, and
    one parse and analysis replaces dozens of incremental ones.
    """
    text = FIXTURE_SQL[name]
    used = [t for t in _TABLES if re.search(rf"\b{t}\b", text)]
    text = re.sub(r"\b(" + "|".join(used) + r")\b", r"{\1}", text)
    return spark.sql(text, **{t: read_table(spark, sf_dir, t) for t in used})


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped match facts (a subset of the Silver columns).

    Plan: lineitem is aggregated per order (partial + final hash aggregate,
    one shuffle on the order key) and joined to orders on the same key (the
    aggregate side is already partitioned on it); finished-only marts push
    ``o_orderstatus = 'F'`` into the orders scan.  Supplier names are looked
    up for both sides; supplier grows with the data, so those joins are left
    to the planner: broadcast below the size threshold (re-checked by AQE at
    runtime), sort-merge above it.
    """
    return fixture(spark, sf_dir, "matches")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "teams")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players with season counts from orders; the team id uses the supplier
    count as a scalar subquery (its own one-row job, not a join)."""
    return fixture(spark, sf_dir, "players")


# The same three definitions as SQL text (Spark SQL and DuckDB both run it).
FIXTURE_SQL = {
    "matches": """
with li as (
  select l_orderkey, min(l_suppkey) as s_lo, max(l_suppkey) as s_hi,
         cast(sum(l_quantity) as bigint) as q
  from lineitem group by l_orderkey
), m as (
  select o.o_orderkey as match_id,
         cast(o.o_orderdate as date) as match_date,
         case o.o_orderstatus when 'F' then 'FINISHED' when 'O' then 'SCHEDULED' else 'POSTPONED' end as status,
         o.o_orderstatus = 'F' as is_finished,
         case when o.o_orderkey % 2 = 0 then li.s_lo else li.s_hi end as home_team_id,
         case when o.o_orderkey % 2 = 0 then li.s_hi else li.s_lo end as away_team_id,
         case when o.o_orderstatus = 'F' then cast(li.q % 5 as int) end as home_score_ft,
         case when o.o_orderstatus = 'F' then cast((li.q + o.o_custkey) % 4 as int) end as away_score_ft
  from orders o join li on li.l_orderkey = o.o_orderkey
  where li.s_lo < li.s_hi
)
select m.match_id, m.match_date, m.status, m.is_finished,
       m.home_team_id, h.s_name as home_team_name, concat('S', cast(m.home_team_id as varchar(20))) as home_team_short,
       m.away_team_id, a.s_name as away_team_name, concat('S', cast(m.away_team_id as varchar(20))) as away_team_short,
       m.home_score_ft, m.away_score_ft,
       case when m.home_score_ft > m.away_score_ft then 'HOME_TEAM'
            when m.home_score_ft < m.away_score_ft then 'AWAY_TEAM'
            when m.home_score_ft = m.away_score_ft then 'DRAW' end as winner,
       case when m.home_score_ft > m.away_score_ft then 'W'
            when m.home_score_ft < m.away_score_ft then 'L'
            when m.home_score_ft = m.away_score_ft then 'D' end as home_result
from m join supplier h on h.s_suppkey = m.home_team_id
       join supplier a on a.s_suppkey = m.away_team_id
""",
    "teams": """
select s.s_suppkey as team_id, s.s_name as team_name,
       concat('S', cast(s.s_suppkey as varchar(20))) as team_short_name,
       concat('Club ', cast(s.s_suppkey as varchar(20))) as team_display_name,
       n.n_name as area_name, concat('Venue ', n.n_name) as venue_name
from supplier s join nation n on n.n_nationkey = s.s_nationkey
""",
    "players": """
with st as (
  select o_custkey,
         cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as int) as goals,
         cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as int) as assists,
         cast(sum(case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then 1 else 0 end) as int) as penalties
  from orders group by o_custkey
)
select c.c_custkey as player_id, c.c_name as player_name, n.n_name as nationality,
       c.c_mktsegment as position,
       c.c_custkey % ((select count(*) from supplier) + 3) as team_id,
       concat('Fallback ', cast(c.c_custkey as varchar(20))) as team_name,
       st.goals, st.assists, st.penalties
from customer c
join nation n on n.n_nationkey = c.c_nationkey
left join st on st.o_custkey = c.c_custkey
""",
}


def fixture_ctes(*names: str) -> str:
    """CTE list binding the named fixtures, for ``with <ctes>, ... select``."""
    return ",\n".join(f"{n} as ({FIXTURE_SQL[n]})" for n in names)


# --------------------------------------------------------------------------
# Bronze-shaped records rebuilt from the fixtures (nested structs + arrays),
# used to exercise the Silver flattening.  Variations keyed on the id cover
# the edge rows: padded strings, blank / null group, empty referee list,
# blank short name, missing CL entry, zero / null shirt numbers.
# --------------------------------------------------------------------------
# First names cycled over players (the first eight are the
# ones the Silver shirt-number lookup knows).
FIRST_NAMES = ("Harry", "Robert", "Lautaro", "Erling", "Vinicius", "Ousmane", "Kylian",
               "Jonathan", "Luka", "Mohamed")
CL = ("2001", "Continental Cup", "CL")
PL = ("2021", "National League B", "PL")
PD = ("2014", "National League A", "PD")


def _comp(entry):
    i, n, c = entry
    return F.struct(F.lit(int(i)).cast("long").alias("id"), F.lit(n).alias("name"),
                    F.lit(c).alias("code"))


def bronze_match_records(m: DataFrame) -> DataFrame:
    mid = F.col("match_id")
    hour = F.lpad((mid % 24).cast("string"), 2, "0")
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    return m.select(
        mid.alias("id"),
        F.concat(F.date_format("match_date", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":45:00Z"))
         .alias("utcDate"),
        F.when(mid % 7 == 0, F.concat(F.lit(" "), F.col("status"), F.lit(" ")))
         .otherwise(F.col("status")).alias("status"),
        (mid % 8 + 1).cast("int").alias("matchday"),
        F.lit("LEAGUE_STAGE").alias("stage"),
        F.when(mid % 3 == 0, F.lit(None).cast("string")).when(mid % 3 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("GROUP_"), (mid % 8).cast("string"))).alias("group"),
        _comp(CL).alias("competition"),
        F.struct(F.year("match_date").cast("long").alias("id")).alias("season"),
        F.struct(F.col("home_team_id").alias("id"), F.col("home_team_name").alias("name"),
                 F.col("home_team_short").alias("shortName")).alias("homeTeam"),
        F.struct(F.col("away_team_id").alias("id"), F.col("away_team_name").alias("name"),
                 F.col("away_team_short").alias("shortName")).alias("awayTeam"),
        F.struct(F.col("winner").alias("winner"),
                 F.struct(F.col("home_score_ft").alias("home"), F.col("away_score_ft").alias("away"))
                  .alias("fullTime"),
                 F.struct(half("home_score_ft").alias("home"), half("away_score_ft").alias("away"))
                  .alias("halfTime")).alias("score"),
        F.when(mid % 4 == 0, F.array().cast("array<struct<name:string>>"))
         .otherwise(F.array(F.struct(F.concat(F.lit(" Referee "), (mid % 50).cast("string"),
                                              F.lit(" ")).alias("name")))).alias("referees"))


def bronze_team_records(t: DataFrame) -> DataFrame:
    tid = F.col("team_id")
    comps = (F.when(tid % 7 == 0, F.array().cast("array<struct<id:bigint,name:string,code:string>>"))
             .when(tid % 3 == 0, F.array(_comp(CL)))
             .when(tid % 3 == 1, F.array(_comp(PL), _comp(CL)))
             .otherwise(F.array(_comp(PD))))
    return t.select(
        tid.alias("id"), F.col("team_name").alias("name"),
        F.when(tid % 5 == 0, F.lit("")).otherwise(F.col("team_short_name")).alias("shortName"),
        F.when(tid % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.lower(F.substring("area_name", 1, 3)), F.lit(" ")))
         .alias("tla"),
        (F.lit(1880) + tid % 100).cast("int").alias("founded"),
        F.lit("Red / White").alias("clubColors"),
        F.col("venue_name").alias("venue"),
        F.concat(F.lit("club"), tid.cast("string"), F.lit(".example")).alias("website"),
        F.struct((tid % 25).alias("id"), F.concat(F.lit(" "), F.col("area_name"), F.lit(" ")).alias("name"),
                 F.lower(F.substring("area_name", 1, 3)).alias("code")).alias("area"),
        comps.alias("runningCompetitions"))


def bronze_scorer_records(p: DataFrame) -> DataFrame:
    pid = F.col("player_id")
    first = F.element_at(F.array(*[F.lit(n) for n in FIRST_NAMES]),
                         (pid % len(FIRST_NAMES) + 1).cast("int"))
    return p.select(
        F.struct(
            pid.alias("id"), F.concat(F.lit(" "), F.col("player_name")).alias("name"),
            first.alias("firstName"), F.col("player_name").alias("lastName"),
            F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (pid % 3650).cast("int")),
                          "yyyy-MM-dd").alias("dateOfBirth"),
            F.col("nationality").alias("nationality"),
            F.when(pid % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("position"))
             .alias("position"),
            F.when(pid % 12 == 0, F.lit(None).cast("string")).otherwise(F.lit("Offence"))
             .alias("section"),
            F.when(pid % 5 == 0, F.lit(0)).when(pid % 5 == 1, F.lit(None).cast("int"))
             .otherwise((pid % 99 + 1).cast("int")).alias("shirtNumber")).alias("player"),
        F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name"),
                 F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("shortName"),
                 F.lit(" fbc ").alias("tla")).alias("team"),
        "goals", "assists", "penalties")
