"""Silver queries: nested-record flattening (C5: P1-P16, S1), the streamed
Silver load (7.6), string standardising (P4, P15, P16) and JSON parsing.

Bronze-shaped nested records are rebuilt from the fixtures, serialised to
JSON text and parsed back with the declared Bronze schema (``from_json``, the
same parser ``read_documents`` uses), then flattened by the Silver functions.
The oracles compute the same Silver columns directly from the flat fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.silver import SHIRT_NUMBER_BY_FIRST_NAME, silver_matches, silver_players, silver_teams
from ..schemas import BRONZE_MATCH, BRONZE_SCORER, BRONZE_TEAM, SILVER_MATCHES, SILVER_PLAYERS, SILVER_TEAMS
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import register


def json_roundtrip(records: DataFrame, schema) -> DataFrame:
    """Records -> JSON text -> records parsed with the declared schema."""
    text = records.select(F.to_json(F.struct(*records.columns)).alias("json"))
    return text.select(F.from_json("json", schema).alias("r")).select("r.*")


SHIRT_CASE = "case first_name" + "".join(f" when '{k}' then {v}" for k, v in SHIRT_NUMBER_BY_FIRST_NAME.items()) + " end"

MATCH_COLS = [c for c in SILVER_MATCHES.fieldNames() if c != "silver_processed_at"]


MATCHES_SILVER_SQL = f"""
with {fx.fixture_ctes('matches')}
select cast(match_id as integer) as match_id, match_date,
       cast(match_date as timestamp) + to_hours(cast(match_id % 24 as integer)) + interval 45 minute
         as match_timestamp,
       status, coalesce(status = 'FINISHED', false) as is_finished,
       cast(match_id % 8 + 1 as integer) as matchday, 'LEAGUE_STAGE' as stage,
       case when match_id % 3 = 0 then 'NA' when match_id % 3 = 1 then 'NA'
            else 'GROUP_' || cast(match_id % 8 as varchar) end as group_name,
       2001 as competition_id, 'Continental Cup' as competition_name,
       'CL' as competition_code, cast(year(match_date) as integer) as season_id,
       cast(home_team_id as integer) as home_team_id, home_team_name, home_team_short,
       cast(away_team_id as integer) as away_team_id, away_team_name, away_team_short,
       home_score_ft, away_score_ft,
       cast(floor(home_score_ft / 2) as integer) as home_score_ht,
       cast(floor(away_score_ft / 2) as integer) as away_score_ht,
       winner,
       case when winner = 'HOME_TEAM' then 'W' when winner = 'AWAY_TEAM' then 'L'
            when winner = 'DRAW' then 'D' end as home_result,
       cast(case when status = 'FINISHED' then home_score_ft + away_score_ft end as integer) as total_goals,
       cast(case when status = 'FINISHED' then home_score_ft - away_score_ft end as integer) as goal_difference,
       case when match_id % 4 = 0 then null else 'Referee ' || cast(match_id % 50 as varchar) end
         as referee_name,
       'bronze/matches' as source_blob
from matches"""


@register("silver_matches_nested", MATCHES_SILVER_SQL)
def q_silver_matches_nested(spark, sf):
    recs = json_roundtrip(fx.bronze_match_records(fx.matches(spark, sf)), BRONZE_MATCH)
    return silver_matches(recs, source="bronze/matches").select(*MATCH_COLS)


TEAM_COLS = [c for c in SILVER_TEAMS.fieldNames() if c != "silver_processed_at"]


@register("silver_teams_nested", f"""
with {fx.fixture_ctes('teams')},
t as (select *,
        case when team_id % 7 = 0 then null
             when team_id % 3 = 0 then 'CL' when team_id % 3 = 1 then 'CL' else 'PD' end as comp_code
      from teams)
select cast(team_id as integer) as team_id, team_name,
       case when team_id % 5 = 0 then '' else team_short_name end as team_short_name,
       case when team_id % 4 = 0 then null else upper(substr(area_name, 1, 3)) end as team_tla,
       case when team_id % 5 = 0 then team_name else team_short_name end as team_display_name,
       cast(1880 + team_id % 100 as integer) as founded_year, 'Red / White' as club_colours,
       venue_name, 'club' || cast(team_id as varchar) || '.example' as website,
       cast(team_id % 25 as integer) as area_id, area_name,
       upper(substr(area_name, 1, 3)) as area_code,
       cast(case comp_code when 'CL' then 2001 when 'PD' then 2014 end as integer) as competition_id,
       case comp_code when 'CL' then 'Continental Cup' when 'PD' then 'National League A' end
         as competition_name,
       comp_code as competition_code, coalesce(comp_code = 'CL', false) as is_ucl_participant,
       'bronze/teams' as source_blob
from t""")
def q_silver_teams_nested(spark, sf):
    recs = json_roundtrip(fx.bronze_team_records(fx.teams(spark, sf)), BRONZE_TEAM)
    return silver_teams(recs, source="bronze/teams").select(*TEAM_COLS)


PLAYER_COLS = [c for c in SILVER_PLAYERS.fieldNames() if c != "silver_processed_at"]

_FIRST = ", ".join(f"'{n}'" for n in fx.FIRST_NAMES)


@register("silver_players_nested", f"""
with {fx.fixture_ctes('teams', 'players')},
p as (
  select *, [{_FIRST}][cast(player_id % 10 + 1 as integer)] as first_name,
         case when player_id % 5 = 0 then 0 when player_id % 5 = 1 then null
              else cast(player_id % 99 + 1 as integer) end as shirt_raw
  from players),
s as (
  select cast(player_id as integer) as player_id, player_name, first_name as player_first_name,
         player_name as player_last_name,
         cast(date '1990-01-01' + cast(player_id % 3650 as integer) as date) as player_dob,
         nationality,
         upper(case when player_id % 6 = 0 then (case when player_id % 12 = 0 then 'Unknown' else 'Offence' end)
                    else position end) as position,
         coalesce(nullif(shirt_raw, 0),
                  {SHIRT_CASE}) as shirt_number,
         cast(team_id as integer) as team_id, team_name, 'T' || cast(team_id as varchar) as team_short_name,
         'FBC' as team_tla,
         coalesce(goals, 0) as goals, coalesce(assists, 0) as assists,
         coalesce(penalties, 0) as penalties,
         coalesce(goals, 0) - coalesce(penalties, 0) as non_penalty_goals,
         'bronze/players' as source_blob
  from p)
select cast(row_number() over (order by goals desc, assists desc, player_id asc nulls last) as bigint)
         as scorer_rank, *
from s""")
def q_silver_players_nested(spark, sf):
    recs = json_roundtrip(fx.bronze_scorer_records(fx.players(spark, sf)), BRONZE_SCORER)
    return silver_players(recs, source="bronze/players").select(*PLAYER_COLS)


@register("json_props", """
select event_id, cast(json_extract(props, '$.k') as integer) as k,
       case when json_extract(props, '$.k') is null then true else false end as k_missing
from events""")
def q_json_props(spark, sf):
    ev = read_table(spark, sf, "events")
    parsed = F.from_json("props", "k int")
    return ev.select("event_id", parsed["k"].alias("k"), parsed["k"].isNull().alias("k_missing"))


@register("standardise_strings", """
select c_custkey, trim(c_name) as name, upper(trim(c_mktsegment)) as segment,
       cast(length(trim(c_name)) as integer) as name_length,
       try_cast(substr(c_name, 10) as integer) as name_number,
       length(upper(trim(c_mktsegment))) <> 8 as segment_not_8
from customer""")
def q_standardise_strings(spark, sf):
    from ..functions.columns import clean, clean_upper, try_int
    c = read_table(spark, sf, "customer")
    seg = clean_upper("c_mktsegment")
    return c.select("c_custkey", clean("c_name").alias("name"), seg.alias("segment"),
                    F.length(clean("c_name")).alias("name_length"),
                    try_int(F.substr("c_name", F.lit(10))).alias("name_number"),
                    (F.length(seg) != 8).alias("segment_not_8"))


# Number looked up by market segment when the raw number is
# missing or zero (the first-truthy-then-lookup pattern of P15/P16).
SEGMENT_NUMBER = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}


@register("first_truthy", """
select c_custkey,
       coalesce(nullif(case when c_custkey % 3 = 0 then '' else c_mktsegment end, ''),
                nullif(case when c_custkey % 5 = 0 then null else c_name end, ''),
                'Unknown') as display,
       coalesce(nullif(case when c_custkey % 4 = 0 then 0 else cast(c_custkey % 10 as integer) end, 0),
                case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
                     when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 when 'MACHINERY' then 5 end)
         as number
from customer""")
def q_first_truthy(spark, sf):
    from ..functions.columns import first_nonblank, first_nonzero
    from ..plans.silver import shirt_lookup
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    seg = F.when(k % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    name = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    raw = F.when(k % 4 == 0, F.lit(0)).otherwise((k % 10).cast("int"))
    return c.select("c_custkey", first_nonblank(seg, name, default="Unknown").alias("display"),
                    first_nonzero(raw, shirt_lookup(F.col("c_mktsegment"), SEGMENT_NUMBER))
                    .alias("number"))


# Records per Bronze document when documents are cut from a table (an API
# page of results); keeps every document bounded whatever the table size.
RECORDS_PER_DOCUMENT = 1000


def write_documents(records: DataFrame, array_field: str, path: str) -> None:
    """Cut a record table into Bronze documents of at most
    ``RECORDS_PER_DOCUMENT`` consecutive records and write them as JSON lines
    (one document per line).  Grouping is by position within each input
    partition, so no document grows with the data and no key is hot."""
    block = F.floor(F.monotonically_increasing_id() / F.lit(RECORDS_PER_DOCUMENT))
    docs = (records.withColumn("_doc", block)
            .groupBy("_doc").agg(F.collect_list(F.struct(*records.columns)).alias(array_field)))
    docs.select(F.to_json(F.struct(array_field)).alias("value")).write.text(path)


@register("silver_matches_streamed", f"""
with {fx.fixture_ctes('matches')}
select cast(match_id as integer) as match_id, match_date, status,
       coalesce(status = 'FINISHED', false) as is_finished,
       cast(home_team_id as integer) as home_team_id, home_team_name,
       cast(away_team_id as integer) as away_team_id, away_team_name,
       home_score_ft, away_score_ft,
       case when winner = 'HOME_TEAM' then 'W' when winner = 'AWAY_TEAM' then 'L'
            when winner = 'DRAW' then 'D' end as home_result,
       cast(case when status = 'FINISHED' then home_score_ft + away_score_ft end as integer) as total_goals,
       case when match_id % 4 = 0 then null else 'Referee ' || cast(match_id % 50 as varchar) end
         as referee_name
from matches""")
def q_silver_matches_streamed(spark, sf):
    """C5 through the incremental path: fixture-derived Bronze documents are
    loaded by the Structured Streaming job (availableNow; the documents are
    pages of one snapshot, so up to eight files per micro-batch; gate per
    batch) and the Silver table it wrote is returned."""
    from ..plans import quality as q
    from ..schemas import BRONZE_MATCHES_DOC
    from ..operators.ranking import scratch_table_path
    from ..streaming.bronze_stream import run_bronze_to_silver
    root = scratch_table_path(spark)
    write_documents(fx.bronze_match_records(fx.matches(spark, sf)), "matches", f"{root}/bronze")
    run_bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", "matches", BRONZE_MATCHES_DOC,
                         "matches", silver_matches, q.MATCH_CHECKS,
                         checkpoint_location=f"{root}/stream", multi_line=False, glob="*.txt",
                         files_per_batch=8)
    return spark.read.parquet(f"{root}/silver").select(
        "match_id", "match_date", "status", "is_finished", "home_team_id", "home_team_name",
        "away_team_id", "away_team_name", "home_score_ft", "away_score_ft", "home_result",
        "total_goals", "referee_name")
