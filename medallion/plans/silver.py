"""Silver flattening (C5): nested Bronze records -> flat, typed, cleaned tables.

Each ``silver_*`` function takes a DataFrame whose columns are the fields of
one Bronze record (``sources.bronze.read_records`` produces it) and returns
the Silver table as one ``select`` (the reference's 28 chained
``withColumn`` calls and driver-side dict flattening become a single
projection).  Casts are ``try_cast`` / ``try_to_date`` so a bad value becomes
null and is counted by the quality gate instead of failing the job under ANSI.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (REJECTED, clean, clean_upper, eq_flag, first_matching, first_nonblank,
                                 first_nonzero, nz, rejected, result_code, try_int)
from ..operators.ranking import rank_by
from ..schemas import SILVER_MATCHES, SILVER_PLAYERS, SILVER_TEAMS

# Shirt numbers the reference fills in by first name when the
# source gives none (first name -> shirt number).
SHIRT_NUMBER_BY_FIRST_NAME = {
    "Harry": 9, "Robert": 9, "Lautaro": 10, "Erling": 9,
    "Vinicius": 7, "Ousmane": 10, "Kylian": 9, "Jonathan": 10,
}

# Match statuses the quality gate accepts.
KNOWN_STATUSES = ("FINISHED", "SCHEDULED", "POSTPONED", "CANCELLED", "IN_PLAY", "TIMED")


def _processed_at() -> Column:
    return F.current_timestamp().cast("string")


def _source(source: Column | str | None) -> Column:
    if source is None:
        return F.lit(None).cast("string")
    return F.lit(source) if isinstance(source, str) else source


def _rejects(wanted: bool, *pairs) -> list[Column]:
    return [rejected(*pairs).alias(REJECTED)] if wanted else []


def _columns(schema, count_rejects: bool) -> list[str]:
    return schema.fieldNames() + ([REJECTED] if count_rejects else [])


def _ints(*names: str) -> list[tuple[Column, Column]]:
    return [(F.col(n), try_int(F.col(n))) for n in names]


def silver_matches(records: DataFrame, source: Column | str | None = None,
                   count_rejects: bool = False) -> DataFrame:
    """Flatten one match record per row."""
    ft, ht = F.col("score.fullTime"), F.col("score.halfTime")
    status = clean("status")
    home_ft, away_ft = try_int(ft["home"]), try_int(ft["away"])
    winner = clean(F.col("score.winner"))
    flat = records.select(
        try_int("id").alias("match_id"),
        F.try_to_date(F.col("utcDate")).alias("match_date"),
        F.try_to_timestamp(F.col("utcDate")).alias("match_timestamp"),
        status.alias("status"),
        eq_flag(status, "FINISHED").alias("is_finished"),
        try_int("matchday").alias("matchday"),
        clean("stage").alias("stage"),
        first_nonblank("group", default="NA").alias("group_name"),
        try_int(F.col("competition.id")).alias("competition_id"),
        clean(F.col("competition.name")).alias("competition_name"),
        clean(F.col("competition.code")).alias("competition_code"),
        try_int(F.col("season.id")).alias("season_id"),
        try_int(F.col("homeTeam.id")).alias("home_team_id"),
        clean(F.col("homeTeam.name")).alias("home_team_name"),
        clean(F.col("homeTeam.shortName")).alias("home_team_short"),
        try_int(F.col("awayTeam.id")).alias("away_team_id"),
        clean(F.col("awayTeam.name")).alias("away_team_name"),
        clean(F.col("awayTeam.shortName")).alias("away_team_short"),
        home_ft.alias("home_score_ft"), away_ft.alias("away_score_ft"),
        try_int(ht["home"]).alias("home_score_ht"), try_int(ht["away"]).alias("away_score_ht"),
        winner.alias("winner"),
        result_code(winner).alias("home_result"),
        F.when(eq_flag(status, "FINISHED"), home_ft + away_ft).cast("int").alias("total_goals"),
        F.when(eq_flag(status, "FINISHED"), home_ft - away_ft).cast("int").alias("goal_difference"),
        clean(F.get(F.col("referees"), 0)["name"]).alias("referee_name"),
        _processed_at().alias("silver_processed_at"),
        _source(source).alias("source_blob"),
        *_rejects(count_rejects, *_ints("id", "matchday", "competition.id", "season.id", "homeTeam.id", "awayTeam.id",
                                        "score.fullTime.home", "score.fullTime.away", "score.halfTime.home",
                                        "score.halfTime.away"),
                  (F.col("utcDate"), F.try_to_date(F.col("utcDate")))),
    )
    return flat.select(*_columns(SILVER_MATCHES, count_rejects))


def silver_teams(records: DataFrame, source: Column | str | None = None,
                 competition_code: str = "CL", count_rejects: bool = False) -> DataFrame:
    """Flatten one team record per row; the competition entry is the
    first with the given code, else the first listed, else null (E6)."""
    comp = first_matching("runningCompetitions", lambda c: c["code"] == competition_code)
    flat = records.select(
        try_int("id").alias("team_id"),
        clean("name").alias("team_name"),
        clean("shortName").alias("team_short_name"),
        clean_upper("tla").alias("team_tla"),
        clean(first_nonblank("shortName", "name")).alias("team_display_name"),
        try_int("founded").alias("founded_year"),
        F.col("clubColors").alias("club_colours"),
        F.col("venue").alias("venue_name"),
        F.col("website").alias("website"),
        try_int(F.col("area.id")).alias("area_id"),
        clean(F.col("area.name")).alias("area_name"),
        clean_upper(F.col("area.code")).alias("area_code"),
        try_int(comp["id"]).alias("competition_id"),
        comp["name"].alias("competition_name"),
        comp["code"].alias("competition_code"),
        eq_flag(comp["code"], competition_code).alias("is_ucl_participant"),
        _processed_at().alias("silver_processed_at"),
        _source(source).alias("source_blob"),
        *_rejects(count_rejects, *_ints("id", "founded", "area.id"), (comp["id"], try_int(comp["id"]))),
    )
    return flat.select(*_columns(SILVER_TEAMS, count_rejects))


def shirt_lookup(first_name: Column, table: Mapping[str, int] | None = None) -> Column:
    """Shirt number by first name, as a literal map (no join needed)."""
    table = SHIRT_NUMBER_BY_FIRST_NAME if table is None else table
    if not table:
        return F.lit(None).cast("int")
    pairs = []
    for k, v in table.items():
        pairs += [F.lit(k), F.lit(int(v))]
    return F.try_element_at(F.create_map(*pairs), first_name)


def players_derived(flat: DataFrame, rank_method: str | None = "row_number") -> DataFrame:
    """P14, P20, W2 on a flat players table: null counts to 0, non-penalty
    goals, and the global scorer rank (goals desc, assists desc; ties broken
    by player id so the rank is reproducible, E12)."""
    out = (flat.withColumn("goals", nz("goals").cast("int"))
           .withColumn("assists", nz("assists").cast("int"))
           .withColumn("penalties", nz("penalties").cast("int"))
           .withColumn("non_penalty_goals", (F.col("goals") - F.col("penalties")).cast("int")))
    order = [F.col("goals").desc(), F.col("assists").desc(), F.col("player_id").asc_nulls_last()]
    if rank_method is None:          # the caller reads no rank
        return out
    if rank_method == "dense_rank":
        return rank_by(out, order[:2], "scorer_rank", method="dense_rank", keys=["goals", "assists"])
    return rank_by(out, order, "scorer_rank")


def silver_players(records: DataFrame, source: Column | str | None = None,
                   shirt_numbers: Mapping[str, int] | None = None,
                   rank_method: str = "row_number", count_rejects: bool = False) -> DataFrame:
    """Flatten one scorer record per row, then derive and rank."""
    p, t = F.col("player"), F.col("team")
    flat = records.select(
        try_int(p["id"]).alias("player_id"),
        clean(p["name"]).alias("player_name"),
        p["firstName"].alias("player_first_name"),
        p["lastName"].alias("player_last_name"),
        F.try_to_date(p["dateOfBirth"]).alias("player_dob"),
        clean(p["nationality"]).alias("nationality"),
        clean_upper(first_nonblank(p["position"], p["section"], default="Unknown")).alias("position"),
        try_int(first_nonzero(p["shirtNumber"], shirt_lookup(p["firstName"], shirt_numbers)))
        .alias("shirt_number"),
        try_int(t["id"]).alias("team_id"),
        clean(t["name"]).alias("team_name"),
        t["shortName"].alias("team_short_name"),
        clean_upper(t["tla"]).alias("team_tla"),
        try_int("goals").alias("goals"),
        try_int("assists").alias("assists"),
        try_int("penalties").alias("penalties"),
        _source(source).alias("source_blob"),
        *_rejects(count_rejects, *_ints("player.id", "team.id", "goals", "assists", "penalties", "player.shirtNumber"),
                  (p["dateOfBirth"], F.try_to_date(p["dateOfBirth"]))),
    )
    out = players_derived(flat, rank_method).select(
        "*", _processed_at().alias("silver_processed_at"))
    return out.select(*_columns(SILVER_PLAYERS, count_rejects))


def conform(df: DataFrame, schema, cast: bool = True) -> DataFrame:
    """Staging view (P6): exactly the schema's columns in order; columns the
    input lacks become typed nulls.  With ``cast=True`` present columns are
    cast to the declared type; ``cast=False`` keeps their own (wider) type."""
    have = set(df.columns)

    def one(f):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return (F.col(f.name).cast(f.dataType) if cast else F.col(f.name)).alias(f.name)
    return df.select(*[one(f) for f in schema.fields])
