"""Declared schemas for every layer.  Nothing in the library infers a schema.

Bronze: the nested record shapes of one snapshot document (an envelope object
holding a record array plus an ingestion-metadata block).
Silver: the flat, contractual column lists and types.  Fixed values: the column
names and their order equal the reference's.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B, D, TS = (T.StringType(), T.IntegerType(), T.LongType(),
                     T.BooleanType(), T.DateType(), T.TimestampType())


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --------------------------------------------------------------------------
# Bronze
# --------------------------------------------------------------------------
NAMED_REF = struct(("id", L), ("name", S), ("code", S))
TEAM_REF = struct(("id", L), ("name", S), ("shortName", S))
SIDE_SCORE = struct(("home", I), ("away", I))

BRONZE_MATCH = struct(
    ("id", L), ("utcDate", S), ("status", S), ("matchday", I), ("stage", S),
    ("group", S), ("competition", NAMED_REF), ("season", struct(("id", L))),
    ("homeTeam", TEAM_REF), ("awayTeam", TEAM_REF),
    ("score", struct(("winner", S), ("fullTime", SIDE_SCORE), ("halfTime", SIDE_SCORE))),
    ("referees", T.ArrayType(struct(("name", S)))),
)

BRONZE_TEAM = struct(
    ("id", L), ("name", S), ("shortName", S), ("tla", S), ("founded", I),
    ("clubColors", S), ("venue", S), ("website", S), ("area", NAMED_REF),
    ("runningCompetitions", T.ArrayType(NAMED_REF)),
)

BRONZE_SCORER = struct(
    ("player", struct(("id", L), ("name", S), ("firstName", S), ("lastName", S),
                      ("dateOfBirth", S), ("nationality", S), ("position", S),
                      ("section", S), ("shirtNumber", I))),
    ("team", struct(("id", L), ("name", S), ("shortName", S), ("tla", S))),
    ("goals", I), ("assists", I), ("penalties", I),
)

INGESTION_METADATA = struct(
    ("ingested_at", S), ("ingested_by", S), ("season", I), ("source", S),
    ("endpoint", S), ("layer", S), ("match_count", I), ("team_count", I),
    ("scorer_count", I), ("competition_count", I), ("limit_applied", I),
    ("competition_id", I), ("season_id", I), ("season_name", S),
)

COMPETITION_SEASON = struct(("competition_id", I), ("season_id", I), ("season_name", S))


def envelope(array_field: str, record: T.StructType) -> T.StructType:
    """Schema of one Bronze document: record array + both metadata spellings."""
    return struct((array_field, T.ArrayType(record)),
                  ("_ingestion_metadata", INGESTION_METADATA),
                  ("ingestion_metadata", INGESTION_METADATA))


BRONZE_MATCHES_DOC = envelope("matches", BRONZE_MATCH)
BRONZE_TEAMS_DOC = envelope("teams", BRONZE_TEAM)
BRONZE_PLAYERS_DOC = envelope("scorers", BRONZE_SCORER)

# --------------------------------------------------------------------------
# Silver (column order is contractual)
# --------------------------------------------------------------------------
SILVER_MATCHES = struct(
    ("match_id", I), ("match_date", D), ("match_timestamp", TS), ("status", S),
    ("is_finished", B), ("matchday", I), ("stage", S), ("group_name", S),
    ("competition_id", I), ("competition_name", S), ("competition_code", S),
    ("season_id", I), ("home_team_id", I), ("home_team_name", S),
    ("home_team_short", S), ("away_team_id", I), ("away_team_name", S),
    ("away_team_short", S), ("home_score_ft", I), ("away_score_ft", I),
    ("home_score_ht", I), ("away_score_ht", I), ("winner", S), ("home_result", S),
    ("total_goals", I), ("goal_difference", I), ("referee_name", S),
    ("silver_processed_at", S), ("source_blob", S),
)

SILVER_TEAMS = struct(
    ("team_id", I), ("team_name", S), ("team_short_name", S), ("team_tla", S),
    ("team_display_name", S), ("founded_year", I), ("club_colours", S),
    ("venue_name", S), ("website", S), ("area_id", I), ("area_name", S),
    ("area_code", S), ("competition_id", I), ("competition_name", S),
    ("competition_code", S), ("is_ucl_participant", B),
    ("silver_processed_at", S), ("source_blob", S),
)

SILVER_PLAYERS = struct(
    ("scorer_rank", L), ("player_id", I), ("player_name", S),
    ("player_first_name", S), ("player_last_name", S), ("player_dob", D),
    ("nationality", S), ("position", S), ("shirt_number", I), ("team_id", I),
    ("team_name", S), ("team_short_name", S), ("team_tla", S), ("goals", I),
    ("assists", I), ("penalties", I), ("non_penalty_goals", I),
    ("silver_processed_at", S), ("source_blob", S),
)

# Check results of the quality gate and of the declarative tests.
CHECK_RESULT = struct(("table", S), ("check", S), ("severity", S),
                      ("passed", B), ("value", S))
TEST_RESULT = struct(("model", S), ("test", S), ("column", S), ("failures", L))
