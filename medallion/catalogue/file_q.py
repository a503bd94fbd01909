"""File round trips: documents, snapshots, ingestion and publication as queries
(S1-S9, K1-K7, B1-B3, B5, C8-C10, F2, Q12, Q13, O1-O3, O6).

Each query cuts documents from the given tables into the shared checkpoint
folder, runs the library's readers and writers over them, and returns what came
back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_by, scratch_table_path
from ..plans import dashboards, gold, ingest, jobs
from ..plans import quality as q
from ..plans.silver import silver_matches, silver_teams
from ..schemas import BRONZE_MATCHES_DOC, BRONZE_PLAYERS_DOC, SILVER_MATCHES
from ..session import delete_paths
from ..sources import bronze, layers
from ..sources import fixtures as fx
from ..sources.commits import SnapshotStore
from . import register
from .gold_q import LEAGUE_ORDER, M, MTP, PLAYERS_SQL, RATIO_COLS, RECENT_SQL, SEASON_SQL, TEAM_ORDER, players_silver
from .silver_q import MATCH_COLS, MATCHES_SILVER_SQL

PAGE = 500  # records per cut document


def cut_documents(records: DataFrame, key, array_field: str, path: str, extra: dict | None = None) -> None:
    """Write documents of at most ``PAGE`` records (consecutive keys), one a file."""
    pages = records.groupBy(F.floor(key / PAGE).alias("_page")).agg(
        F.sort_array(F.collect_list(F.struct(key.alias("_k"), F.struct(*records.columns).alias("r")))).alias("_r"))
    doc = F.struct(F.transform("_r", lambda x: x["r"]).alias(array_field), *[F.lit(v).alias(k) for k, v in (extra or {}).items()])
    pages.select(F.to_json(doc).alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def stored_input(records: DataFrame, *by: str) -> DataFrame:
    """``records`` written once (in a folder per value of ``by``) and read back, for queries
    that use them several times."""
    path = scratch_table_path(records.sparkSession)
    records.write.partitionBy(*by).parquet(path)
    return records.sparkSession.read.schema(records.schema).parquet(path).select(*records.columns)


def season_records(spark, sf) -> tuple[DataFrame, list[int]]:
    """Match records with their year (``_year``, a folder each), and the years."""
    recs = fx.bronze_match_records(fx.matches(spark, sf))
    stored = stored_input(recs.withColumn("_year", F.year(F.to_date(F.substring("utcDate", 1, 10)))), "_year")
    return stored, [r[0] for r in stored.select("_year").where("_year is not null").distinct().orderBy("_year").collect()]


@register("silver_from_documents", MATCHES_SILVER_SQL)
def q_silver_from_documents(spark, sf):
    """Documents (read by a glob, among files that do not match
    it) flattened, gated, written as a dated Silver table and read back."""
    root = scratch_table_path(spark)
    recs = fx.bronze_match_records(fx.matches(spark, sf))
    cut_documents(recs, F.col("id"), "matches", f"{root}/bronze")
    cut = spark.read.text(f"{root}/bronze")      # the records are not computed again for one row
    cut.limit(1).select(F.lit("not json").alias("value")).write.csv(f"{root}/bronze/other")
    docs = bronze.read_documents(spark, f"{root}/bronze", BRONZE_MATCHES_DOC, glob="*.txt")
    silver = silver_matches(bronze.records(docs, "matches"), source="bronze/matches", count_rejects=True)
    for day in ("2024-09-01", "2024-09-08"):        # the second write is the newest snapshot
        layers.write_silver(silver, f"{root}/silver", "matches", day, q.MATCH_CHECKS)
    return layers.read_silver(spark, f"{root}/silver", "matches", SILVER_MATCHES).select(*MATCH_COLS)


SEASONS = (2022, 2023, 2024)


@register("teams_newest_documents", f"""
with {fx.fixture_ctes('teams')}, y as (select unnest([{', '.join(map(str, SEASONS))}]) as season)
select cast(y.season as integer) as season, cast(t.team_id as integer) as team_id
from teams t, y where t.team_id % 3 <> y.season % 3""")
def q_teams_newest_documents(spark, sf):
    """S2, S3 per season: an older and a newer snapshot of each season, in pages of bounded
    size; all pages of the newer ones (other teams), and no others, are read."""
    root = scratch_table_path(spark)
    recs = fx.bronze_team_records(fx.teams(spark, sf))
    days = F.explode(F.array(*[F.struct(F.lit(y).alias("season"), F.lit(m).alias("month")) for y in SEASONS for m in (8, 9)]))
    dated = recs.select("*", days.alias("_day")).where(
        ((F.col("id") % 3 == F.col("_day.season") % 3) & (F.col("_day.month") == 8))
        | ((F.col("id") % 3 != F.col("_day.season") % 3) & (F.col("_day.month") == 9)))
    pages = dated.groupBy("_day", F.floor(F.col("id") / PAGE).alias("_page")).agg(F.collect_list(F.struct(*recs.columns)).alias("r"))
    name = F.concat("_day.season", F.lit("-0"), "_day.month", F.lit("-01_teams_season_"), "_day.season")
    bronze.write_pages(pages, f"{root}/teams", name, F.col("r"), "teams")
    got = jobs.newest_records(spark, "teams", root, per_season=True)
    flat = silver_teams(got, source=F.col("source_blob"))
    return flat.select(bronze.snapshot_keys(F.concat(F.lit("/"), F.col("source_blob")))[1].alias("season"), "team_id")


@register("damaged_documents", f"""
with {M}, pages as (select match_id // {PAGE} as page, count(*) as n from matches group by 1)
select cast(page as integer) as page, cast(case when page % 5 = 2 then 0 else 1 end as bigint) as documents,
       cast(case when page % 5 in (1, 2) then 0 else n end as bigint) as records,
       case page % 5 when 1 then 'unreadable' when 2 then 'empty' end as problem,
       cast(case when page % 5 in (1, 2) then 0 else n end as bigint) as records_read,
       page % 5 = 1 as marked
from pages""")
def q_damaged_documents(spark, sf):
    """Documents among which some are cut off and some are empty.  The listing held
    against the parse names each with its reason; a quarantining read marks the cut ones and
    takes every record of the others."""
    root = scratch_table_path(spark)
    recs = fx.bronze_match_records(fx.matches(spark, sf))
    pages = recs.groupBy(F.floor(F.col("id") / PAGE).alias("page")).agg(F.collect_list(F.struct(*recs.columns)).alias("matches"))
    text = F.to_json(F.struct("matches"))
    value = (F.when(F.col("page") % 5 == 1, text.substr(F.lit(1), (F.length(text) / 2).cast("int")))
             .when(F.col("page") % 5 == 2, "").otherwise(text))
    (pages.select(value.alias("value"), F.concat(F.lit("2024-09-01_matches_season_"), F.col("page")).alias("snapshot"))
     .write.partitionBy("snapshot").option("maxRecordsPerFile", 1).text(f"{root}/matches"))
    log = bronze.document_log(spark, f"{root}/matches", "matches", glob="*.txt")
    docs = bronze.read_documents(spark, f"{root}/matches", BRONZE_MATCHES_DOC, glob="*.txt", on_damage=bronze.QUARANTINE)
    read = bronze.record_counts(docs, "matches", keep=(bronze.PROBLEM,)).select(
        "source_blob", F.col("record_count").cast("long").alias("n"), F.col(bronze.PROBLEM).isNotNull().alias("bad"))
    return log.join(read, "source_blob", "left").select(
        F.col("season").alias("page"), "documents", "records", "problem", F.coalesce("n", F.lit(0)).alias("records_read"),
        F.coalesce("bad", F.lit(False)).alias("marked"))


@register("ingest_repair", f"""
with {M}
select cast(year(match_date) as integer) as season, count(*) as rows, count(*) as ids, true as ok
from matches where match_date is not null group by 1""")
def q_ingest_repair(spark, sf):
    """Seasons left unfinished by a broken run (a fragment without a mark; a mark whose
    files were never moved into place; files lost after the commit) are repaired by the rerun."""
    target = f"{scratch_table_path(spark)}/matches"
    recs, years = season_records(spark, sf)
    store = SnapshotStore(spark, target)
    logs = None
    for y in years:
        mine, day, key = recs.where(F.col("_year") == y).drop("_year"), f"{y}-12-31", store.key(f"{y}-12-31", y)
        rows = ingest.annotate(mine, day, y, "matches").drop(*ingest.SNAPSHOT_KEYS)
        if y % 3 == 0:
            rows.where("id % 3 = 0").write.parquet(f"{target}/{key}")
        elif y % 3 == 1:
            attempt, folder = store.staging()
            rows.write.parquet(folder)
            store.commit(key, attempt, mine.count())
        else:
            ingest.bronze_ingest(spark, mine, target, day, y, "matches")
            delete_paths(spark, [f"{target}/{key}"])
        log = ingest.bronze_ingest(spark, mine, target, day, y, "matches")
        logs = log if logs is None else logs.union(log)
    ids = spark.read.parquet(target).groupBy("snapshot_season").agg(F.count_distinct("id").alias("ids"))
    return (logs.withColumn("season", F.substring_index("item", "/", -1).cast("int"))
            .join(ids, F.col("season") == F.col("snapshot_season")).select("season", "rows", "ids", "ok"))


@register("bronze_ingest_rerun", f"""
with {M}
select cast(year(match_date) as varchar) || '-12-31/' || cast(year(match_date) as varchar) as item,
       count(*) as rows, true as ok, cast(count(*) as integer) as match_count
from matches where match_date is not null group by year(match_date)
union all select '1900-01-01/1900', 0, false, null""")
def q_bronze_ingest_rerun(spark, sf):
    """Every season ingested twice (the second run appends
    nothing), and an empty season that is logged as failed."""
    target = f"{scratch_table_path(spark)}/matches"
    recs, years = season_records(spark, sf)
    logs = None
    for y in [1900, *years, *years]:
        day = "1900-01-01" if y == 1900 else f"{y}-12-31"
        log = ingest.bronze_ingest(spark, recs.where(F.col("_year") == y).drop("_year"), target, day, y, "matches", entity="match", ingested_by="catalogue")
        logs = log if logs is None else logs.union(log)
    stored = spark.read.parquet(target).groupBy("snapshot_season").agg(F.max("_ingestion_metadata.match_count").alias("match_count"))
    return (logs.distinct().withColumn("s", F.substring_index("item", "/", -1).cast("int"))
            .join(stored, F.col("s") == F.col("snapshot_season"), "left").select("item", "rows", "ok", "match_count"))


@register("season_index_ingest", f"""
with {M}
select 'season ' || cast(match_id // 1000 as varchar) || ' of ' || case when match_id % 2 = 0 then '16' else '11' end as item,
       count(*) as rows, true as ok
from matches group by match_id // 1000, match_id % 2""")
def q_season_index_ingest(spark, sf):
    """Two competitions share their season ids; both are ingested into one
    store, one of them twice, and each logs and stores its own matches."""
    root = scratch_table_path(spark)
    m = fx.matches(spark, sf).select("match_id", "status", F.when(F.col("match_id") % 2 == 0, 16).otherwise(11).alias("competition_id"),
                                     F.floor(F.col("match_id") / 1000).cast("int").alias("season_id"))
    docs = m.groupBy("competition_id", "season_id").agg(F.collect_list(F.struct(F.col("match_id").alias("id"), "status")).alias("matches"))
    docs.write.partitionBy("competition_id", "season_id").json(f"{root}/raw")      # a thousand matches a file at most
    entry = F.struct("competition_id", "season_id", F.concat(F.lit("season "), F.col("season_id"), F.lit(" of "),
                                                             F.col("competition_id")).alias("season_name"))
    (m.select(entry.alias("e")).distinct().groupBy(F.floor(F.col("e.season_id") / PAGE).alias("page"))
     .agg(F.collect_list("e").alias("all_competitions")).select("all_competitions")
     .write.option("maxRecordsPerFile", 1).json(f"{root}/index"))
    logs = [ingest.season_index_ingest(spark, f"{root}/index", f"{root}/raw", c, f"{root}/store") for c in (16, 16, 11)]
    return logs[1].union(logs[2])


@register("publish_gold_readback", f"""
with {M}, {SEASON_SQL}
select row_number() over (order by {LEAGUE_ORDER}, {TEAM_ORDER}) as position, *, {RATIO_COLS},
       2 as succeeded, 1 as failed, false as overall
from season""")
def q_publish_gold_readback(spark, sf):
    """Marts exported and read back; a table that cannot be computed is
    logged as failed and the others go out."""
    root = scratch_table_path(spark)
    m = fx.matches(spark, sf)
    broken = m.select(F.raise_error(F.lit("not computable")).cast("int").alias("x"))
    log = ingest.publish_gold({"standings": gold.standings(m), "broken": broken, "team_form": gold.team_form(m)},
                              root, "2024-09-01")
    back = spark.read.parquet(f"{root}/standings/snapshot_date=2024-09-01").drop("gold_created_at")
    s = ingest.run_log_summary(log).first()
    return back.select("*", F.lit(s["succeeded"]).cast("int").alias("succeeded"), F.lit(s["failed"]).cast("int").alias("failed"),
                       F.lit(s["overall"]).alias("overall"))


PLAYER_DOCS = f"""
with {fx.fixture_ctes('players')},
placed as (select *, player_id // {PAGE} as page,
                  row_number() over (partition by player_id // {PAGE} order by player_id) as place from players)"""


def player_documents(spark, sf):
    root = scratch_table_path(spark)
    recs = fx.bronze_scorer_records(fx.players(spark, sf))
    cut_documents(recs, F.col("player.id"), "scorers", f"{root}/players",
                  {"ingestion_metadata": None})
    return bronze.read_documents(spark, f"{root}/players", BRONZE_PLAYERS_DOC, glob="*.txt")


@register("leading_scorers", f"""{PLAYER_DOCS}
select cast(place as integer) as place, coalesce(player_name, 'Unknown') as name,
       coalesce(team_name, 'Unknown') as team, coalesce(goals, 0) as goals
from placed where place <= 3""")
def q_leading_scorers(spark, sf):
    """The first three scorers of every document, in document order."""
    return bronze.leading_scorers(player_documents(spark, sf)).drop("source_blob").withColumn("name", F.trim("name"))


@register("snapshot_profile", f"""{PLAYER_DOCS}
select 'unknown' as ingested_at, 'unknown' as source, cast(count(*) as integer) as record_count,
       cast(min(player_id) as bigint) as first_player, cast(count(*) as integer) as counted
from placed group by page""")
def q_snapshot_profile(spark, sf):
    """Profile and record count of every document."""
    docs = player_documents(spark, sf)
    p = bronze.profile(docs, "scorers")
    n = bronze.record_counts(docs, "scorers").select("source_blob", F.col("record_count").alias("counted"))
    return p.join(n, "source_blob").select("ingested_at", "source", "record_count",
                                           F.get_json_object("first_record", "$.player.id").cast("long").alias("first_player"), "counted")


@register("sorted_standings_places", f"""
with {M}, {SEASON_SQL}
select row_number() over (order by {LEAGUE_ORDER}, {TEAM_ORDER}) as position,
       row_number() over (order by {LEAGUE_ORDER}, {TEAM_ORDER}) as place, team_id from season""")
def q_sorted_standings_places(spark, sf):
    """O1: the place of each row in the sorted output next to its position."""
    out = gold.standings(fx.matches(spark, sf), sort=True).withColumn("_at", F.monotonically_increasing_id())
    return rank_by(out.select("position", "team_id", "_at"), [F.col("_at")], "place").drop("_at")


@register("dq_rejected_values", """
select 'matches' as "table", 'no_rejected_values' as "check", 'FAIL' as severity,
       count_if(o_orderkey % 97 = 0) = 0 as passed, cast(count_if(o_orderkey % 97 = 0) as varchar) as value
from orders""")
def q_dq_rejected_values(spark, sf):
    """Ids beyond 32 bits are counted by the gate, not lost in silence."""
    from ..sources.tables import read_table
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("match_id"))
    base = fx.bronze_match_records(fx.matches(spark, sf))
    big = F.when(F.col("match_id") % 97 == 0, F.lit(3_000_000_000)).otherwise(F.col("match_id"))
    recs = o.select(*[(big if f.name == "id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in base.schema])
    return q.check_results(silver_matches(recs, count_rejects=True), "matches", [q.NO_REJECTS])


@register("publish_detects_loss", f"""
with {M}, {RECENT_SQL}, n as (select count(*) as n, count(*) filter (where team_id % 7 <> 0) as kept from recent)
select 'whole' as item, n as rows, true as ok from n
union all select 'lost', kept, n = kept from n
union all select 'altered', n, n = 0 from n""")
def q_publish_detects_loss(spark, sf):
    """K6: what is read back is held against what the writing job observed: a publication
    that loses rows, or changes them, is logged as failed."""
    root = scratch_table_path(spark)
    form = gold.team_form(fx.matches(spark, sf))

    def writer(df, path):
        if "/lost/" in path:
            df = df.where("team_id % 7 <> 0")
        if "/altered/" in path:
            df = df.withColumn("total_points", F.col("total_points") + 1)
        ingest.write_parquet(df, path)

    log = ingest.publish_gold({"whole": form, "lost": form, "altered": form}, root, "2024-09-01", writer=writer)
    return log.select("item", "rows", "ok")


@register("marts_swapped", f"""
with {M}, {SEASON_SQL}
select team_id, team_name, played, points, (select count(*) from matches where is_finished) as staged, true as swapped
from season""")
def q_marts_swapped(spark, sf):
    """A staging view, a mart built from it and read by name, then rebuilt from more
    rows and read again; its name always answers, first with the old mart, then with the new."""
    name = "mart_" + uuid.uuid4().hex[:12]
    layers.register_staging(spark, {f"stg_{name}": fx.matches(spark, sf)})
    staged = spark.table(f"stg_{name}")
    first = layers.materialize_mart(gold.standings_totals(staged.where("match_id % 2 = 0")), name)
    old = layers.read_table(spark, name).agg(F.sum("played").alias("n")).first()["n"]
    second = layers.materialize_mart(gold.standings_totals(staged), name)
    mart = layers.read_table(spark, name)
    new = mart.agg(F.sum("played").alias("n")).first()["n"]
    kept = layers.read_table(spark, first).agg(F.sum("played").alias("n")).first()["n"]
    finished = spark.table(f"stg_{name}").where("is_finished").count()
    swapped = first != second and kept == old and old <= new and new == 2 * finished
    return mart.select("team_id", "team_name", "played", "points", F.lit(finished).cast("long").alias("staged"), F.lit(swapped).alias("swapped"))


def exported_places(spark, mart: str, df) -> DataFrame:
    """Publish one mart in its order and number its rows as the part files hold them."""
    root = scratch_table_path(spark)
    log = ingest.publish_gold({mart: df}, root, "2024-09-01", orders=gold.EXPORT_ORDERS)
    ok = log.first()["ok"]
    back = layers.stored_places(spark, f"{root}/{mart}/snapshot_date=2024-09-01")
    return rank_by(back, [F.col("_file"), F.col("_row")], "place").withColumn("ok", F.lit(ok))


@register("team_form_exported", f"""
with {M}, {RECENT_SQL}
select team_id, points_last_5, row_number() over (
         order by points_last_5 desc, goals_scored_last_5 - goals_conceded_last_5 desc, team_id) as place, true as ok
from recent""")
def q_team_form_exported(spark, sf):
    """O2, K5: the form table's rows stand in order in the exported part files."""
    out = exported_places(spark, "team_form", gold.team_form(fx.matches(spark, sf), sort=True))
    return out.select("team_id", "points_last_5", "place", "ok")


@register("top_scorers_exported", f"""
with {MTP}, {PLAYERS_SQL}
select player_id, scorer_rank, scorer_rank as place, true as ok from ranked""")
def q_top_scorers_exported(spark, sf):
    """O3, K5: the scorers stand by rank in the exported part files."""
    out = exported_places(spark, "top_scorers", gold.top_scorers(players_silver(spark, sf), fx.teams(spark, sf), sort=True))
    return out.select("player_id", "scorer_rank", "place", "ok")


@register("gate_blocks_write", f"""
with {M}, n as (select count(*) as n, count(*) filter (where match_id % 50 = 0) as hit from matches)
select 'clean' as "table", false as blocked, n as rows from n
union all select 'odd_status', false, n from n
union all select 'repeated', n > 0, 0 from n
union all select 'undated', hit > 0, if(hit > 0, 0, n) from n""")
def q_gate_blocks_write(spark, sf):
    """A failing FAIL check leaves no output; a failing WARN check does not stop
    the write."""
    root = scratch_table_path(spark)
    flat = silver_matches(stored_input(fx.bronze_match_records(fx.matches(spark, sf))), count_rejects=True)
    some = F.col("match_id") % 50 == 0
    frames = {"clean": flat, "repeated": flat.unionAll(flat),
              "undated": flat.withColumn("match_date", F.when(~some, F.col("match_date"))),
              "odd_status": flat.withColumn("status", F.when(some, "ABANDONED").otherwise(F.col("status")))}
    out = []
    for table, df in frames.items():
        try:
            layers.write_silver(df, root, table, "2024-09-01", q.MATCH_CHECKS)
            blocked = False
        except q.QualityGateError:
            blocked = True
        stored = ingest.read_stored(spark, f"{root}/{table}", SILVER_MATCHES)
        out.append((table, blocked, 0 if stored is None else stored.count()))
    return spark.createDataFrame(out, "table string, blocked boolean, rows long")


@register("filtered_sample", f"""
with {M}, t as (select min(home_team_name) as name from matches)
select name as value, least(count(m.match_id), 5) as n_rows, true as all_hold from t left join matches m on m.home_team_name = t.name
group by name
union all select 'no such team', 0, true""")
def q_filtered_sample(spark, sf):
    """A sample of rows with a name, in no order: as many as there are, five at most,
    and all hold the name."""
    m = fx.matches(spark, sf)
    name = m.agg(F.min("home_team_name")).first()[0]
    parts = [dashboards.sample_where(m, "home_team_name", v, 5).agg(
        F.lit(v).alias("value"), F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(~F.col("home_team_name").eqNullSafe(v)) == 0).alias("all_hold")) for v in (name, "no such team")]
    return parts[0].unionAll(parts[1])


_FIELDS = [("id", "BIGINT", "team_id"), ("name", "STRING", "team_name"), ("founded", "BIGINT", "1880 + team_id % 100"),
           ("shortName", "STRING", "if(team_id % 5 = 0, '', team_short_name)"), ("clubColors", "STRING", "'Red / White'"),
           ("tla", "STRING", "if(team_id % 4 = 0, null, ' ' || lower(substr(area_name, 1, 3)) || ' ')"), ("venue", "STRING", "venue_name"),
           ("website", "STRING", "'club' || team_id || '.example'"), ("area.id", "BIGINT", "team_id % 25"),
           ("area.name", "STRING", "' ' || area_name || ' '"), ("area.code", "STRING", "lower(substr(area_name, 1, 3))")]


@register("snapshot_field_profile", f"""
with {fx.fixture_ctes('teams')}
""" + "\nunion all\n".join(
    [f"select '{p}' as path, '{t}' as types, count({x}) as records, 0 as nulls, min(cast({x} as varchar)) as sample from teams" for p, t, x in _FIELDS]
    + [f"select '{p}', '{t}', count(*), 0, null from teams" for p, t in (("area", "OBJECT"), ("runningCompetitions", "ARRAY"))]))
def q_snapshot_field_profile(spark, sf):
    """One row per field of the raw team records, nested ones by path: types, counts, sample."""
    root = scratch_table_path(spark)
    recs = fx.bronze_team_records(fx.teams(spark, sf))
    pages = recs.groupBy(F.floor(F.col("id") / PAGE).alias("p")).agg(F.collect_list(F.struct(*recs.columns)).alias("r"))
    bronze.write_pages(pages, f"{root}/teams", F.lit("2024-09-01_teams_season_2024"), F.col("r"), "teams")
    return bronze.field_profile(spark, f"{root}/teams", "teams").withColumn("nulls", F.col("nulls").cast("int"))
