"""Bronze snapshot sources.

A Bronze snapshot is one JSON document: a record array plus an ingestion
metadata block.  Documents are read with a *declared* schema (never
inferred), one row per document, then the array is exploded to one row per
record.  Pretty-printed documents need ``multiLine`` and so are read one task
per file; ``to_record_layout`` rewrites them once into record-per-row Parquet
partitioned by snapshot date and season, which later reads split and prune.

A snapshot is the set of files of one date and season, one document or many pages:
``<date>_<what>_season_<n>.json``, or any files in a folder of such a name (written
by tasks with ``write_pages``).  Selection lists files; one date per season reaches the
driver, and a filter on the scan's ``_metadata`` then prunes the other files.

Documents that cannot be read never vanish: readers raise, or mark them (``problem``)
when asked to quarantine, and ``document_log`` holds the listing against what was parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COMPETITION_SEASON, INGESTION_METADATA

# File names start with the ISO date: <date>_<what>_season_<n>.json
DATE_IN_NAME = r"^(\d{4}-\d{2}-\d{2})"
SEASON_IN_NAME = r"season_?(\d+)"
# The same in a path: in the file's name, else in its folder's name (also as ``column=name``).
DATE_IN_PATH = r"/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]*)?$"
SEASON_IN_PATH = r"season_?(\d+)[^/]*(?:/[^/]*)?$"

RAISE, QUARANTINE = "raise", "quarantine"
PROBLEM, CORRUPT = "problem", "_corrupt_record"


def with_corrupt(doc_schema: T.StructType) -> T.StructType:
    return T.StructType([*doc_schema.fields, T.StructField(CORRUPT, T.StringType())])


def mark_damage(docs: DataFrame, doc_schema: T.StructType, on_damage: str = RAISE) -> DataFrame:
    """Handle documents that could not be parsed.

    Damaged means: not JSON, cut off, or not of the declared shape at its top (the first
    field of ``doc_schema``, the record array).  A mistyped value inside a record is a null
    that the gate counts, not damage.  ``raise``: reading such a document fails, naming it;
    ``quarantine``: its row stays, without records, with ``problem`` set."""
    if on_damage not in (RAISE, QUARANTINE):
        raise ValueError(f"on_damage is {RAISE!r} or {QUARANTINE!r}, not {on_damage!r}")
    first = doc_schema.fields[0]
    # the parser also notes a document for one mistyped value: those are parsed again without types
    loose = T.StructType([T.StructField(first.name, T.ArrayType(T.StructType([]))), T.StructField(CORRUPT, T.StringType())])
    again = F.from_json(F.col(CORRUPT), loose, {"columnNameOfCorruptRecord": CORRUPT})
    broken = F.col(CORRUPT).isNotNull() & (F.col(f"`{first.name}`").isNull() | again[CORRUPT].isNotNull())
    if on_damage == RAISE:
        stop = F.raise_error(F.concat(F.lit("unreadable document: "), F.col("source_blob"))).cast("boolean")
        return docs.where(F.when(broken, stop).otherwise(True)).drop(CORRUPT)
    found = docs.withColumn(PROBLEM, F.when(broken, F.lit("unreadable")))
    kept = [F.when(F.col(PROBLEM).isNull(), F.col(f"`{f.name}`")).alias(f.name) for f in doc_schema.fields]
    rest = [F.col(f"`{c}`") for c in found.columns if c not in set(doc_schema.names) | {CORRUPT}]
    return found.select(*kept, *rest)


def read_documents(spark: SparkSession, paths: str | Sequence[str], doc_schema: T.StructType,
                   glob: str = "*.json", on_damage: str = RAISE) -> DataFrame:
    """S1 + S2 + S9: one row per document under ``paths`` (prefix folders or
    files), with ``source_blob`` (full path) and ``file_name``.  Only files
    matching ``glob`` are read; nested folders are searched.  Documents that
    cannot be parsed raise or are marked (``mark_damage``); files without any
    content have no row here and are found by ``document_log``."""
    reader = (spark.read.schema(with_corrupt(doc_schema)).option("multiLine", True)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", True))
    docs = reader.json(list(paths) if not isinstance(paths, str) else paths)
    return mark_damage(docs.select("*", F.col("_metadata.file_path").alias("source_blob"),
                                   F.col("_metadata.file_name").alias("file_name")), doc_schema, on_damage)


def empty_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``source_blob`` of the files without a byte among those that ``files`` (a load of a file
    source) lists.

    Spark's file sources keep such files in their listing but give no row for them, so the
    listing is held against the rows; the paths stay in the JVM and are compared by a join."""
    session, jvm = spark._jsparkSession, spark.sparkContext._jvm
    paths = session.createDataset(jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles()),
                                  jvm.org.apache.spark.sql.Encoders.STRING()).toDF()
    found = files.select(F.col("_metadata.file_path").alias("found"))
    bare = lambda c: F.regexp_replace(c, "^([^:/]+):/+", "$1:/")  # noqa: E731  (file:/x and file:///x are one path)
    return DataFrame(paths, spark).toDF("source_blob").join(found, bare("source_blob") == bare("found"), "left_anti")


def list_snapshots(spark: SparkSession, prefix: str, glob: str = "*.json") -> DataFrame:
    """Snapshot files under ``prefix`` (path, file name, parsed date and
    season, size, modification time) without reading their contents: only the
    ``binaryFile`` source's metadata columns are selected, so the content
    column is pruned.  Files without content are listed too."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", True).load(prefix))
    files = listed.select(F.col("_metadata.file_path").alias("source_blob"), F.col("_metadata.file_name").alias("file_name"),
                          F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    empty = empty_files(spark, listed)
    files = files.unionByName(empty.select("source_blob", F.substring_index("source_blob", "/", -1).alias("file_name"),
                                           F.lit(0).cast("long").alias("bytes"), F.lit(None).cast("timestamp").alias("modified")))
    return with_snapshot_keys(files)


def document_log(spark: SparkSession, prefix: str, array_field: str, glob: str = "*.json",
                 snapshots: Sequence[tuple] | None = None) -> DataFrame:
    """One row per listed file: ``source_blob, file_name, bytes, modified,
    snapshot_date, season, documents, records, problem``.

    The listing is held against what a parse of the same files finds: ``unreadable`` (not
    JSON, cut off, or ``array_field`` is no array), ``empty`` (no document in it), null for a
    readable file.  The parse skips the values inside records.  ``snapshots``: only these
    (date, season) pairs, pruned by file name."""
    schema = T.StructType([T.StructField(array_field, T.ArrayType(T.StructType([]))), T.StructField(CORRUPT, T.StringType())])
    docs = (spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", glob).option("recursiveFileLookup", True).json(prefix))
    listed = list_snapshots(spark, prefix, glob)
    if snapshots is not None:
        docs, listed = docs.where(in_snapshots(F.col("_metadata.file_path"), snapshots)), listed.where(
            in_snapshots(F.col("source_blob"), snapshots))
    n = F.when(F.col(CORRUPT).isNotNull(), -1).otherwise(F.greatest(F.size(array_field), F.lit(0)))
    parsed = (docs.select(F.col("_metadata.file_path").alias("_path"), n.alias("n")).groupBy("_path")
              .agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("records"), F.min("n").alias("least")))
    joined = listed.join(parsed, F.col("source_blob") == F.col("_path"), "left")
    return joined.select(
        *listed.columns, F.coalesce("documents", F.lit(0)).alias("documents"),
        F.when(F.col("least") >= 0, F.col("records")).otherwise(0).alias("records"),
        F.when(F.col("documents").isNull(), "empty").when(F.col("least") < 0, "unreadable").alias(PROBLEM))


def metadata(docs: DataFrame) -> Column:
    """Ingestion metadata under either key spelling."""
    fields = set(docs.columns)
    cands = [F.col(k) for k in ("_ingestion_metadata", "ingestion_metadata") if k in fields]
    return F.coalesce(*cands) if cands else F.lit(None).cast(INGESTION_METADATA)


def snapshot_keys(path: Column) -> tuple[Column, Column]:
    """Date and season of the snapshot that a file belongs to, from its name or
    its folder's name (null when absent)."""
    d, s = F.regexp_extract(path, DATE_IN_PATH, 1), F.regexp_extract(path, SEASON_IN_PATH, 1)
    return F.try_to_date(F.nullif(d, F.lit(""))), F.nullif(s, F.lit("")).try_cast("int")


def with_snapshot_keys(docs: DataFrame) -> DataFrame:
    """``snapshot_date`` and ``season`` of every document (null when absent)."""
    day, season = snapshot_keys(F.col("source_blob"))
    return docs.withColumns({"snapshot_date": day, "season": season})


def in_snapshots(path: Column, snapshots: Sequence[tuple]) -> Column:
    """Whether a file belongs to one of the (date, season) pairs; over ``_metadata.file_path``
    this prunes files before they are opened."""
    day, season = snapshot_keys(path)
    key = F.concat_ws("/", F.coalesce(day.cast("string"), F.lit("none")), F.coalesce(season.cast("string"), F.lit("none")))
    return key.isin([f"{'none' if d is None else d}/{'none' if s is None else s}" for d, s in snapshots])


def latest_snapshot(df: DataFrame, snapshot_col: str, by: Sequence[str] = ()) -> DataFrame:
    """S3: rows of the newest snapshot (overall, or per ``by`` key, R3).

    Overall: a scalar subquery (one tiny job) compared in a filter, which
    also prunes partitions when ``snapshot_col`` is a partition column.
    Per key: a semi-join against the per-key maximum (pre-aggregated)."""
    if not by:
        newest = df.select(F.max(snapshot_col)).scalar()
        return df.filter(F.col(snapshot_col) == newest)
    newest = df.groupBy(*by).agg(F.max(snapshot_col).alias("_newest"))
    cond = [df[k].eqNullSafe(newest[k]) for k in by] + [df[snapshot_col] == newest["_newest"]]
    return df.join(newest, cond, "left_semi")


def newest_snapshots(spark: SparkSession, prefix: str, per_season: bool = False, glob: str = "*.json") -> list[tuple]:
    """S3: the newest snapshot found by listing, as a (date, season) pair (of equal dates the
    later season), or with ``per_season`` each season's newest; one pair per season reaches
    the driver.  A newest snapshot of empty files is still the newest."""
    snaps = list_snapshots(spark, prefix, glob)
    if not per_season:
        best = snaps.agg(F.max(F.struct("snapshot_date", "season")).alias("k")).first()["k"]
        return [] if best is None else [tuple(best)]
    found = snaps.groupBy("season").agg(F.max("snapshot_date").alias("d")).select("d", "season").collect()
    return sorted((tuple(r) for r in found), key=lambda k: (k[1] is None, k[1] or 0))


def read_snapshots(spark: SparkSession, prefix: str, snapshots: Sequence[tuple], doc_schema: T.StructType,
                   glob: str = "*.json", on_damage: str = RAISE) -> DataFrame:
    """All documents (pages) of the given snapshots; files of others are not opened."""
    docs = read_documents(spark, prefix, doc_schema, glob, on_damage)
    return docs.where(in_snapshots(F.col("source_blob"), snapshots))


def write_pages(pages: DataFrame, root: str, snapshot: Column, records: Column, array_field: str) -> None:
    """Write documents of bounded size as pages of dated snapshots: every row of ``pages``
    becomes one JSON file in the folder named by ``snapshot`` (``<date>_<what>_season_<n>``).
    The tasks write the final names; no file is moved on the driver."""
    (pages.select(snapshot.alias("snapshot"), records.alias(array_field)).write.mode("append")
     .partitionBy("snapshot").option("maxRecordsPerFile", 1).json(root))


def latest_documents(docs: DataFrame, per_season: bool = False) -> DataFrame:
    """Documents of the newest snapshot (by date, then season), or of each season's: all its pages."""
    keyed = with_snapshot_keys(docs)
    if per_season:
        return latest_snapshot(keyed, "snapshot_date", ["season"])
    newest = keyed.select(F.max(F.struct("snapshot_date", "season"))).scalar()
    return keyed.filter(F.struct("snapshot_date", "season").eqNullSafe(newest))


def records(docs: DataFrame, array_field: str, keep: Sequence[str] = ("source_blob",)) -> DataFrame:
    """Explode the record array: one row per record, its fields as columns.
    A missing or empty array yields no rows (the reference's ``.get(.., [])``)."""
    return docs.select(*keep, F.inline(F.col(array_field)))


def record_counts(docs: DataFrame, array_field: str, keep: Sequence[str] = ()) -> DataFrame:
    """B2: records per document (missing array counts 0)."""
    return docs.select("source_blob", *keep, F.greatest(F.coalesce(F.size(array_field), F.lit(0)), F.lit(0))
                       .alias("record_count"))


def profile(docs: DataFrame, array_field: str) -> DataFrame:
    """Snapshot profile per document: ingested_at / source with default
    'unknown', the record count, and the first record as JSON (the field
    types are the declared schema, ``docs.schema``)."""
    meta = metadata(docs)
    return docs.select(
        "source_blob",
        F.coalesce(meta["ingested_at"], F.lit("unknown")).alias("ingested_at"),
        F.coalesce(meta["source"], F.lit("unknown")).alias("source"),
        F.greatest(F.coalesce(F.size(array_field), F.lit(0)), F.lit(0)).alias("record_count"),
        F.to_json(F.get(F.col(array_field), 0)).alias("first_record"))


def field_profile(spark: SparkSession, prefix: str, array_field: str, glob: str = "*.json", depth: int = 3) -> DataFrame:
    """One row per field of the raw records, nested ones by their path (``area.id``),
    whatever the declared schema says: ``path, types`` (JSON types observed, comma-joined),
    ``records`` (where the field is present), ``nulls`` and ``sample`` (the least value's first 70
    characters; none for objects and arrays).

    Records are read as variants and unfolded level by level, ``depth`` levels deep; only
    one row per path and type is shuffled."""
    docs = (spark.read.schema(f"`{array_field}` array<variant>").option("multiLine", True)
            .option("pathGlobFilter", glob).option("recursiveFileLookup", True).json(prefix))
    level = docs.select(F.lit(None).cast("string").alias("path"), F.explode(array_field).alias("v"))
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    found = None
    for _ in range(depth):
        fields = spark.sql("select concat_ws('.', t.path, e.key) as path, e.value as v from {t} as t, lateral variant_explode(t.v) as e "
                           "where e.key is not null", t=level)
        shown = F.when(kind.isin("OBJECT", "ARRAY", "VOID"), F.lit(None)).otherwise(F.expr("try_variant_get(v, '$', 'string')"))
        rows = fields.select("path", kind.alias("type"), shown.alias("value"))
        found = rows if found is None else found.unionAll(rows)
        level = fields.where(kind == "OBJECT")
    by_type = found.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("sample"))
    return by_type.groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_list("type")), ",").alias("types"), F.sum("n").alias("records"),
        F.coalesce(F.sum(F.when(F.col("type") == "VOID", F.col("n"))), F.lit(0)).alias("nulls"),
        F.substring(F.min("sample"), 1, 70).alias("sample"))


def read_competition_index(spark: SparkSession, path: str) -> DataFrame:
    """Competition index written wrapped (``{"all_competitions": [...]}``)
    or as a bare top-level list, in one file or several.  The text is parsed by
    ``from_json`` with both shapes declared; whichever matches is exploded.  An
    index that is neither raises."""
    arr = T.ArrayType(COMPETITION_SEASON)
    wrapped = T.StructType([T.StructField("all_competitions", arr)])
    txt = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_blob"))
    entries = F.coalesce(F.from_json("value", wrapped)["all_competitions"],
                         F.from_json("value", arr))
    stop = F.raise_error(F.concat(F.lit("unreadable index: "), F.col("source_blob"))).cast("boolean")
    return (txt.select(entries.alias("entries"), "source_blob")
            .where(F.when(F.col("entries").isNull(), stop).otherwise(True)).select(F.inline("entries")))


def filter_competition(index: DataFrame, competition_id: int) -> DataFrame:
    """B1: keep one competition's seasons."""
    return index.filter(F.col("competition_id") == F.lit(competition_id))


# <competition>/<season>.json, or any file of a folder competition_id=<c>/season_id=<s>
SEASON_FILE = r"/(?:competition_id=)?(\d+)/(?:season_id=)?(\d+)(?:/[^/]*)?\.json$"


def season_file_keys(path: Column) -> list[Column]:
    return [F.nullif(F.regexp_extract(path, SEASON_FILE, i), F.lit("")).try_cast("int").alias(n)
            for i, n in ((1, "competition_id"), (2, "season_id"))]


def list_season_files(spark: SparkSession, matches_root: str) -> DataFrame:
    """S2 for season files: path, size and both ids, from the listing alone
    (contents are not read; files without content are listed)."""
    files = list_snapshots(spark, matches_root)
    return files.select("source_blob", "bytes", *season_file_keys(F.col("source_blob")))


def read_season_matches(spark: SparkSession, matches_root: str, competition_id: int | None = None,
                        on_damage: str = RAISE) -> DataFrame:
    """Per-season match lists (array ``matches`` of opaque records, or a bare
    array) in one scan of ``matches_root``; competition and season come from the
    path and every record is kept as raw JSON text.  With ``competition_id`` the
    files of others are pruned by their path.

    A file that holds neither shape raises, or with ``quarantine`` gives one row
    with its ``problem`` and no record.  Files without content have no row here:
    ``list_season_files`` names them with zero bytes."""
    arr = T.ArrayType(T.StringType())
    wrapped = T.StructType([T.StructField("matches", arr), T.StructField(CORRUPT, T.StringType())])
    txt = (spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
           .text(matches_root, wholetext=True))
    if competition_id is not None:
        txt = txt.where(season_file_keys(F.col("_metadata.file_path"))[0] == F.lit(competition_id))
    # a file cut off behind its array still parses in part: it is damaged as a whole
    whole = F.from_json("value", wrapped, {"columnNameOfCorruptRecord": CORRUPT})
    docs = txt.select("value", F.col("_metadata.file_path").alias("source_blob"), whole.alias("w")).select(
        "source_blob", F.coalesce(F.when(F.col("w")[CORRUPT].isNull(), F.col("w.matches")),
                                  F.from_json("value", arr)).alias("entries"))
    keys = season_file_keys(F.col("source_blob"))
    if on_damage == QUARANTINE:
        return docs.select(*keys, "source_blob", F.when(F.col("entries").isNull(), "unreadable").alias(PROBLEM),
                           F.explode_outer("entries").alias("match_json")).where(F.col(PROBLEM).isNotNull()
                                                                                 | F.col("match_json").isNotNull())
    stop = F.raise_error(F.concat(F.lit("unreadable season file: "), F.col("source_blob"))).cast("boolean")
    docs = docs.where(F.when(F.col("entries").isNull(), stop).otherwise(True))
    return docs.select(*keys, "source_blob", F.explode("entries").alias("match_json"))


def to_record_layout(records_df: DataFrame, out_path: str,
                     partition_cols: Sequence[str] = ("snapshot_date", "season")) -> None:
    """Rewrite exploded records as Parquet partitioned by snapshot and season
    (dynamic partition overwrite: only the partitions present are replaced)."""
    (records_df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).option("compression", "snappy").parquet(out_path))


def leading_records(docs: DataFrame, array_field: str, k: int = 3) -> DataFrame:
    """The first ``k`` records of each document in source order, with
    their position (``posexplode`` keeps array order; no sort, no shuffle)."""
    return (docs.select("source_blob", F.posexplode(array_field).alias("pos", "rec"))
            .filter(F.col("pos") < k).select("source_blob", "pos", "rec.*"))


def leading_scorers(docs: DataFrame, k: int = 3) -> DataFrame:
    """B3 for scorer documents: name and team default to 'Unknown', goals to 0."""
    lead = leading_records(docs, "scorers", k)
    return lead.select(
        "source_blob", (F.col("pos") + 1).alias("place"),
        F.coalesce(F.col("player.name"), F.lit("Unknown")).alias("name"),
        F.coalesce(F.col("team.name"), F.lit("Unknown")).alias("team"),
        F.coalesce(F.col("goals"), F.lit(0)).alias("goals"))
