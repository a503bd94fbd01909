"""Secret scans: a random forest decides which candidate strings are secrets.

Only DataFrame functions and the JVM forest of ``pyspark.ml`` run here.  A
candidate is what follows a named assignment, or a run of at least twelve key
characters (parts joined by full stops included) with a digit or sixteen capitals,
after any other character.  Its features are its length and character mix, how its
letter pairs compare with those of the corpus, how much of it the corpus
dictionary covers, path and template marks, and its neighbouring words.  A quoted
phrase after a named assignment is one candidate.  The forest learns from labelled
findings: those that the caller gives, else the judged ones of ``judged_forms``,
whose labels come from their forms and not from the features.  No finding of the
scanned documents is labelled by a rule; the forest decides them all.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialise, text_of
from .judged_forms import judged_documents

NAMES = r"(?i)(passw|token|secret|api.?key|access.?key|auth|credential|private)"
KEY = r"[A-Za-z0-9_+/\-]"
FORMATS = (r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abp]-[0-9A-Za-z-]{20,}|SG\.[\w\-]{16,}\.[\w\-]{16,}"
           r"|eyJ[\w\-]{5,}\.[\w\-]{2,}\.[\w\-]{5,}")
PROVIDER = f"^({FORMATS})$"
# a run of key characters, after the word's start or any other character
RUN = (f"(?<!{KEY})(?={KEY})(?:(?:{FORMATS})(?!{KEY})|" r"(?:(?=[A-Za-z_+/\-]*[0-9]|[A-Z]{16})"
       f"{KEY}{{12,}}(?:\\.{KEY}{{12,}}){{0,8}}|" r"(?=[A-Za-z_+/\-.]{0,200}[0-9])"
       f"{KEY}+(?:\\.{KEY}{{12,}}){{1,8}})={{0,2}})")
# a name, what may stand between, and the sign of assignment; "author" and "secretary" are other names
SIGN = "(?:=>|:=|[=:]{1,2})"
NAMED = (r"(?:(?i:passw|token|secret(?!ar)|api.?key|access.?key|auth(?!or(?!i))|credential|private))"
          r"""[A-Za-z0-9_\-]{0,40}\\?["'`\])]{0,3}""")
ASSIGN = NAMED + SIGN
# an unquoted value ends before the next name of a list and before a tag
PLAIN = (r"""(?:(?!["'`](?![A-Za-z0-9])|<(?=/?[A-Za-z])|[&,;](?=["'`]?[A-Za-z_][\w.\-]{0,40}["'`]?[=:]))\S)""")
ENDS = r"""(?<![.,;:)\]}>\\*|])"""


def _assigned(before: str) -> str:
    """The value after ``before`` (of bounded length), whatever its letters and marks."""
    quoted = [rf"(?<={before}\\{{0,1}}{q})(?:(?!\\?{q})\S){{6,}}" for q in "\"'`"]
    return "|".join([*quoted, f"(?<={before})(?![=:>\\\\\"'`]){PLAIN}{{6,}}{ENDS}"])


VALUE = f"(?:{_assigned(ASSIGN)}|{RUN})"
FIRST = f"(?:{_assigned('^')}|{RUN})"     # in the word after a named assignment
# a quoted phrase with blanks after a named assignment, on one line
PHRASE = NAMED + "[ \\t]{0,3}" + SIGN + r"""[ \t]{0,3}\\?(?:"[^"\n]*+"|'[^'\n]*+'|`[^`\n]*+`)"""
BLANKS = r"[\x20\x09-\x0D]+"
TEMPLATE = r"(?i)\$\{|\$\(|\{\{|%\(|^[<\[]|[(\[]|\benv\b|environ|getenv|process\."
STAND_IN = r"(?i)your|example|change.?me|placeholder|dummy|sample|insert|redacted|xxx|\*{3}|_here|todo"
DIGEST = r"(?i)\b(sha-?\d+|md5|digest|checksum|commit|checkout|integrity|etag|revision|uuid|guid|base64)"
UUID = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
SCHEMES = ["bearer", "digest", "negotiate"]   # "Authorization: Bearer x" assigns x
# a name that says something about a secret: its name, place, kind or length
ABOUT = r"(?i)[_-]?(name|file|path|dir|url|uri|host|type|header|field|ttl|length|len|expir[a-z]*|count|size|version|id)[\"'`\])]{0,3}[=:]"
MIN_WORD_COUNT = 5      # a dictionary word occurs at least this often in the corpus
TRAIN_ROWS = 20_000     # labelled findings used to fit the forest
TREES, DEPTH = 40, 10
SUBSET = "0.5"          # features tried at a node: a mark that settles a finding is rare among them
FLOOR = math.log(1e-6)
MASK = "[SECRET]"

FEATURES = ["len", "digits", "upper", "runs", "entropy", "transition", "dictionary", "slashes", "path",
            "assigned", "named", "quoted", "provider", "template", "stand_in", "digest", "uuid", "about", "bearer", "phrase", "password"]


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _phrases(t: Column) -> Column:
    """``value, position, n, word`` of the quoted phrases: the words between the quotes, the
    first word's place, their number, and the assignment with them."""
    quote = t.contains('"') | t.contains("'") | t.contains("`")
    found = F.when(quote & t.rlike(PHRASE), F.regexp_extract_all(t, F.lit(PHRASE), F.lit(0))).otherwise(F.array().cast("array<string>"))
    inner = lambda m: F.rtrim(F.regexp_extract(m, r"""[=:>][ \t]{0,3}\\?(["'`])(.*?)\\?\1$""", 2))
    kept = F.filter(F.array_distinct(found), lambda m: F.length(inner(m)).__ge__(6) & F.trim(inner(m)).rlike(r"[\x20\x09]"))
    ahead = lambda m: F.substring(t, F.lit(1), F.instr(t, m) + F.length(m) - 1 - F.length(F.regexp_extract(m, r"""[=:>][ \t]{0,3}(\\?["'`].*)$""", 1)))
    return F.transform(kept, lambda m: F.struct(
        inner(m).alias("value"), (F.size(F.split(ahead(m), BLANKS)) - 1).alias("position"),
        F.size(F.split(inner(m), BLANKS)).alias("n"), m.alias("word")))


def find_candidates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, thash, position, part, value, word, before, before2, after`` of all candidates.

    A quoted phrase has part -1 and the position of its first word; equal phrases of
    one text are one candidate, and its words are none."""
    base = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("t"))
            .where(F.col("t").contains("=") | F.col("t").contains(":") | F.col("t").rlike("[0-9]|[A-Z]{16}"))
            .select("doc_id", F.xxhash64("t").alias("thash"), F.split("t", BLANKS).alias("ws"), _phrases(F.col("t")).alias("ps")))
    hits = base.select("doc_id", "thash", "ps", F.expr(
        "transform(filter(transform(zip_with(ws, concat(array(''), ws), (w, b) -> struct(w as word, b as before)), "
        "(x, i) -> struct(x.word as word, i as position, x.before as before)), s -> length(s.word) >= 6 and ("
        f"length(s.word) >= 12 and s.word rlike '[0-9]|[A-Z]{{16}}' and s.word rlike {_sql(RUN)} "
        f"or (contains(s.word, '=') or contains(s.word, ':')) and s.word rlike {_sql(ASSIGN)} "
        "or endswith(s.before, '=') or endswith(s.before, ':') or endswith(s.before, '=>'))), "
        "s -> struct(s.position as position, s.word as word, s.before as before, "
        "coalesce(get(ws, s.position - 2), '') as before2, coalesce(get(ws, s.position + 1), '') as after))").alias("hits"))
    one = (hits.select("doc_id", "thash", "ps", F.explode("hits").alias("h")).select("doc_id", "thash", "ps", "h.*")
           .where("not exists(ps, p -> position >= p.position and position < p.position + p.n)"))
    left = F.concat(F.when(F.col("before").rlike("^[=:>]+$"), F.col("before2")).otherwise(""), "before")
    taken = lambda pattern: F.regexp_extract_all("word", F.lit(pattern), F.lit(0))
    values = F.when(F.col("word").rlike(ASSIGN), taken(VALUE)).when(left.rlike(f"{ASSIGN}$"), taken(FIRST)).otherwise(taken(RUN))
    found = one.select("doc_id", "thash", "position", F.posexplode(values).alias("part", "value"), "word", "before", "before2", "after")
    whole = hits.select("doc_id", "thash", F.explode("ps").alias("p")).select(
        "doc_id", "thash", F.col("p.position").alias("position"), F.lit(-1).alias("part"), F.col("p.value").alias("value"),
        F.col("p.word").alias("word"), F.lit("").alias("before"), F.lit("").alias("before2"), F.lit("").alias("after"))
    return found.where(~F.lower("value").isin(SCHEMES)).union(whole)


def dictionary(docs: DataFrame, text_col: str = "text", min_count: int = MIN_WORD_COUNT) -> DataFrame:
    """Words (letters only, lower case, three or more) that the corpus repeats."""
    return (docs.select(F.explode(F.split(F.lower(text_of(text_col)), "[^a-z]+")).alias("w")).where("length(w) >= 3")
            .groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def transitions(words: DataFrame) -> DataFrame:
    """``pair, logp``: letter transitions of the dictionary, 26 * 26 rows at most."""
    pairs = words.select("n", F.explode(F.expr("transform(sequence(1, length(w) - 1), i -> substring(w, i, 2))")).alias("pair"))
    got = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    total = got.groupBy(F.substring("pair", 1, 1).alias("a")).agg(F.sum("n").alias("t"))
    return (got.join(F.broadcast(total), F.substring("pair", 1, 1) == F.col("a"))
            .select("pair", F.log(F.col("n") / F.col("t")).alias("logp")))


def _share(value: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(value, drop, "")) / F.length(value)


def value_features(values: DataFrame, words: DataFrame) -> DataFrame:
    """Per distinct ``value``: transition and dictionary features."""
    moves = transitions(words)
    pairs = values.select("value", F.explode(F.expr(
        "transform(sequence(1, length(value) - 1), i -> lower(substring(value, i, 2)))")).alias("pair"))
    moved = (pairs.join(F.broadcast(moves), "pair", "left").groupBy("value")
             .agg(F.avg(F.coalesce("logp", F.lit(FLOOR))).alias("transition")))
    runs = values.select("value", F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("w")).where("length(w) >= 3")
    covered = runs.join(words, "w").groupBy("value").agg(F.sum(F.length("w")).alias("covered"))
    return (values.join(moved, "value", "left").join(covered, "value", "left")
            .select("value", F.coalesce("transition", F.lit(FLOOR)).alias("transition"),
                    (F.coalesce("covered", F.lit(0)) / F.length("value")).alias("dictionary")))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the feature columns."""
    v = F.col("value")
    entropy = F.expr("aggregate(transform(array_distinct(split(value, '')), "
                     "c -> length(value) - length(replace(value, c, ''))), 0D, "
                     "(s, k) -> s - (k / length(value)) * log2(k / length(value)))")
    ahead = F.concat_ws(" ", "before2", "before", "word")
    named = F.concat_ws(" ", "before2", "before", F.regexp_extract("word", r"^([^=:]*)[=:]", 1)).rlike(NAMES)
    named = named | F.col("word").rlike(ASSIGN)
    assigned = F.col("word").rlike(r"[=:]") | F.col("before").rlike(r"[=:]>?$")
    flag = lambda c: c.cast("double")
    known = value_features(found.select("value").distinct(), words)
    return found.join(known, "value").withColumns({
        "len": F.length(v).cast("double"), "digits": _share(v, "[^0-9]"), "upper": _share(v, "[^A-Z]"),
        "runs": F.length(F.regexp_replace(v, "[0-9]+|[A-Z]+|[a-z]+|[^0-9A-Za-z]+", "x")) / F.length(v),
        "entropy": entropy, "slashes": _share(v, "[^/]"), "path": flag(F.col("word").rlike(r"^(/|\./|[a-z]+://)")),
        "assigned": flag(assigned), "named": flag(named), "quoted": flag(F.col("word").rlike("""["']""")),
        "provider": flag(v.rlike(PROVIDER)), "template": flag(v.rlike(TEMPLATE) | F.col("word").rlike(r"\$\{|\$\(|\{\{|environ|getenv|process\.")),
        "stand_in": flag(v.rlike(STAND_IN)), "digest": flag(ahead.rlike(DIGEST)), "uuid": flag(v.rlike(UUID)),
        "about": flag(ahead.rlike(ABOUT)), "bearer": flag(F.col("before").rlike("(?i)^.{0,20}(bearer|basic)$")),
        "phrase": flag(v.rlike(BLANKS)), "password": flag(ahead.rlike("(?i)passw"))})


def judged_findings(docs: DataFrame, words: DataFrame, keep=lambda form: True) -> DataFrame:
    """The candidates of the judged forms that ``keep`` takes, with their features and ``label``."""
    judged = judged_documents(docs.sparkSession, keep).withColumn("thash", F.xxhash64("text"))
    found = features(materialise(find_candidates(judged), "judged"), words)
    return found.join(judged.select("doc_id", "label"), "doc_id")


def fit_forest(labelled: DataFrame):
    """The forest over at most ``TRAIN_ROWS`` distinct labelled feature rows, or None with one class only."""
    train = (labelled.where("label is not null").select("label", *FEATURES).distinct()
             .orderBy(F.xxhash64("label", *FEATURES)).limit(TRAIN_ROWS))
    train = materialise(train, "labelled_findings")
    if train.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy=SUBSET,
                                  seed=7).fit(_vectors(train))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)


def score_findings(found: DataFrame, forest) -> DataFrame:
    return forest.transform(_vectors(found)).withColumn("score", vector_to_array("probability")[1])


def scan_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", labelled: DataFrame | None = None,
                 threshold: float = 0.5) -> DataFrame:
    """Every candidate with ``score`` and ``is_secret``: ``doc_id, thash, position, part, value, score, is_secret``.

    ``labelled`` may hold ``value, label`` of judged findings of these documents; without
    it, or where it has one class only, the built-in judged findings teach the forest.
    Null and empty texts have no candidates; long texts are read whole; a row without an
    id keeps its findings under a null id; repeated rows repeat theirs; equal candidates in
    equal surroundings get equal scores; other columns are ignored, whatever their names;
    an empty table gives no rows."""
    found = materialise(find_candidates(docs, text_col, id_col), "candidates")
    words = materialise(dictionary(docs, text_col), "dictionary")
    data = materialise(features(found, words), "findings")
    forest = None
    if labelled is not None:
        given = labelled.groupBy("value").agg(F.max(F.col("label").cast("double")).alias("label"))
        forest = fit_forest(data.join(given, "value"))
    if forest is None:
        forest = fit_forest(judged_findings(docs, words))
    keep = ["doc_id", "thash", "position", "part", "value", "score"]
    return score_findings(data, forest).select(*keep, (F.col("score") >= threshold).alias("is_secret"))


def mask_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with confirmed secrets replaced by a mark; no row goes.

    ``count_col``, if present, is set to the masked text's length in changed rows.  Null and
    empty texts stay; rows that repeat id and text are masked alike; whatever the names of the
    other columns, they come back unchanged; an empty table stays empty."""
    text = text_of(text_col)
    values, sid, shash, row, thash, done = free_names(docs, "values", "sid", "shash", "id", "thash", "masked")
    secrets = (scan_secrets(docs, text_col, id_col).where("is_secret").groupBy("doc_id", "thash")
               .agg(F.collect_set("value").alias(values)).withColumnsRenamed({"doc_id": sid, "thash": shash}))
    keyed = docs.withColumns({row: F.col(f"`{id_col}`").cast("long"), thash: F.xxhash64(text)})
    cond = F.col(row).eqNullSafe(F.col(sid)) & (F.col(thash) == F.col(shash))
    masked = F.expr(f"aggregate(array_sort(`{values}`, (a, b) -> length(b) - length(a)), `{text_col}`, "
                    f"(t, v) -> replace(t, v, '{MASK}'))")
    joined = keyed.join(secrets, cond, "left").withColumn(done, F.when(F.col(values).isNotNull(), masked))
    out = []
    for f in docs.schema:
        c = F.col(f"`{f.name}`")
        if f.name == text_col:
            c = F.coalesce(F.col(done), c)
        elif f.name == count_col:
            c = F.when(F.col(done).isNotNull(), F.length(done).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return joined.select(*out)
