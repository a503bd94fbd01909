"""Data-quality gate (C6, Q1-Q13) and declarative column tests.

The reference runs one Spark job per check and recomputes the plan each time.
Here every scalar check of a table is one aggregate expression inside a
single ``agg``: one pass, partial aggregation on each task, one row back.
The result is a DataFrame ``(table, check, severity, passed, value)``; only
that small, bounded result reaches the driver, when ``enforce`` raises on a
failed FAIL-severity check before anything is written.

Declarative tests are specs as data; each yields ``(model, test, column,
failures)`` where ``failures`` counts what the test would return as failing
rows.  Uniqueness and foreign-key tests pre-aggregate by key first, so a hot
key is collapsed map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import REJECTED, indicator
from ..schemas import CHECK_RESULT, TEST_RESULT
from .silver import KNOWN_STATUSES

FAIL, WARN, INFO = "FAIL", "WARN", "INFO"


class QualityGateError(ValueError):
    """Raised when a FAIL-severity check does not pass."""


@dataclass(frozen=True)
class Check:
    """One scalar check.  ``kind`` selects the aggregate:

    row_count_min(param)        rows >= param
    not_null(column)            no null values
    unique(column)              distinct values (null counts as one) == rows
    accepted(column, param)     non-null values within the set ``param``
    required_when(columns, when)  no nulls in ``columns`` where ``when`` holds
    length_eq(column, param)    non-null strings have length ``param``
    non_negative(column)        non-null values >= 0
    min_eq(column, param)       min(column) == param
    none_rejected(column)       sum of the rejected-value counts == 0; left out
                                where the frame does not carry the counts
    date_range(column)          report min..max of non-null values (INFO)
    """
    name: str
    kind: str
    severity: str = FAIL
    column: str | None = None
    columns: tuple[str, ...] = ()
    param: object = None
    when: str | None = None


def _s(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def _check_exprs(check: Check) -> tuple[Column, Column]:
    """(passed, value) aggregate expressions for one check."""
    k, c = check.kind, (F.col(check.column) if check.column else None)
    if k == "row_count_min":
        n = F.count(F.lit(1))
        return n >= F.lit(check.param), _s(n)
    if k == "not_null":
        x = F.count_if(c.isNull())
        return x == 0, _s(x)
    if k == "unique":
        total = F.count(F.lit(1))
        distinct = F.count_distinct(c) + F.max(indicator(c.isNull()))
        distinct = F.coalesce(distinct, F.lit(0))
        return distinct == total, F.concat(_s(distinct), F.lit("/"), _s(total))
    if k == "accepted":
        x = F.count_if(c.isNotNull() & ~c.isin(list(check.param)))
        return x == 0, _s(x)
    if k == "required_when":
        missing = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in check.columns])
        x = F.count_if(F.coalesce(F.col(check.when), F.lit(False)) & missing)
        return x == 0, _s(x)
    if k == "length_eq":
        x = F.count_if(c.isNotNull() & (F.length(c) != F.lit(check.param)))
        return x == 0, _s(x)
    if k == "non_negative":
        x = F.count_if(c.isNotNull() & (c < 0))
        return x == 0, _s(x)
    if k == "min_eq":
        m = F.min(c)
        return F.coalesce(m == F.lit(check.param), F.lit(False)), _s(m)
    if k == "none_rejected":
        x = F.coalesce(F.sum(c), F.lit(0))
        return x == 0, _s(x)
    if k == "date_range":
        return F.lit(True), F.concat(_s(F.min(c)), F.lit(".."), _s(F.max(c)))
    raise ValueError(f"unknown check kind {k!r}")


def applicable(checks: Sequence[Check], columns: Sequence[str]) -> list[Check]:
    """The checks without those for helper columns that a frame does not carry."""
    return [c for c in checks if c.kind != "none_rejected" or c.column in columns]


def check_metrics(checks: Sequence[Check]) -> list[Column]:
    """Verdict and value of every check as aggregates (of kinds other than ``unique`` also
    fit for ``DataFrame.observe``)."""
    exprs = []
    for i, ch in enumerate(checks):
        passed, value = _check_exprs(ch)
        exprs += [passed.alias(f"_p{i}"), value.alias(f"_v{i}")]
    return exprs


def observed_rows(table: str, checks: Sequence[Check], seen: Mapping) -> list[Row]:
    """Check rows from the observed ``check_metrics``."""
    return [Row(table=table, check=ch.name, severity=ch.severity, passed=bool(seen[f"_p{i}"]), value=seen[f"_v{i}"])
            for i, ch in enumerate(checks)]


def check_results(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one aggregate pass -> one row per check."""
    checks = applicable(checks, df.columns)
    if not checks:
        return df.sparkSession.createDataFrame([], CHECK_RESULT)
    one = df.agg(*check_metrics(checks))
    rows = [F.struct(F.lit(table).alias("table"), F.lit(ch.name).alias("check"),
                     F.lit(ch.severity).alias("severity"),
                     F.coalesce(F.col(f"_p{i}"), F.lit(False)).alias("passed"),
                     F.col(f"_v{i}").alias("value"))
            for i, ch in enumerate(checks)]
    return one.select(F.inline(F.array(*rows)))


def enforce(results: DataFrame) -> list:
    """Q12: collect the (bounded) check rows; raise if a FAIL check failed.

    Failed WARN checks are returned, not raised, and are not listed in the
    error (R7)."""
    return enforce_rows(results.collect())


def enforce_rows(rows: list) -> list:
    failed = [r["check"] for r in rows if r["severity"] == FAIL and not r["passed"]]
    if failed:
        raise QualityGateError(f"write blocked by failing checks: {failed}")
    return rows


def quality_gate(df: DataFrame, table: str, checks: Sequence[Check]) -> list:
    return enforce(check_results(df, table, checks))


def require_rows(df: DataFrame, what: str, allow_empty: bool = False) -> bool:
    """Q13: raise when the snapshot has no rows, unless empty is allowed
    (then the caller records a warning).  ``isEmpty`` reads one row at most."""
    empty = df.isEmpty()
    if empty and not allow_empty:
        raise QualityGateError(f"{what}: no rows")
    return not empty


def with_severity(checks: Sequence[Check], **severities: str) -> tuple[Check, ...]:
    """The same checks with some severities changed, e.g.
    ``with_severity(MATCH_CHECKS, status_values_known=FAIL)``."""
    unknown = set(severities) - {c.name for c in checks}
    if unknown:
        raise ValueError(f"no such checks: {sorted(unknown)}")
    return tuple(replace(c, severity=severities.get(c.name, c.severity)) for c in checks)


# Values that a cast turned into null (an id beyond 32 bits, an unreadable date).
NO_REJECTS = Check("no_rejected_values", "none_rejected", FAIL, REJECTED)

# The reference's runtime gates, as data.  Fixed values: the check names.
MATCH_CHECKS = (
    Check("row_count_gt_zero", "row_count_min", FAIL, param=1),
    Check("no_nulls_match_id", "not_null", FAIL, "match_id"),
    Check("no_nulls_match_date", "not_null", FAIL, "match_date"),
    Check("no_nulls_home_team_name", "not_null", FAIL, "home_team_name"),
    Check("no_nulls_away_team_name", "not_null", FAIL, "away_team_name"),
    Check("match_id_unique", "unique", FAIL, "match_id"),
    Check("status_values_known", "accepted", WARN, "status", param=KNOWN_STATUSES),
    # Both scores, not only the home score.
    Check("finished_matches_have_scores", "required_when", FAIL,
          columns=("home_score_ft", "away_score_ft"), when="is_finished"),
    # A finished match without a winner is surfaced, not silently scored.
    Check("finished_has_winner", "required_when", WARN, columns=("home_result",),
          when="is_finished"),
    Check("date_range", "date_range", INFO, "match_date"),
    NO_REJECTS,
)

TEAM_CHECKS = (
    Check("row_count_gte_32", "row_count_min", WARN, param=32),
    Check("team_id_not_null", "not_null", FAIL, "team_id"),
    Check("team_id_unique", "unique", FAIL, "team_id"),
    Check("team_name_not_null", "not_null", FAIL, "team_name"),
    Check("area_name_not_null", "not_null", WARN, "area_name"),
    Check("tla_length_3", "length_eq", WARN, "team_tla", param=3),
    NO_REJECTS,
)

PLAYER_CHECKS = (
    Check("row_count_gt_zero", "row_count_min", FAIL, param=1),
    Check("player_id_not_null", "not_null", FAIL, "player_id"),
    Check("player_id_unique", "unique", FAIL, "player_id"),
    Check("goals_non_negative", "non_negative", FAIL, "goals"),
    Check("scorer_rank_starts_at_1", "min_eq", FAIL, "scorer_rank", param=1),
    NO_REJECTS,
)


# --------------------------------------------------------------------------
# Declarative tests
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class ColumnTest:
    model: str
    test: str                     # not_null | unique | accepted_values | relationships
    column: str
    values: tuple = ()            # accepted_values
    to: str | None = None         # relationships: parent model
    parent_key: str | None = None  # relationships: parent column


def _one(model: str, test: str, column: str, failures: Column) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(test).alias("test"),
            F.lit(column).alias("column"), F.coalesce(failures, F.lit(0)).cast("long").alias("failures")]


def run_tests(models: Mapping[str, DataFrame], spec: Iterable[ColumnTest]) -> DataFrame:
    """One row per test with the number of failing rows it finds.

    ``not_null`` and ``accepted_values``: one aggregate pass per model.  All ``unique`` and
    ``relationships`` tests together: one table of key counts (``key_counts``)."""
    spec = list(spec)
    parts: list[DataFrame] = []
    by_model: dict[str, list[ColumnTest]] = {}
    for t in spec:
        if t.test not in ("not_null", "accepted_values", "unique", "relationships"):
            raise ValueError(f"unknown test {t.test!r}")
        by_model.setdefault(t.model, []).append(t)
    for model, tests in by_model.items():
        df = models[model]
        flat = [t for t in tests if t.test in ("not_null", "accepted_values")]
        if flat:
            def failing(t):
                c = F.col(t.column)
                if t.test == "not_null":
                    return F.count_if(c.isNull())
                return F.count_distinct(F.when(~c.isin(list(t.values)), c))
            one = df.agg(*[failing(t).alias(f"_n{i}") for i, t in enumerate(flat)])
            parts.append(one.select(F.inline(F.array(*[
                F.struct(*_one(model, t.test, t.column, F.col(f"_n{i}")))
                for i, t in enumerate(flat)]))))
    keyed = [t for t in spec if t.test in ("unique", "relationships")]
    if keyed:
        parts.append(_key_tests(models, keyed))
    if not parts:
        spark = next(iter(models.values())).sparkSession
        return spark.createDataFrame([], TEST_RESULT)
    return reduce(DataFrame.unionByName, parts)


def key_counts(models: Mapping[str, DataFrame], spaces: Sequence[Sequence[tuple[str, str]]]) -> DataFrame:
    """Rows per key value: ``space, key`` and ``n0, n1, ...``, one count for every column listed.

    A space is a set of (model, column) pairs whose values are compared with one another.
    Every model is scanned once, and keys are counted before the one exchange by (space,
    key), so a hot key is one row per task.  Null is a key of its own."""
    numbered = [(s, m, c) for s, pairs in enumerate(spaces) for m, c in pairs]
    rows = []
    for model in dict.fromkeys(m for _, m, _ in numbered):
        cells = [F.struct(F.lit(s).alias("space"), F.col(f"`{c}`").cast("string").alias("key"), F.lit(i).alias("col"))
                 for i, (s, m, c) in enumerate(numbered) if m == model]
        rows.append(models[model].select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionAll, rows).groupBy("space", "key").agg(
        *[F.count_if(F.col("col") == i).alias(f"n{i}") for i in range(len(numbered))])


def _key_tests(models: Mapping[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    spaces: list[list[tuple[str, str]]] = []
    for t in tests:     # columns that a relationship compares share a space
        pairs = {(t.model, t.column)} | ({(t.to, t.parent_key)} if t.test == "relationships" else set())
        touching = [s for s in spaces if pairs & set(s)]
        spaces = [s for s in spaces if s not in touching] + [sorted(pairs.union(*touching))]
    at = {pair: i for i, pair in enumerate(p for s in spaces for p in s)}
    known = F.col("key").isNotNull()
    failures = []
    for t in tests:
        mine = F.col(f"n{at[t.model, t.column]}")
        if t.test == "unique":
            failures.append(F.count_if(known & (mine > 1)))
        else:
            failures.append(F.sum(F.when(known & (F.col(f"n{at[t.to, t.parent_key]}") == 0), mine)))
    one = key_counts(models, spaces).agg(*[f.alias(f"_n{i}") for i, f in enumerate(failures)])
    return one.select(F.inline(F.array(*[F.struct(*_one(t.model, t.test, t.column, F.col(f"_n{i}"))) for i, t in enumerate(tests)])))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child key values (with row counts) that have no parent row.

    The child side is pre-aggregated per key, so a hot key becomes one row
    before the anti-join shuffle; the parent side is reduced to its distinct
    keys the same way."""
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).count()
    parents = parent.select(F.col(pk).alias("_pk")).distinct()
    return keys.join(parents, keys["_fk"] == parents["_pk"], "left_anti")


STAGING_TESTS = (
    ColumnTest("stg_matches", "not_null", "match_id"),
    ColumnTest("stg_matches", "unique", "match_id"),
    ColumnTest("stg_matches", "not_null", "match_date"),
    ColumnTest("stg_matches", "not_null", "home_team_name"),
    ColumnTest("stg_matches", "not_null", "away_team_name"),
    ColumnTest("stg_matches", "accepted_values", "status", values=KNOWN_STATUSES),
    ColumnTest("stg_matches", "not_null", "is_finished"),
    ColumnTest("stg_teams", "not_null", "team_id"),
    ColumnTest("stg_teams", "unique", "team_id"),
    ColumnTest("stg_teams", "not_null", "team_name"),
    ColumnTest("stg_teams", "not_null", "team_tla"),
    ColumnTest("stg_teams", "not_null", "area_name"),
    ColumnTest("stg_players", "not_null", "player_id"),
    ColumnTest("stg_players", "unique", "player_id"),
    ColumnTest("stg_players", "not_null", "player_name"),
    ColumnTest("stg_players", "not_null", "goals"),
    ColumnTest("stg_players", "not_null", "team_id"),
    ColumnTest("stg_players", "relationships", "team_id", to="stg_teams", parent_key="team_id"),
    ColumnTest("stg_players", "not_null", "scorer_rank"),
)


def unknown_values(df: DataFrame, column: str, known: Iterable) -> DataFrame:
    """U3 + A8: values of ``column`` outside the accepted set, with row counts
    (the distinct-value listing of the reference's status check)."""
    c = F.col(column)
    return (df.filter(c.isNotNull() & ~c.isin(list(known)))
            .groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n_rows")))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """A3 / Q11: earliest and latest non-null value, one row."""
    c = F.col(column)
    return df.filter(c.isNotNull()).agg(F.min(c).alias("earliest"), F.max(c).alias("latest"))
