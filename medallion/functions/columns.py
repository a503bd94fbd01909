"""Scalar column helpers.  All return JVM-side ``Column`` expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: ColumnOrName, zero=0) -> Column:
    """Null to zero (``coalesce(x, 0)``)."""
    return F.coalesce(_c(c), F.lit(zero))


def eq_flag(c: ColumnOrName, value) -> Column:
    """``c == value`` where a null input yields ``false`` instead of null."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))


def indicator(cond: Column) -> Column:
    """1 when the condition holds, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def first_nonzero(*cols: ColumnOrName, default=None) -> Column:
    """First numeric value that is neither null nor 0 (Python ``a or b``)."""
    parts = [F.nullif(_c(c), F.lit(0)) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def first_nonblank(*cols: ColumnOrName, default=None) -> Column:
    """First string value that is neither null nor ``""`` (Python ``a or b``),
    tested on the raw value, before any trim."""
    parts = [F.nullif(_c(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def floor_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Exact integer floor division of two integral columns (den > 0)."""
    n, d = _c(num).cast("long"), _c(den).cast("long")
    return ((n - F.pmod(n, d)) / d).cast("long")


def exact_round_ratio(num: ColumnOrName, den: ColumnOrName, digits: int,
                      scale: int = 1) -> Column:
    """``round(num * scale / den, digits)`` with half-up rounding, computed on
    integers so every engine gets the same digits.  Null when ``den`` is 0 or
    null (the ``nullif(den, 0)`` guard)."""
    p = 10 ** digits
    n, d = _c(num).cast("long"), _c(den).cast("long")
    q = floor_div(F.lit(2 * p * scale) * n + d, F.lit(2) * d)
    return F.when(d != 0, q.cast("double") / F.lit(float(p)))


def result_code(winner: ColumnOrName, home="HOME_TEAM", away="AWAY_TEAM",
                draw="DRAW") -> Column:
    """Winner label to the home side's W / L / D code, else null."""
    w = _c(winner)
    return (F.when(w == home, F.lit("W")).when(w == away, F.lit("L"))
            .when(w == draw, F.lit("D")))


def flip_result(result: ColumnOrName) -> Column:
    """Home code to the away side's code: W->L, L->W, anything else (also
    null) -> D.  This is the form mart's rule, kept as is."""
    r = _c(result)
    return F.when(r == "W", F.lit("L")).when(r == "L", F.lit("W")).otherwise(F.lit("D"))


def points_for(result: ColumnOrName, win: int = 3, draw: int = 1) -> Column:
    """Result code to league points: W 3, D 1, else 0."""
    r = _c(result)
    return F.when(r == "W", F.lit(win)).when(r == "D", F.lit(draw)).otherwise(F.lit(0))


def form_label(points: ColumnOrName, good: int = 10, average: int = 5) -> Column:
    p = _c(points)
    return (F.when(p >= good, F.lit("Good")).when(p >= average, F.lit("Average"))
            .otherwise(F.lit("Poor")))


def first_matching(arr: ColumnOrName, pred: Callable[[Column], Column]) -> Column:
    """First element satisfying ``pred``, else the first element, else null."""
    a = _c(arr)
    return F.coalesce(F.get(F.filter(a, pred), 0), F.get(a, 0))


def try_int(c: ColumnOrName) -> Column:
    """Cast to int; a value that does not fit or parse becomes null (ANSI-safe)."""
    return _c(c).try_cast("int")


# Helper column of the Silver frames: values of a row that a cast rejected.
REJECTED = "_rejected_values"


def rejected(*pairs: tuple[ColumnOrName, ColumnOrName]) -> Column:
    """How many (raw, cast) pairs hold a raw value whose cast is null."""
    return reduce(lambda a, b: a + b, [indicator(_c(r).isNotNull() & _c(v).isNull()) for r, v in pairs])


def clean(c: ColumnOrName) -> Column:
    """Trim spaces (both ends)."""
    return F.trim(_c(c))


def clean_upper(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_c(c)))

