"""Per-group sequences: latest rows (top-n per group) and running / rolling sums.

``last_n_per_group`` is ``row_number() <= n`` over a per-group window; Spark
plans it with a *partial* WindowGroupLimit before the shuffle, so each map
task forwards at most ``n`` rows per group and a hot group costs no more
than a small one.

``running_stats`` (W3-W8) computes, per group in order: the position, running
sums and sums over the last ``n`` rows.  A plain ``Window.partitionBy(group)``
puts a whole group into one task, which breaks when one group holds a large
share of the rows.  Here the rows are range partitioned on
``(group, order)`` so a hot group is cut into contiguous blocks of bounded
size, each block is scanned by an ordinary window, and the blocks are
stitched together with two small tables whose size is bounded by the number
of partitions (not by the data):

* ``edges``: blocks that continue a group from an earlier partition or into
  a later one (at most two per partition boundary), with the row count and
  sums of all earlier blocks of the group;
* ``tails``: the last ``n`` rows of every block that a later block continues,
  with their group-wide running sums, used by the first rows of the next
  block to finish their last-``n`` sums.

``edges`` is broadcast (at most two rows per partition); ``tails`` holds up
to ``n`` rows per partition, so the planner chooses its join by size.  The range-partitioned rows are written once as a table
with their partition id and position (see ``ranking.range_positions``), so
all three branches read identical blocks.
Values must be non-null (wrap them with ``nz``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import range_positions


def last_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                     rn_name: str = "_rn") -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order`` and number them."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rn_name, F.row_number().over(w)).filter(F.col(rn_name) <= n)


_PID, _POS = "_sq_pid", "_sq_pos"
_BN, _B0, _OFFN, _TOTN, _LRN = "_sq_bn", "_sq_b0", "_sq_offn", "_sq_totn", "_sq_lrn"


def _v(v):
    return f"_sq_v_{v}"


def running_stats(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  values: Mapping[str, Column], n: int, rn_name: str = "seq_no",
                  cum_prefix: str = "cum_", last_prefix: str = "last_n_",
                  num_partitions: int | None = None) -> DataFrame:
    """Append ``rn_name`` (1-based position in group), ``cum_<v>`` (running
    sum including the current row) and ``last_n_<v>`` (sum over the current
    row and up to ``n - 1`` rows before it) for each ``values`` entry.

    ``order`` must make rows unique within a group (end it with a key)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    names = list(values)
    cols = df.columns
    base = df.select("*", *[values[v].alias(_v(v)) for v in names])
    sort_spec = [F.col(g).asc_nulls_last() for g in group] + list(order)
    ranged = range_positions(base, sort_spec, num_partitions, _PID, _POS)

    # Block summary: one row per (partition, group); per group at most one
    # row per partition, so the window over it never concentrates data.
    blocks = ranged.groupBy(_PID, *group).agg(
        F.count(F.lit(1)).alias(_BN), F.min(_POS).alias(_B0),
        *[F.sum(_v(v)).alias(f"_sq_bs_{v}") for v in names])
    wg = Window.partitionBy(*group).orderBy(_PID)
    before = wg.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        _PID, *group, _BN, _B0, *[f"_sq_bs_{v}" for v in names],
        F.coalesce(F.sum(_BN).over(before), F.lit(0)).alias(_OFFN),
        *[F.coalesce(F.sum(f"_sq_bs_{v}").over(before), F.lit(0)).alias(f"_sq_off_{v}")
          for v in names],
        F.sum(_BN).over(Window.partitionBy(*group)).alias(_TOTN))
    # Each partition boundary splits at most one group, so at most two
    # blocks per partition continue or are continued: a proven bound.
    edges = blocks.filter((F.col(_OFFN) > 0) | (F.col(_OFFN) + F.col(_BN) < F.col(_TOTN)))

    def renamed(frame: DataFrame, keep: Sequence[str], tag: str) -> DataFrame:
        return frame.select(F.col(_PID).alias(f"_{tag}_pid"),
                            *[F.col(g).alias(f"_{tag}_g{i}") for i, g in enumerate(group)],
                            *keep)

    def block_cond(left: DataFrame, tag: str) -> list[Column]:
        return ([F.col(_PID) == F.col(f"_{tag}_pid")]
                + [F.col(g).eqNullSafe(F.col(f"_{tag}_g{i}")) for i, g in enumerate(group)])

    # Local scan of each block (hash exchange on (partition, group)).
    wl = Window.partitionBy(_PID, *group).orderBy(_POS)
    local = ranged.select(
        "*", F.row_number().over(wl).alias(_LRN),
        *[F.sum(_v(v)).over(wl.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_sq_lc_{v}")
          for v in names],
        *[F.sum(_v(v)).over(wl.rowsBetween(-(n - 1), 0)).alias(f"_sq_lr_{v}") for v in names])

    edge_cols = renamed(edges, [_OFFN, *[f"_sq_off_{v}" for v in names]], "e")
    joined = local.join(F.broadcast(edge_cols), block_cond(local, "e"), "left")
    offn = F.coalesce(F.col(_OFFN), F.lit(0))
    joined = joined.select(
        *cols, _LRN, (offn + F.col(_LRN)).alias(rn_name), offn.alias(_OFFN),
        *[(F.coalesce(F.col(f"_sq_off_{v}"), F.lit(0)) + F.col(f"_sq_lc_{v}")).alias(f"{cum_prefix}{v}")
          for v in names],
        *[F.col(f"_sq_lr_{v}") for v in names])

    # Tails: last n rows of every continued block, read from the written
    # range-partitioned rows.  At most n rows per partition.
    nonlast = edges.filter(F.col(_OFFN) + F.col(_BN) < F.col(_TOTN))
    nonlast = renamed(nonlast, [_OFFN, _BN, _B0, *[f"_sq_off_{v}" for v in names],
                                *[f"_sq_bs_{v}" for v in names]], "t")
    tail_rows = (ranged.join(F.broadcast(nonlast), block_cond(ranged, "t"), "inner")
                 .filter(F.col(_POS) >= F.col(_B0) + F.col(_BN) - n))
    after = (Window.partitionBy(_PID, *group).orderBy(F.col(_POS).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    tails = tail_rows.select(
        *[F.col(g).alias(f"_u_g{i}") for i, g in enumerate(group)],
        (F.col(_OFFN) + F.col(_POS) - F.col(_B0) + 1).alias("_u_rn"),
        *[(F.col(f"_sq_off_{v}") + F.col(f"_sq_bs_{v}")
           - F.coalesce(F.sum(_v(v)).over(after), F.lit(0))).alias(f"_u_cum_{v}") for v in names])
    cond = ([F.col(g).eqNullSafe(F.col(f"_u_g{i}")) for i, g in enumerate(group)]
            + [(F.col(rn_name) - n) == F.col("_u_rn")])
    out = joined.join(tails, cond, "left")
    local_ok = (F.col(_LRN) >= n) | (F.col(_OFFN) == 0)
    return out.select(
        *cols, rn_name, *[f"{cum_prefix}{v}" for v in names],
        *[F.when(local_ok, F.col(f"_sq_lr_{v}"))
           .when(F.col(rn_name) <= n, F.col(f"{cum_prefix}{v}"))
           .otherwise(F.col(f"{cum_prefix}{v}") - F.col(f"_u_cum_{v}")).alias(f"{last_prefix}{v}")
          for v in names])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """R9 (opt-in): keep one row per key, the first in ``order`` (e.g. the
    newest snapshot first).  Planned as a top-1 WindowGroupLimit, partial
    before the shuffle, so duplicates of a hot key are dropped map-side."""
    return last_n_per_group(df, keys, order, 1, "_dedup_rn").drop("_dedup_rn")

