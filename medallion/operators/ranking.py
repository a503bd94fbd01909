"""Global ranks (W1, W2, W9) without a single-partition window.

``row_number() over (order by ...)`` with no partition makes Spark move every
row into one task.  ``rank_by`` instead:

1. range-partitions the rows on the full order key (which must end in a
   unique column, so ties never straddle an unknown boundary and a hot tie
   group is split across partitions like any other key range), sorts each
   partition, and numbers rows inside it (``monotonically_increasing_id``
   minus the partition's base, i.e. the position within the partition);
2. counts rows per partition: at most one row per partition (bounded by
   the shuffle partition count), so the offsets table has a proven size
   bound and is broadcast;
3. adds the running count of all earlier partitions to each position.

The range-partitioned, sorted rows are written once, with their partition
id and position as columns, as a Parquet table under the cluster's shared
``spark.checkpoint.dir`` (lineage cut by a written table, never a local
checkpoint); building a rank therefore runs that job at once.  Every branch reads those files, so ids and positions agree, the
input is computed once, branches read only the columns they need, and a lost
executor re-reads files instead of re-sampling range bounds (a re-sample
could move rows between partitions).

``dense_rank`` ranks the distinct order-key tuples (a partial aggregation
collapses hot tuples map-side) and joins the rank back on the key.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_paths, scratch_tables_dir

_PID, _POS, _N, _OFF = "_rk_pid", "_rk_pos", "_rk_n", "_rk_off"


_SCOPE = threading.local()


@contextmanager
def scratch_scope(spark):
    """Delete, on leaving the block, the intermediate tables written inside it
    by this thread.  For jobs that write their results before the block ends;
    DataFrames that still read those tables must not outlive it."""
    outer = getattr(_SCOPE, "paths", None)
    _SCOPE.paths = []
    try:
        yield
    finally:
        mine, _SCOPE.paths = _SCOPE.paths, outer
        delete_paths(spark, mine)


def scratch_table_path(spark) -> str:
    """A fresh folder for a written intermediate table inside the shared
    folder named by ``spark.checkpoint.dir`` (``session.drop_scratch_tables``
    removes them after a run)."""
    path = f"{scratch_tables_dir(spark)}/{uuid.uuid4().hex}"
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    return path


def range_positions(df: DataFrame, order: Sequence[Column], num_partitions: int | None,
                    pid: str, pos: str) -> DataFrame:
    """Range-partition on ``order``, sort each partition, record each row's
    partition id (``pid``) and 0-based position in it (``pos``), write the
    rows once as a Parquet table and return the table.

    Without an explicit count the exchange uses the session's shuffle
    partitions and AQE may coalesce neighbouring ranges (order is kept); ids
    and positions are taken in the writing tasks, so they describe exactly
    the stored layout.  A retried write task recomputes the same partition
    (same range bounds, same total order) and so the same positions."""
    ranged = (df.repartitionByRange(int(num_partitions), *order) if num_partitions
              else df.repartitionByRange(*order))
    ranged = (ranged.sortWithinPartitions(*order)
              .withColumn(pid, F.spark_partition_id())
              .withColumn(pos, F.monotonically_increasing_id()
                          - F.shiftleft(F.col(pid).cast("long"), 33)))
    spark = df.sparkSession
    path = scratch_table_path(spark)
    ranged.write.parquet(path)
    return spark.read.parquet(path)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = 1-based position of each row in ``order``.

    ``order`` must be a total order (end it with a unique key); with ties the
    numbering among tied rows is arbitrary, as in SQL.
    """
    ranged = range_positions(df, order, num_partitions, _PID, _POS)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: safe to broadcast at any data size.
    offsets = counts.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    return (ranged.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col(_OFF) + F.col(_POS) + 1).cast("long"))
            .drop(_PID, _POS, _OFF))


def global_dense_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                      name: str, num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = dense rank of the ``keys`` tuple under ``order``.

    ``order`` must order exactly the ``keys`` columns (no extra tiebreak)."""
    distinct = df.select(*keys).distinct()
    ranked = global_row_number(distinct, order, name, num_partitions)
    cond = [df[k].eqNullSafe(ranked[k]) for k in keys]
    out = df.join(ranked, cond, "inner")
    return out.select(*[df[c] for c in df.columns], ranked[name])


def rank_by(df: DataFrame, order: Sequence[Column], name: str, method: str = "row_number",
            keys: Sequence[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Global rank column (bigint), one plan for all sizes.  ``method``:
    ``row_number`` (the reference's coded behaviour) or ``dense_rank`` (its
    documented one)."""
    if method == "row_number":
        return global_row_number(df, order, name, num_partitions)
    if method == "dense_rank":
        if not keys:
            raise ValueError("dense_rank needs the key column names")
        return global_dense_rank(df, keys, order, name, num_partitions)
    raise ValueError(f"unknown rank method {method!r}")


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_name: str | None = None) -> DataFrame:
    """The first ``k`` rows in ``order`` (a top-k report, B4 / D3 / D5).

    Planned as TakeOrderedAndProject: each task keeps its own k best rows and
    only those reach the final merge, so no full sort or shuffle happens."""
    out = df.orderBy(*order).limit(k)
    if rank_name:
        # k rows only: numbering them in one partition is bounded work.
        out = out.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return out
