"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_paths, scratch_tables_dir

# Rows and bytes in one Arrow batch handed to Python: bounds a worker's memory
# when texts are long.
BATCH_ROWS = 500
BATCH_BYTES = 24 << 20
READ_ROWS = 4096    # rows of one Parquet batch in the JVM (Spark's default)


def prepare(spark: SparkSession, batch_bytes: int = BATCH_BYTES, read_rows: int = READ_ROWS,
            rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of the session (documents can be megabytes long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(read_rows))


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_tables_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: later stages read the files, so they neither recompute
    Python work nor depend on shuffle files of lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by ``materialise`` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            delete_paths(df.sparkSession, [path])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free, k = f"__{name}", 0
        while free.lower() in taken:
            k += 1
            free = f"__{name}_{k}"
        taken.add(free.lower())
        out.append(free)
    return out


def text_of(name: str = "text") -> Column:
    """The text column, null counted as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def fold_of(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(mod)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_rows(docs: DataFrame, keyed: DataFrame, keys: list[str], keepers: DataFrame) -> DataFrame:
    """The columns of ``docs`` for the rows of ``keyed`` named in ``keepers``.

    ``keyed`` is ``docs`` plus the ``keys`` columns; ``keepers`` has one row per
    key that stays.  Rows repeated with the same key leave one row."""
    other = free_names(keyed, *[f"k_{c}" for c in keys])
    k = keepers.select(*[F.col(c).alias(o) for c, o in zip(keys, other)])
    cond = None
    for c, o in zip(keys, other):
        e = F.col(c).eqNullSafe(F.col(o))
        cond = e if cond is None else cond & e
    return (keyed.join(k, cond, "left_semi").dropDuplicates(keys)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
