"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
            .where("u <> v").distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component = smallest node.

    Both rounds are a grouped minimum joined back to the edges, so a node with
    very many neighbours is pre-aggregated before its shuffle and its join
    partition can be split.  Each round is written to the shared checkpoint
    folder.  Loops and repeated edges are allowed; no edges give no rows."""
    e = materialise(_canonical(edges.select(F.col(src).cast("long").alias("src"),
                                            F.col(dst).cast("long").alias("dst"))
                               .where("src is not null and dst is not null")), "edges")
    seen = None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or (state["n"], state["h"]) == seen:
            break
        seen = (state["n"], state["h"])
        nxt = materialise(_small_star(_large_star(e)), "edges")
        discard(e)
        e = nxt
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
