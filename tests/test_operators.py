"""Operators against plain-window oracles, including a hot key holding a
third of the rows and partition counts that split groups across blocks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.operators.ranking import global_dense_rank, global_row_number, rank_by, top_k
from medallion.operators.sequence import last_n_per_group, running_stats
from medallion.operators.two_sided import two_sided

from .conftest import rows
from .plain import running_stats_window


def skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.randint(1, 40)        # group 0 holds a third
        if i % 97 == 0:
            g = None                                         # a null group too
        data.append((i, g, rnd.randint(0, 20), rnd.randint(0, 3), rnd.randint(0, 5)))
    return spark.createDataFrame(data, "id long, g int, d int, v int, w int")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_row_number_matches_window(spark, parts):
    df = skewed(spark)
    order = [F.col("v").desc(), F.col("d").asc(), F.col("id").asc()]
    got = global_row_number(df, order, "rk", num_partitions=parts)
    want = df.withColumn("rk", F.row_number().over(Window.orderBy(*order)).cast("int"))
    assert rows(got, "id", "rk") == rows(want, "id", "rk")


def test_global_row_number_plan_has_no_single_partition_on_data(spark):
    df = skewed(spark)
    got = global_row_number(df, [F.col("v").desc(), F.col("id")], "rk", num_partitions=5)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The only SinglePartition exchange feeds the window over the per-partition
    # counts (at most num_partitions rows); the data itself is read from the
    # range-partitioned checkpoint and joined to a broadcast of the offsets.
    assert plan.count("SinglePartition") == 1
    assert "BroadcastHashJoin" in plan
    single = [ln for ln in plan.split("\n") if "SinglePartition" in ln][0]
    assert "_rk_pid" in plan and "Exchange SinglePartition" in single


def test_dense_rank_matches_window(spark):
    df = skewed(spark)
    order = [F.col("v").desc(), F.col("w").desc()]
    got = global_dense_rank(df, ["v", "w"], order, "dr", num_partitions=4)
    want = df.withColumn("dr", F.dense_rank().over(Window.orderBy(*order)).cast("int"))
    assert rows(got, "id", "dr") == rows(want, "id", "dr")
    via = rank_by(df, order, "dr", method="dense_rank", keys=["v", "w"], num_partitions=3)
    assert rows(via, "id", "dr") == rows(want, "id", "dr")


@pytest.mark.parametrize("parts,n", [(1, 5), (4, 5), (9, 5), (13, 1), (6, 3), (40, 5)])
def test_running_stats_matches_window(spark, parts, n):
    df = skewed(spark, n=1200)
    order = [F.col("d").asc_nulls_last(), F.col("id").asc()]
    values = {"v": F.col("v"), "w": F.col("w")}
    got = running_stats(df, ["g"], order, values, n, num_partitions=parts)
    want = running_stats_window(df, ["g"], order, values, n)
    cols = ["id", "seq_no", "cum_v", "cum_w", "last_n_v", "last_n_w"]
    assert rows(got, *cols) == rows(want, *cols)


def test_running_stats_tiny_partitions(spark):
    # More partitions than rows per group: blocks of one or two rows must
    # borrow their last-n history from several earlier blocks.
    data = [(i, 1, i, i % 4) for i in range(30)] + [(100 + i, 2, i, 1) for i in range(3)]
    df = spark.createDataFrame(data, "id long, g int, d int, v int")
    order = [F.col("d"), F.col("id")]
    got = running_stats(df, ["g"], order, {"v": F.col("v")}, 5, num_partitions=25)
    want = running_stats_window(df, ["g"], order, {"v": F.col("v")}, 5)
    cols = ["id", "seq_no", "cum_v", "last_n_v"]
    assert rows(got, *cols) == rows(want, *cols)


def test_last_n_per_group_plans_partial_limit(spark):
    df = skewed(spark)
    got = last_n_per_group(df, ["g"], [F.col("d").desc(), F.col("id").desc()], 5, "rn")
    want = (df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(F.col("d").desc(), F.col("id").desc())))
        .filter("rn <= 5"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_two_sided_single_scan(spark):
    df = spark.createDataFrame([(1, "a", "b", 2, 0)], "id int, h string, a string, hs int, as_ int")
    out = two_sided(df, [{"team": F.col("h"), "gf": F.col("hs"), "ga": F.col("as_")},
                         {"team": F.col("a"), "gf": F.col("as_"), "ga": F.col("hs")}])
    assert rows(out) == [("a", 2, 0), ("b", 0, 2)]
    with pytest.raises(ValueError):
        two_sided(df, [{"x": F.col("h")}, {"y": F.col("a")}])


def test_top_k(spark):
    df = skewed(spark)
    got = top_k(df, [F.col("v").desc(), F.col("id")], 7, rank_name="k")
    want = df.orderBy(F.col("v").desc(), F.col("id")).limit(7)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert sorted(r["k"] for r in got.collect()) == list(range(1, 8))


def test_hot_group_is_split_across_partitions(spark):
    # The group holding a third of the rows is cut into several range
    # partitions, so no single task windows the whole group.
    from medallion.operators.ranking import range_positions
    df = skewed(spark, n=3000)
    order = [F.col("g").asc_nulls_last(), F.col("d"), F.col("id")]
    stored = range_positions(df, order, 7, "_pid", "_pos")
    parts = stored.filter("g = 0").select("_pid").distinct().count()
    assert parts >= 2
    per_part = [r["count"] for r in stored.groupBy("_pid").count().collect()]
    assert max(per_part) < 1000          # group 0 alone has 1000 rows


def test_empty_inputs(spark):
    from medallion.plans import gold
    empty = skewed(spark, n=10).filter("false")
    assert global_row_number(empty, [F.col("id")], "rk").count() == 0
    assert global_dense_rank(empty, ["v"], [F.col("v")], "dr").count() == 0
    order = [F.col("d"), F.col("id")]
    assert running_stats(empty, ["g"], order, {"v": F.col("v")}, 5).count() == 0
    none_finished = spark.createDataFrame(
        [(1, None, False, 1, "A", "SA", 2, "B", "SB", None, None, None)],
        "match_id long, match_date date, is_finished boolean, home_team_id long, "
        "home_team_name string, home_team_short string, away_team_id long, away_team_name string, "
        "away_team_short string, home_score_ft int, away_score_ft int, home_result string")
    assert gold.standings(none_finished).count() == 0
    assert gold.team_form(none_finished).count() == 0
    assert gold.rolling_form(none_finished).count() == 0


def test_drop_scratch_tables(spark):
    import os
    from medallion.session import drop_scratch_tables, scratch_tables_dir
    out = global_row_number(skewed(spark, n=50), [F.col("id")], "rk").collect()
    assert len(out) == 50
    local = scratch_tables_dir(spark).replace("file:", "")
    assert os.path.isdir(local) and os.listdir(local)
    assert drop_scratch_tables(spark) is True
    assert not os.path.exists(local)
    assert drop_scratch_tables(spark) is False
