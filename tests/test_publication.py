"""Observed writes, export order, marts swapped whole, key counts, field profiles, check names."""

import json

import pytest
from pyspark.sql import functions as F

from medallion.plans import ingest
from medallion.plans import quality as q
from medallion.sources import bronze, layers


def test_observed_publication_sees_loss_change_and_empty_tables(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"), F.create_map(F.lit("a"), F.col("id")).alias("m"))

    def writer(x, path):
        if "/lost/" in path:
            x = x.where("id <> 7")
        if "/doubled/" in path:
            x = x.unionAll(x.where("id = 7"))
        if "/swapped/" in path:
            x = x.withColumn("name", F.when(F.col("id") == 7, "n8").when(F.col("id") == 8, "n7").otherwise(F.col("name")))
        ingest.write_parquet(x, path)

    tables = {n: df for n in ("whole", "lost", "swapped")} | {"empty": df.limit(0)}
    log = {r["item"]: (r["rows"], r["ok"]) for r in ingest.publish_gold(tables, str(tmp_path), "2024-09-01", writer=writer).collect()}
    assert log == {"whole": (100, True), "lost": (99, False), "swapped": (100, False), "empty": (0, True)}


def test_export_order_is_checked(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10).cast("int").alias("p"))
    tables = {"good": df.orderBy(F.col("p").desc(), "id"), "files_out_of_order": df.repartition(4, "id").sortWithinPartitions(F.col("p").desc(), "id"),
              "rows_out_of_order": df.coalesce(1).sortWithinPartitions("id")}
    log = {r["item"]: r["ok"] for r in ingest.publish_gold(tables, str(tmp_path), "2024-09-01", orders={n: ("-p", "id") for n in tables}).collect()}
    assert log == {"good": True, "files_out_of_order": False, "rows_out_of_order": False}


def test_marts_are_swapped_and_old_builds_go(spark):
    spark.sql("create database if not exists swap_t")
    spark.range(5).write.saveAsTable("swap_t.m")                    # stored as a table before
    before = layers.materialize_mart(spark.range(3), "swap_t.m")
    reader = spark.table("swap_t.m")                                # under way while the mart is rebuilt
    layers.materialize_mart(spark.range(4), "swap_t.m")
    assert reader.count() == 3 and layers.read_table(spark, "swap_t.m").count() == 4
    with pytest.raises(Exception, match="broken"):
        layers.materialize_mart(spark.range(2).select(F.raise_error(F.lit("broken")).cast("int").alias("id")), "swap_t.m")
    assert layers.read_table(spark, "swap_t.m").count() == 4        # a failed rebuild leaves the mart
    layers.materialize_mart(spark.range(6), "swap_t.m")
    assert before.split(".")[1] not in {t.name for t in spark.catalog.listTables("swap_t")}
    layers.drop_mart(spark, "swap_t.m")
    spark.sql("drop database swap_t cascade")


def test_key_counts_answer_uniqueness_and_parents_from_one_exchange(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, 99), (3, None), (None, 98)], "id int, parent int")
    parent = spark.createDataFrame([(10,), (11,), (11,), (None,), (None,)], "pid long")
    spec = [q.ColumnTest("child", "unique", "id"), q.ColumnTest("parent", "unique", "pid"),
            q.ColumnTest("child", "relationships", "parent", to="parent", parent_key="pid")]
    out = q.run_tests({"child": child, "parent": parent}, spec)
    assert {(r["model"], r["test"]): r["failures"] for r in out.collect()} == {
        ("child", "unique"): 1, ("parent", "unique"): 1, ("child", "relationships"): 2}
    keys = q.key_counts({"child": child, "parent": parent}, [[("child", "parent"), ("parent", "pid")], [("child", "id")]])
    assert {(r["space"], r["key"]): (r["n0"], r["n1"], r["n2"]) for r in keys.collect()}[0, None] == (1, 2, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("hashpartitioning(space") == 1


def test_field_profile_shows_observed_types(spark, tmp_path):
    docs = {"records": [{"id": 1, "x": {"deep": {"er": True}}, "mixed": "a"}, {"id": 2, "mixed": 5, "gone": None}, {"id": 30, "mixed": [1]}]}
    (tmp_path / "a.json").write_text(json.dumps(docs, indent=1))
    got = {r["path"]: (r["types"], r["records"], r["nulls"], r["sample"]) for r in bronze.field_profile(spark, str(tmp_path), "records").collect()}
    assert got == {"id": ("BIGINT", 3, 0, "1"), "x": ("OBJECT", 1, 0, None), "x.deep": ("OBJECT", 1, 0, None),
                   "x.deep.er": ("BOOLEAN", 1, 0, "true"), "mixed": ("ARRAY,BIGINT,STRING", 3, 0, "5"), "gone": ("VOID", 1, 1, None)}


def test_no_check_of_the_blueprint_is_left_out():
    """The names of the survey's gate checks Q1-Q11 (and the library's own), written out."""
    assert {c.name for c in q.MATCH_CHECKS} == {
        "row_count_gt_zero", "no_nulls_match_id", "no_nulls_match_date", "no_nulls_home_team_name", "no_nulls_away_team_name",
        "match_id_unique", "status_values_known", "finished_matches_have_scores", "finished_has_winner", "date_range", "no_rejected_values"}
    assert {c.name for c in q.TEAM_CHECKS} == {"row_count_gte_32", "team_id_not_null", "team_id_unique", "team_name_not_null",
                                               "area_name_not_null", "tla_length_3", "no_rejected_values"}
    assert {c.name for c in q.PLAYER_CHECKS} == {"row_count_gt_zero", "player_id_not_null", "player_id_unique", "goals_non_negative",
                                                 "scorer_rank_starts_at_1", "no_rejected_values"}
