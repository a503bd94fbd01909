from pyspark.sql import functions as F

from medallion.functions.columns import (eq_flag, exact_round_ratio, first_matching,
                                         first_nonblank, first_nonzero, flip_result, form_label,
                                         points_for, result_code, try_int)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_exact_round_ratio_half_up_and_null_guard(spark):
    data = [(23, 40), (41, 40), (1, 3), (2, 3), (0, 5), (5, 0), (None, 4), (7, None)]
    got = one(spark, exact_round_ratio("a", "b", 2).alias("r"), data, "a long, b long")
    # 23/40 -> 0.58; a tie rounds half up; zero or null denominator -> null.
    assert got == [0.58, 1.03, 0.33, 0.67, 0.0, None, None, None]


def test_exact_round_ratio_percent(spark):
    data = [(1, 3), (2, 3), (1, 8), (3, 3)]
    got = one(spark, exact_round_ratio("a", "b", 1, scale=100).alias("r"), data, "a long, b long")
    assert got == [33.3, 66.7, 12.5, 100.0]


def test_first_nonblank_and_nonzero(spark):
    data = [("", "x"), (None, "y"), (" ", "z"), (None, None)]
    got = one(spark, first_nonblank("a", "b", default="NA"), data, "a string, b string")
    assert got == ["x", "y", " ", "NA"]          # " " is truthy, as in Python
    nums = [(0, 9), (None, 7), (3, 1), (0, None)]
    got = one(spark, first_nonzero("a", "b"), nums, "a int, b int")
    assert got == [9, 7, 3, None]


def test_result_codes_and_points(spark):
    data = [("HOME_TEAM",), ("AWAY_TEAM",), ("DRAW",), (None,), ("x",)]
    assert one(spark, result_code("w"), data, "w string") == ["W", "L", "D", None, None]
    codes = [("W",), ("L",), ("D",), (None,)]
    assert one(spark, flip_result("r"), codes, "r string") == ["L", "W", "D", "D"]
    assert one(spark, points_for("r"), codes, "r string") == [3, 0, 1, 0]
    pts = [(10,), (9,), (5,), (4,), (None,)]
    assert one(spark, form_label("p"), pts, "p int") == ["Good", "Average", "Average", "Poor", "Poor"]


def test_eq_flag_null_is_false(spark):
    data = [("FINISHED",), (None,), ("SCHEDULED",)]
    assert one(spark, eq_flag("s", "FINISHED"), data, "s string") == [True, False, False]


def test_array_helpers(spark):
    schema = "a array<struct<code:string,id:int>>"
    data = [([("PL", 1), ("CL", 2)],), ([("PD", 3)],), ([],), (None,)]
    got = one(spark, first_matching("a", lambda c: c["code"] == "CL")["id"], data, schema)
    assert got == [2, 3, None, None]


def test_try_int_never_raises(spark):
    data = [("12",), ("x",), ("99999999999",), (None,)]
    assert one(spark, try_int("s"), data, "s string") == [12, None, None, None]
    assert one(spark, try_int(F.col("v")), [(2 ** 40,), (5,)], "v long") == [None, 5]
