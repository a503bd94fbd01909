"""Property tests: the distributed rank and the segmented scan equal the
plain single-task windows for random data, skew, nulls and partition counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.operators.ranking import global_row_number
from medallion.operators.sequence import running_stats

from .conftest import rows
from .plain import running_stats_window

row = st.tuples(st.one_of(st.none(), st.integers(0, 3)),   # group (nullable, few values)
                st.one_of(st.none(), st.integers(0, 5)),   # order key with ties and nulls
                st.integers(-3, 3))                        # value
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


@SETTINGS
@given(data=st.lists(row, min_size=1, max_size=60), parts=st.integers(1, 12),
       n=st.integers(1, 6))
def test_running_stats_property(spark, data, parts, n):
    df = spark.createDataFrame([(i, g, d, v) for i, (g, d, v) in enumerate(data)],
                               "id long, g int, d int, v int")
    order = [F.col("d").asc_nulls_last(), F.col("id")]
    got = running_stats(df, ["g"], order, {"v": F.col("v")}, n, num_partitions=parts)
    want = running_stats_window(df, ["g"], order, {"v": F.col("v")}, n)
    cols = ["id", "seq_no", "cum_v", "last_n_v"]
    assert rows(got, *cols) == rows(want, *cols)


@SETTINGS
@given(data=st.lists(row, min_size=1, max_size=80), parts=st.integers(1, 12))
def test_global_row_number_property(spark, data, parts):
    df = spark.createDataFrame([(i, g, d, v) for i, (g, d, v) in enumerate(data)],
                               "id long, g int, d int, v int")
    order = [F.col("d").desc_nulls_last(), F.col("g").asc_nulls_first(), F.col("id")]
    got = global_row_number(df, order, "rk", num_partitions=parts)
    want = df.withColumn("rk", F.row_number().over(Window.orderBy(*order)).cast("int"))
    assert rows(got, "id", "rk") == rows(want, "id", "rk")


match_row = st.tuples(st.integers(0, 6), st.integers(0, 6),            # home, away team
                      st.one_of(st.none(), st.integers(0, 4)),           # home goals
                      st.integers(0, 4),                                 # away goals
                      st.booleans(),                                     # finished
                      st.one_of(st.none(), st.integers(1, 20)))          # day


@SETTINGS
@given(data=st.lists(match_row, min_size=1, max_size=40))
def test_standings_invariants_property(spark, data):
    import datetime as dt
    from medallion.plans import gold
    mrows = []
    for i, (h, a, hs, as_, fin, day) in enumerate(data):
        if h == a:
            continue
        res = None if hs is None else ("W" if hs > as_ else "L" if hs < as_ else "D")
        mrows.append((i, dt.date(2024, 9, day) if day else None, fin, h, f"T{h}", f"S{h}",
                     a, f"T{a}", f"S{a}", hs, as_ if hs is not None else None, res))
    if not mrows:
        return
    m = spark.createDataFrame(mrows, "match_id long, match_date date, is_finished boolean, "
                              "home_team_id long, home_team_name string, home_team_short string, "
                              "away_team_id long, away_team_name string, away_team_short string, "
                              "home_score_ft int, away_score_ft int, home_result string")
    st_rows = gold.standings(m).collect()
    assert sum(r["goals_for"] for r in st_rows) == sum(r["goals_against"] for r in st_rows)
    assert sum(r["won"] for r in st_rows) == sum(r["lost"] for r in st_rows)
    assert sum(r["drawn"] for r in st_rows) % 2 == 0
    with_result = sum(1 for r in mrows if r[2] and r[11] is not None)
    assert sum(r["won"] + r["drawn"] + r["lost"] for r in st_rows) == 2 * with_result
    ordered = sorted(st_rows, key=lambda r: r["position"])
    assert [r["position"] for r in ordered] == list(range(1, len(st_rows) + 1))
    keys = [(-r["points"], -r["goal_difference"], -r["goals_for"]) for r in ordered]
    assert keys == sorted(keys)
    for r in gold.team_form(m).collect():
        assert r["points_last_5"] <= r["total_points"]
    order = [F.col("points").desc(), F.col("goal_difference").desc(), F.col("goals_for").desc(),
             F.col("team_id").asc_nulls_last(), F.col("team_name").asc_nulls_last(),
             F.col("team_short").asc_nulls_last()]
    plain = gold.standings_totals(m).withColumn("position", F.row_number().over(Window.orderBy(*order)))
    assert rows(plain, "team_id", "team_name", "position") == \
        sorted(((r["team_id"], r["team_name"], r["position"]) for r in st_rows),
               key=lambda t: tuple((x is None, x) for x in t))
