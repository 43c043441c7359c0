import datetime as dt

from core_data import rows

from tidemart.operators.latest import keep_latest, keep_latest_per_day

T = dt.datetime


def test_latest_per_key_with_tie_and_nulls(spark):
    df = spark.createDataFrame([
        (1, T(2020, 1, 1, 10), "a"),
        (1, T(2020, 1, 1, 12), "b"),
        (2, T(2020, 1, 2, 9), "x"),   # tie on stamp: tie-break by other columns (desc)
        (2, T(2020, 1, 2, 9), "y"),
        (3, None, "n"),               # NULL stamp loses to any stamp
        (3, T(2020, 1, 3), "m"),
        (None, T(2020, 1, 4), "k"),   # NULL key is its own group
    ], "id long, updated_at timestamp_ntz, v string")
    out = rows(keep_latest(df, ["id"], "updated_at"), "id", "v")
    assert out == [(None, "k"), (1, "b"), (2, "y"), (3, "m")]


def test_latest_per_day_and_day_list(spark):
    df = spark.createDataFrame([
        (1, T(2020, 1, 1, 1), "a"), (1, T(2020, 1, 1, 5), "b"),
        (1, T(2020, 1, 2, 1), "c"), (2, T(2020, 1, 2, 23, 59, 59), "d"),
    ], "id long, updated_at timestamp_ntz, v string")
    all_days = rows(keep_latest_per_day(df, "id", "updated_at"), "id", "v")
    assert all_days == [(1, "b"), (1, "c"), (2, "d")]
    one_day = rows(keep_latest_per_day(df, "id", "updated_at", ["2020-01-02"]), "id", "v")
    assert one_day == [(1, "c"), (2, "d")]


def test_top1_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS id", "timestamp_ntz '2020-01-01' + make_interval(0,0,0,0,0,0,id) AS updated_at", "id AS v")
    plan = keep_latest(df, ["id"], "updated_at")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
