import datetime as dt
import os

from core_data import SF_MID, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import periods as pr
from tidemart.session import local_path, scratch_path
from tidemart.sources import fixtures as fx
from tidemart.sources.extract import extract_changes, extract_window, read_jdbc, read_seed
from tidemart.sources.types import apply_type_policy, target_type

D = dt.datetime


def test_fixture_known_numbers(spark):
    items = fx.order_items_source(spark, SF_MID)
    r = items.agg(F.count("*"), F.countDistinct("id"), F.sum("sale_price"), F.count("returned_at")).first()
    assert (r[0], r[1], str(r[2]), r[3]) == (60000, 45832, "3183256271.63", 20046)
    delta = fx.products_delta(spark, SF_MID)
    r = delta.agg(F.count("*"), F.countDistinct("id"), F.countDistinct("updated_at")).first()
    assert tuple(r) == (8000, 2000, 8000)


def test_parts_of_one_file_are_dealt_out_before_their_versions_are_made(spark, tmp_path):
    parts = spark.range(400).selectExpr("id AS p_partkey", "concat('n', id) AS p_name", "'t' AS p_type", "1.5D AS p_retailprice")
    nulls = spark.range(3).selectExpr("CAST(null AS long)", "CAST(null AS string)", "'t'", "CAST(null AS double)")
    parts.union(nulls).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tiny inputs are merged again
    try:
        delta = fx.products_delta(spark, str(tmp_path))
        sizes = [n for n in delta.rdd.mapPartitions(lambda r: [sum(1 for _ in r)]).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4 * 403 and len(sizes) > 1 and max(sizes) < 4 * 403 // 2
    assert delta.filter("id IS NULL").count() == 12


def test_change_window_arithmetic():
    assert pr.change_window("2023-02-12 10:15:42") == (D(2023, 2, 12, 9), D(2023, 2, 12, 10))
    assert pr.window_prefix(D(2023, 2, 12, 9)) == "2023-02-12/09:00:00"
    assert pr.day_ranges(["2020-01-02", "2020-01-01", "2020-01-05"]) == [
        (dt.date(2020, 1, 1), dt.date(2020, 1, 3)), (dt.date(2020, 1, 5), dt.date(2020, 1, 6))]
    assert pr.yesterday("2020-03-01") == dt.date(2020, 2, 29)


def test_window_bounds(spark):
    df = spark.createDataFrame([
        (1, D(2020, 1, 1, 9)),                       # start: in
        (2, D(2020, 1, 1, 10)),                      # end: out
        (3, D(2020, 1, 1, 9, 59, 59, 999999)),       # one microsecond before end: in
        (4, None),
    ], "id long, updated_at timestamp_ntz")
    start, end = pr.change_window("2020-01-01 10:15:00")
    out = extract_changes(df, "updated_at", start, end)
    assert rows(out, "id", "load_date", "load_hour") == [
        (1, "2020-01-01", "09:00:00"), (3, "2020-01-01", "09:00:00")]


def test_window_filter_reaches_parquet_scan(spark):
    items = fx.read_table(spark, SF_MID, "lineitem")
    plan = extract_window(items, "l_shipdate", "1996-01-01", "1996-02-01") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_type_policy(spark):
    df = spark.createDataFrame(
        [(1, 2, 1.5, D(2020, 1, 1, 0, 0, 1, 500000), [1, 2], "x")],
        "a int, b short, c float, t timestamp_ntz, arr array<int>, s string")
    out = apply_type_policy(df, truncate_seconds=True)
    assert [f.dataType for f in out.schema.fields] == [
        T.LongType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(),
        T.ArrayType(T.LongType(), True), T.StringType()]
    assert out.first()["t"] == D(2020, 1, 1, 0, 0, 1)
    assert target_type(T.DecimalType(18, 2)) == T.DecimalType(18, 2)
    assert target_type(T.DecimalType(18, 2), decimal_as_double=True) == T.DoubleType()
    assert target_type(T.MapType(T.StringType(), T.StringType())) == T.StringType()


def test_seed_csv(spark):
    path = scratch_path(spark, "seed")
    os.makedirs(local_path(path))
    with open(local_path(path) + "/provinces.csv", "w") as fh:
        fh.write("city,lat,lng,country,iso2,admin_name,capital,population,population_proper\n")
        fh.write("Hanoi,21.0283,105.8542,Vietnam,VN,Ha Noi,primary,8053663,8053663\n")
    seed = read_seed(spark, path)
    assert seed.schema["population"].dataType == T.LongType()
    assert seed.first()["city"] == "Hanoi"


def test_jdbc_partitioned_window_extract(spark):
    url = "jdbc:derby:memory:tidemart_test;create=true"
    items = fx.order_items_source(spark, SF_MID).select("id", "product_id", "created_at", "sale_price")
    items.write.format("jdbc").option("url", url).option("dbtable", "ORDER_ITEMS") \
        .mode("overwrite").save()
    snap = read_jdbc(spark, url, "ORDER_ITEMS", partition_column="id", lower_bound=0,
                     upper_bound=600000, num_partitions=4,
                     properties={"preferTimestampNTZ": "true"})
    assert snap.rdd.getNumPartitions() == 4
    assert snap.count() == 60000
    unbounded = read_jdbc(spark, url, "ORDER_ITEMS", partition_column="\"id\"", num_partitions=3,
                          properties={"preferTimestampNTZ": "true"})
    assert unbounded.rdd.getNumPartitions() == 3 and unbounded.count() == 60000
    window = extract_window(snap, "created_at", "1997-01-01", "1998-01-01")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "*GreaterThanOrEqual(created_at" in plan and "*LessThan(created_at" in plan
    expected = extract_window(items, "created_at", "1997-01-01", "1998-01-01").count()
    assert window.count() == expected


def test_window_keys_ignore_session_time_zone(spark):
    df = spark.createDataFrame([(1, D(1997, 4, 6, 2, 7, 42))], "id long, updated_at timestamp_ntz")
    key = "spark.sql.session.timeZone"
    previous = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")  # 02:07:42 falls in this zone's DST gap
    try:
        got = extract_changes(df, "updated_at", "1997-04-06", "1997-04-07") \
            .select("load_date", "load_hour", pr.prefix_col("updated_at").alias("p")).first()
    finally:
        spark.conf.set(key, previous)
    assert tuple(got) == ("1997-04-06", "02:00:00", "1997-04-06/02:07:42")


def test_day_list_becomes_pushed_ranges(spark):
    items = fx.read_table(spark, SF_MID, "lineitem")
    days = ["1996-01-01", "1996-01-02", "1996-01-03", "1996-02-10"]
    df = items.filter(pr.day_in("l_shipdate", days))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(l_shipdate,1996-01-01T00:00),LessThan(l_shipdate,1996-01-04T00:00))" in plan
    expected = items.filter(F.to_date("l_shipdate").isin([dt.date.fromisoformat(d) for d in days]))
    assert df.count() == expected.count() > 0


def test_cluster_conf_sizes_partitions():
    from tidemart.session import cluster_conf

    conf = cluster_conf(largest_shuffle_bytes=100 * 1024 ** 4, executor_cores_total=4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600      # 100 TiB / 256 MiB
    assert conf["spark.sql.adaptive.enabled"] == "true"
    small = cluster_conf(largest_shuffle_bytes=10 ** 9, executor_cores_total=4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000        # two waves of cores


def test_full_and_hourly_loads_from_a_stored_source(spark):
    from tidemart.plans.jobs import full_load, hourly_change_load
    from tidemart.sinks.tables import HourTable, ImageTable

    root = scratch_path(spark, "loads")
    staged, delta = HourTable(spark, "tm_load_staged", f"{root}/staged"), HourTable(spark, "tm_load_delta", f"{root}/delta")
    products = fx.products_delta(spark, SF_MID).select("id", "brand", "cost", "updated_at")
    products.write.parquet(f"{root}/source")
    source = spark.read.parquet(f"{root}/source")
    main = ImageTable(spark, "tm_load_main", f"{root}/main")
    full_load(source, f"{root}/full", main, max_records_per_file=1000)
    assert main.read().count() == products.count()
    assert main.read().schema["id"].dataType == T.LongType()
    stamps = [r[0] for r in products.select("updated_at").orderBy("updated_at").limit(2).collect()]
    windows = []
    for stamp in stamps:  # a run one hour after a real change: its window holds it
        run_time = stamp + dt.timedelta(hours=1, minutes=15)
        prefixes = hourly_change_load(source, "updated_at", run_time, staged, delta)
        windows.append(pr.change_window(run_time))
        assert prefixes == [pr.window_prefix(windows[-1][0])]
    held = delta.read()
    expected = [pr.in_window("updated_at", *w) for w in windows]
    assert rows(held) == rows(products.filter(expected[0] | expected[1]).select(*held.columns))
    assert held.count() > 0


def test_truncated_seconds_ignore_the_session_zone(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 7, 42, 500000),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert apply_type_policy(frame, truncate_seconds=True).first()[0] == dt.datetime(2024, 3, 10, 2, 7, 42)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
