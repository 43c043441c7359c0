import datetime as dt

import pytest
from core_data import rows

from tidemart.operators.asof import asof_join, version_intervals

T = dt.datetime


@pytest.fixture()
def sides(spark):
    versions = spark.createDataFrame([
        (10, T(2020, 1, 1), "v1"),
        (10, T(2020, 1, 5), "v2"),
        (10, T(2020, 1, 5), "v2b"),  # duplicate stamp: reduced to one version
        (20, T(2020, 1, 3), "w1"),
        (None, T(2020, 1, 1), "nullkey"),
        (20, None, "nullstamp"),
    ], "id long, updated_at timestamp_ntz, attr string")
    facts = spark.createDataFrame([
        (1, 10, T(2019, 12, 31)),   # before the first version
        (2, 10, T(2020, 1, 1)),     # exactly at a version
        (3, 10, T(2020, 1, 3)),     # between two versions
        (4, 10, T(2020, 2, 1)),     # after the last version
        (5, 99, T(2020, 1, 3)),     # unknown product
        (6, None, T(2020, 1, 3)),   # NULL key never matches
        (7, 20, None),              # NULL time never matches
        (8, 20, T(2020, 1, 3)),
    ], "sale long, product_id long, created_at timestamp_ntz")
    return facts, versions


EXPECTED = [(1, None), (2, "v1"), (3, "v1"), (4, "v2b"), (5, None), (6, None), (7, None), (8, "w1")]


@pytest.mark.parametrize("bucket", ["month", "day"])
def test_asof_edges(spark, sides, bucket):
    facts, versions = sides
    out = asof_join(facts, versions, fact_key="product_id", version_key="id",
                    fact_time="created_at", version_time="updated_at", columns=["attr"], bucket=bucket)
    assert out.count() == facts.count()
    assert rows(out, "sale", "attr") == EXPECTED


def test_times_before_1970_and_no_rows(spark, sides):
    facts, versions = sides
    early = spark.createDataFrame([(7, T(1969, 12, 20), "x")], "id long, updated_at timestamp_ntz, attr string")
    sales = spark.createDataFrame([(1, 7, None), (2, 7, T(1969, 12, 30)), (3, 7, T(1980, 1, 1)), (4, None, None)], facts.schema)
    kw = dict(fact_key="product_id", version_key="id", fact_time="created_at", version_time="updated_at", columns=["attr"])
    for bucket in ("month", "day"):
        assert rows(asof_join(sales, early, bucket=bucket, **kw), "sale", "attr") == [(1, None), (2, "x"), (3, "x"), (4, None)]
    assert rows(asof_join(facts, versions.limit(0), **kw), "attr") == [(None,)] * facts.count()
    assert asof_join(facts.limit(0), versions, **kw).count() == 0


def test_one_shuffle_of_the_facts(spark):
    facts = spark.range(100).selectExpr("id AS sale", "id % 7 AS product_id", "timestamp_ntz '2020-01-01' AS created_at")
    versions = spark.range(20).selectExpr("id", "timestamp_ntz '2019-01-01' AS updated_at", "'a' AS attr")
    out = asof_join(facts, versions, fact_key="product_id", version_key="id", fact_time="created_at",
                    version_time="updated_at", columns=["attr"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Generate" not in plan
    assert plan.count("REPARTITION_BY_COL") == 1
    # besides the rows themselves, the table of buckets: by bucket, then by key, which also serves the join
    assert plan.count("Exchange hashpartitioning") <= 4


def test_the_shuffles_carry_no_value_twice_and_no_empty_hand_over(spark, sides):
    facts, versions = sides
    kw = dict(fact_key="product_id", version_key="id", fact_time="created_at", version_time="updated_at", columns=["attr"])
    plan = asof_join(facts, versions, **kw)._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression"):].split("Join")[0]
    assert not any(f"AS {c}#" in dealt for c in ("__key", "__t", "__kind", "__tb0"))
    assert "isnotnull(__before" in plan


@pytest.mark.parametrize("bucket", ["month", "day"])
def test_keys_and_times_of_other_types(spark, sides, bucket):
    facts, versions = sides
    kw = dict(fact_key="product_id", version_key="id", fact_time="created_at", version_time="updated_at", columns=["attr"], bucket=bucket)
    narrow = facts.selectExpr("sale", "CAST(product_id AS int) product_id", "created_at")
    out = asof_join(narrow, versions, **kw)
    assert out.schema["product_id"].dataType == narrow.schema["product_id"].dataType
    assert rows(out, "sale", "attr") == EXPECTED
    daily = versions.selectExpr("id", "CAST(updated_at AS date) updated_at", "attr")
    assert rows(asof_join(facts, daily, **kw), "sale", "attr") == EXPECTED
    own = asof_join(facts, versions.filter("attr <> 'v2'"), version_time_as="created_at_of", **kw)  # the version's time beside the fact's
    assert own.columns == [*facts.columns, "attr", "created_at_of"]


def test_intervals(spark, sides):
    _, versions = sides
    iv = version_intervals(versions)
    got = rows(iv, "id", "valid_from", "valid_to", "is_current")
    assert got == [
        (10, T(2020, 1, 1), T(2020, 1, 5), False),
        (10, T(2020, 1, 5), None, True),
        (20, T(2020, 1, 3), None, True),
    ]


@pytest.mark.parametrize("bucket", ["month", "day"])
def test_many_hot_keys_against_the_definition(spark, bucket):
    from pyspark.sql import functions as F

    # One key holds a third of both sides; 1,200 more have several versions each.
    n = 9000
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1200 + 2)
    stamp = lambda step: F.expr(f"timestamp_ntz '2020-01-01' + make_interval(0, 0, 0, id * {step} % 300, 0, 0, id % 86400)")
    facts = spark.range(n).select(F.col("id").alias("sale"), key.alias("product_id"), stamp(7).alias("created_at"))
    versions = spark.range(n).select(key.alias("id"), stamp(13).alias("updated_at"), F.concat(F.lit("v"), F.col("id")).alias("attr"))
    got = asof_join(facts, versions, fact_key="product_id", version_key="id", fact_time="created_at",
                    version_time="updated_at", columns=["attr"], version_time_as="vt", bucket=bucket).collect()
    assert len(got) == n
    held = {}
    for v in versions.collect():
        held.setdefault(v.id, []).append((v.updated_at, v.attr))
    held = {k: sorted(v) for k, v in held.items()}
    for r in got:  # the greatest version time not after the sale
        before = [v for v in held.get(r.product_id, []) if v[0] <= r.created_at]
        assert (r.vt, r.attr) == (before[-1] if before else (None, None))
    intervals = version_intervals(versions, bucket=bucket).collect()
    times = {k: sorted({t for t, _ in v}) for k, v in held.items()}
    assert len(intervals) == sum(map(len, times.values()))
    for r in intervals:
        after = [t for t in times[r.id] if t > r.valid_from]
        assert r.valid_to == (after[0] if after else None) and r.is_current == (not after)


def test_versions_of_earlier_months(spark):
    versions = spark.createDataFrame([
        (1, T(2020, 1, 15), "A"), (1, T(2020, 4, 10), "B"), (2, T(2019, 11, 30, 23), "C"),
        (2, T(2020, 3, 1), "D")], "id long, updated_at timestamp_ntz, attr string")
    facts = spark.createDataFrame([
        (1, 1, T(2020, 1, 10)),   # before A
        (2, 1, T(2020, 2, 20)),   # A, in a month without versions
        (3, 1, T(2020, 4, 9)),    # A, in the month in which it ends
        (4, 1, T(2020, 4, 10)),   # exactly at B
        (5, 1, T(2021, 6, 1)),    # B, long after (current version)
        (6, 2, T(2020, 2, 29, 23, 59, 59)),  # C, last second before D
        (7, 2, T(2020, 3, 1)),    # D
    ], "sale long, product_id long, created_at timestamp_ntz")
    out = asof_join(facts, versions, fact_key="product_id", version_key="id", fact_time="created_at",
                    version_time="updated_at", columns=["attr"], version_time_as="vt")
    assert rows(out, "sale", "attr") == [(1, None), (2, "A"), (3, "A"), (4, "B"), (5, "B"), (6, "C"), (7, "D")]


def test_each_source_is_scanned_once(spark):
    """The rows and the buckets of the facts come from one exchange: lineitem, orders and part are scanned once each."""
    from core_data import SF_SMALL

    from tidemart.plans import catalog

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for query in (catalog.asof_join_month, catalog.sales_report):
            plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan") == 3 and "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
