import datetime as dt

import pytest
from core_data import SF_MID, rows

from tidemart.operators.merge import merge
from tidemart.sources import fixtures as fx

T = dt.datetime
SCHEMA = "id long, v string, updated_at timestamp_ntz"


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([
        (1, "t1", T(2020, 1, 5)),   # source older  -> guarded keeps
        (2, "t2", T(2020, 1, 5)),   # source equal  -> guarded keeps
        (3, "t3", T(2020, 1, 5)),   # source newer  -> update
        (4, "t4", None),            # NULL stamp in target -> guarded keeps
        (5, "t5", T(2020, 1, 5)),   # NULL stamp in source -> guarded keeps
        (6, "t6", T(2020, 1, 5)),   # no source row -> untouched
        (None, "tn", T(2020, 1, 5)),  # NULL key never matches
    ], SCHEMA)


@pytest.fixture()
def source(spark):
    return spark.createDataFrame([
        (1, "s1", T(2020, 1, 4)), (2, "s2", T(2020, 1, 5)), (3, "s3", T(2020, 1, 6)),
        (4, "s4", T(2020, 1, 6)), (5, "s5", None), (7, "s7", T(2020, 1, 1)),
        (None, "sn", T(2020, 1, 1)),
    ], SCHEMA)


def test_guarded(spark, target, source):
    out = merge(target, source, version_col="updated_at", action_col="a")
    assert rows(out, "id", "v", "a") == [
        (None, "sn", "insert"), (None, "tn", "untouched"), (1, "t1", "keep"), (2, "t2", "keep"),
        (3, "s3", "update"), (4, "t4", "keep"), (5, "t5", "keep"), (6, "t6", "untouched"),
        (7, "s7", "insert")]
    assert out.columns == ["id", "v", "updated_at", "a"]


def test_unguarded(spark, target, source):
    out = merge(target, source)
    assert rows(out, "id", "v") == [
        (None, "sn"), (None, "tn"), (1, "s1"), (2, "s2"), (3, "s3"), (4, "s4"), (5, "s5"),
        (6, "t6"), (7, "s7")]


def test_duplicate_source_key_raises(spark, target):
    dup = spark.createDataFrame([(1, "a", T(2020, 1, 6)), (1, "b", T(2020, 1, 7))], SCHEMA)
    with pytest.raises(Exception, match="more than one row for some id"):
        merge(target, dup, version_col="updated_at").collect()
    with pytest.raises(ValueError):
        merge(target, dup, dedup=True)
    out = merge(target, dup, version_col="updated_at", dedup=True)
    assert rows(out.filter("id = 1"), "v") == [("b",)]


def test_update_columns_keep_others(spark, target, source):
    out = merge(target, source, update_columns=["updated_at"])
    assert rows(out.filter("id = 3"), "v", "updated_at") == [("t3", T(2020, 1, 6))]


def test_dedup_keeps_null_keys(spark, target):
    source = spark.createDataFrame([(None, "n1", T(2020, 1, 1)), (None, "n2", T(2020, 1, 2)), (1, "old", T(2020, 1, 7)), (1, "new", T(2020, 1, 8))], SCHEMA)
    out = merge(target, source, version_col="updated_at", dedup=True)
    assert rows(out.filter("id IS NULL OR id = 1"), "id", "v") == [(None, "n1"), (None, "n2"), (None, "tn"), (1, "new")]


def test_a_column_that_the_source_lacks_is_kept(spark, target, source):
    out = merge(target, source.select("id", "updated_at"))
    assert rows(out.filter("id IN (3, 7)"), "id", "v", "updated_at") == [(3, "t3", T(2020, 1, 6)), (7, None, T(2020, 1, 1))]
    with pytest.raises(ValueError):
        merge(target, source.select("id", "updated_at"), update_columns=["v"])


def test_fixture_merge_has_every_case(spark):
    image, changes = fx.products_image(spark, SF_MID), fx.products_changes(spark, SF_MID)
    out = merge(image, changes, version_col="updated_at", action_col="a")
    counts = {r["a"]: r["count"] for r in out.groupBy("a").count().collect()}
    assert set(counts) == {"update", "insert", "keep"} and min(counts.values()) > 100
    unguarded = merge(image, changes)
    assert out.drop("a").exceptAll(unguarded).count() > 100


def test_each_side_is_read_once(spark, target, source):
    plan = merge(target, source, version_col="updated_at")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 2
