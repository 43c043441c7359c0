import datetime as dt
import glob
import os
import uuid

import pytest
from core_data import rows

from tidemart.session import local_path, scratch_path
from tidemart.sources.extract import read_staged
from tidemart.sinks.tables import (DayTable, HourTable, ImageTable, KeyTable, PartitionTable, create_view, overwrite_table,
                                   stage_parquet, write_incremental)

T = dt.datetime
SCHEMA = "id long, created_at timestamp_ntz, v string"


def _facts(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _own(kind, spark, *args, **kw):
    name = f"tm_{uuid.uuid4().hex[:12]}"
    return kind(spark, name, scratch_path(spark, name), *args, **kw)


def _locations(table):
    """Partition -> folder, as readers find it in the catalog now."""
    spark, files = table.spark, table._raw().inputFiles()
    assert spark.catalog.tableExists(table.name)
    return {name: {f.rpartition("/")[0] for f in files if f"/{name}/" in f} for name in table.partitions()}


def test_staged_files_are_capped_and_empty_is_readable(spark):
    path = scratch_path(spark, "stage")
    stage_parquet(spark.range(2500).coalesce(1), path, max_records_per_file=1000)
    assert len(glob.glob(local_path(path) + "/*.parquet")) == 3
    empty_path = scratch_path(spark, "stage-empty")
    stage_parquet(spark.range(0).selectExpr("id", "'x' AS v"), empty_path)
    back = spark.read.parquet(empty_path)
    assert back.count() == 0 and back.columns == ["id", "v"]


def test_window_layout(spark):
    path = scratch_path(spark, "layout")
    df = spark.createDataFrame([(1, "1996-01-01", "05:00:00")], "id long, load_date string, load_hour string")
    stage_parquet(df, path, partition_by=["load_date", "load_hour"])
    assert os.path.isdir(local_path(path) + "/load_date=1996-01-01/load_hour=05%3A00%3A00")
    back = read_staged(spark, path, schema=df.schema, load_hour="05:00:00")
    assert back.count() == 1 and back.schema == df.schema


def test_catalog_table_and_view(spark):
    df = _facts(spark, [(1, T(2020, 1, 1), "a")])
    overwrite_table(df, "tm_table_test")
    overwrite_table(df.union(df), "tm_table_test")       # replace, not append
    assert spark.table("tm_table_test").count() == 2
    view = create_view(spark.table("tm_table_test").filter("id = 1"), "tm_view_test")
    assert view.count() == 2
    spark.sql("DROP TABLE tm_table_test")


def test_replace_days_static_list(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [
        (1, T(2020, 1, 1, 1), "old"), (2, T(2020, 1, 2, 1), "old"), (3, T(2020, 1, 3, 1), "old")]))
    # Day 2 gets new rows, day 3 is listed but empty -> removed, day 1 untouched.
    new = _facts(spark, [(4, T(2020, 1, 2, 5), "new"), (5, T(2020, 1, 9), "other-day")])
    table.replace_days(new, ["2020-01-02", "2020-01-03"])
    assert rows(table.read(), "id", "v") == [(1, "old"), (4, "new"), (5, "other-day")]
    assert rows(table.read(days=["2020-01-02"]), "id") == [(4,)]


def test_empty_source_removes_day_and_reload_is_idempotent(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b")]))
    table.replace_days(_facts(spark, []), ["2020-01-02"])
    assert rows(table.read(), "id") == [(1,)]
    day = _facts(spark, [(7, T(2020, 1, 1, 3), "x")])
    table.reload_day(day, "2020-01-01")
    table.reload_day(day, "2020-01-01")
    assert rows(table.read(), "id") == [(7,)]


def test_delete_day(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b")]))
    table.delete_days(["2020-01-01", "2020-01-05"])
    assert rows(table.read(), "id") == [(2,)]


def test_write_incremental_and_pruning(spark):
    table = _own(DayTable, spark, "created_at")
    first = _facts(spark, [(1, T(2020, 1, 1), "a")])
    assert write_incremental(table, first, ["2020-01-01"]) == "created"
    assert write_incremental(table, _facts(spark, [(2, T(2020, 1, 1), "b")]), ["2020-01-01"]) == "replaced"
    assert rows(table.read(), "id") == [(2,)]
    plan = table.read(days=["2020-01-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_image_table_is_replaced_at_once_and_may_read_itself(spark):
    table = _own(ImageTable, spark)
    assert not table.exists()
    table.replace(_facts(spark, [(1, T(2020, 1, 1), "a")]))
    old = table.read()
    table.replace(table.read().selectExpr("id + 1 AS id", "created_at", "v"))
    assert rows(table.read(), "id") == [(2,)]
    assert rows(old, "id") in ([(1,)], [(2,)])  # a reader of the old image still finds its files


HOURS = [(1, T(2020, 1, 1, 9, 10), "a"), (2, T(2020, 1, 1, 9, 50), "b"), (3, T(2020, 1, 1, 10, 0), "c"),
         (4, T(2020, 1, 1, 13, 0), "d"), (5, T(2020, 1, 1, 14, 59), "e"), (6, T(2020, 1, 1, 15, 0), "f")]


def _hours(spark):
    from tidemart.plans.jobs import hourly_change_load

    staged, delta = _own(HourTable, spark), _own(HourTable, spark)
    return delta, lambda source, at, **kw: hourly_change_load(source, "created_at", at, staged, delta, **kw)


def test_hourly_change_load_keeps_hours_and_reruns(spark):
    source = _facts(spark, HOURS)
    delta, load = _hours(spark)
    assert load(source, "2020-01-01 10:15:00") == ["2020-01-01/09:00:00"]
    assert rows(delta.read(), "id") == [(1,), (2,)] and delta.hours() == {("2020-01-01", "09:00:00")}
    load(source, "2020-01-01 11:15:00")
    for _ in range(2):  # a rerun of an hour doubles nothing
        load(source, "2020-01-01 10:15:00")
        assert rows(delta.read(), "id") == [(1,), (2,), (3,)]
    load(_facts(spark, HOURS[1:]), "2020-01-01 10:15:00")  # the source lost a row
    assert rows(delta.read(), "id") == [(2,), (3,)]
    load(_facts(spark, []), "2020-01-01 10:15:00")  # and then the hour's last one
    assert rows(delta.read(), "id") == [(3,)]


def test_hourly_change_load_of_several_hours(spark):
    source = _facts(spark, HOURS)
    delta, load = _hours(spark)
    assert len(load(source, "2020-01-01 15:00:00", hours=6)) == 6
    assert rows(delta.read(), "id") == [(1,), (2,), (3,), (4,), (5,)]
    load(source, "2020-01-01 16:00:00", replace=True)  # the literal form holds the last window alone
    assert rows(delta.read(), "id") == [(6,)]


def test_rows_committed_after_their_window_are_loaded_once(spark):
    """A late row, a row that repeats in the source, a version that the source has overwritten, and reruns."""
    from tidemart.plans.jobs import late_change_load

    delta = _own(HourTable, spark)
    early = [(1, T(2020, 1, 1, 9, 10), "a"), (2, T(2020, 1, 1, 9, 50), "b"), (2, T(2020, 1, 1, 9, 50), "b")]
    late_change_load(_facts(spark, early), "created_at", "2020-01-01 10:00:00", delta)
    later = [(2, T(2020, 1, 1, 9, 50), "b"), (2, T(2020, 1, 1, 9, 50), "b"), (3, T(2020, 1, 1, 8, 30), "late"),
             (4, T(2020, 1, 1, 10, 5), "now"), (1, T(2020, 1, 1, 10, 20), "a2"), (5, T(2020, 1, 1, 5, 0), "too late")]
    for _ in range(2):
        hours = late_change_load(_facts(spark, later), "created_at", "2020-01-01 11:00:00", delta)
        assert rows(delta.read(), "id", "v") == [(1, "a"), (1, "a2"), (2, "b"), (2, "b"), (3, "late"), (4, "now")]
    assert hours == ["2020-01-01/08:00:00", "2020-01-01/09:00:00", "2020-01-01/10:00:00"]
    assert ("2020-01-01", "08:00:00") in delta.hours()


def test_a_load_that_fails_its_checks_stays_uncommitted(spark):
    from tidemart.operators.quality import check_not_null, check_unique
    from tidemart.sinks.tables import LoadRejected

    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b")]))
    before = _locations(table)
    table.checks = {"unique id": lambda df: check_unique(df, "id"), "v not null": lambda df: check_not_null(df, "v")}
    bad = [[(5, T(2020, 1, 1), "x"), (5, T(2020, 1, 2), "y")], [(6, T(2020, 1, 1), None)]]
    for load, reason in zip(bad, ("unique id fails for 1", "v not null fails for 1"), strict=True):
        with pytest.raises(LoadRejected, match=reason):
            table.replace_days(_facts(spark, load), ["2020-01-01", "2020-01-02"])
        assert _locations(table) == before and rows(table.read(), "id") == [(1,), (2,)]
    assert table.vacuum() == 0  # nothing of the refused loads is left
    table.replace_days(_facts(spark, [(7, T(2020, 1, 1), "x")]), ["2020-01-01"])
    assert rows(table.read(), "id") == [(2,), (7,)]


def test_rows_without_a_day_are_replaced_like_a_day(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, None, "b"), (3, T(2020, 2, 1), "c")]))
    new = _facts(spark, [(4, T(2020, 1, 1), "x"), (5, None, "y"), (6, None, "z")])
    for _ in range(2):
        table.replace_days(new)
        assert rows(table.read(), "id") == [(3,), (4,), (5,), (6,)]
    table.replace_days(_facts(spark, [(7, None, "w")]), ["2020-01-01"])  # the NULL day is not listed: rows are added
    assert rows(table.read(), "id") == [(3,), (5,), (6,), (7,)]


def test_a_replace_that_stops_leaves_every_day_old_or_new(spark, monkeypatch):
    """The driver dies after some of the catalog's statements; the same replace again finishes the work."""
    table = _own(DayTable, spark, "created_at")
    days = [dt.date(2020, 1, d) for d in range(1, 7)]
    table.create(_facts(spark, [(d.day, T(2020, 1, d.day), "old") for d in days]))
    new = _facts(spark, [(10 + d.day, T(2020, 1, d.day), "new") for d in days[:4]])  # two days are emptied
    real, calls = spark.sql, []

    def sql(text, *args, **kw):
        if "SET LOCATION" in text:
            calls.append(text)
            if len(calls) == 3:
                raise KeyboardInterrupt
        return real(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", sql)
    with pytest.raises(KeyboardInterrupt):
        table.replace_days(new, days)
    monkeypatch.setattr(spark, "sql", real)
    spark.catalog.refreshTable(table.name)
    for d in days:
        assert rows(table.read(days=[d]), "id", "v") in ([(d.day, "old")], [(10 + d.day, "new")])
    assert {v for _, v in rows(table.read(), "id", "v")} == {"old", "new"}
    table.replace_days(new, days)
    assert rows(table.read(), "id") == [(11,), (12,), (13,), (14,)]
    assert table.vacuum() == 2  # the first load and the one that stopped
    assert rows(table.read(), "id") == [(11,), (12,), (13,), (14,)]


def test_a_replace_that_stops_before_the_catalog_changes_nothing(spark, monkeypatch):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b")]))
    before = _locations(table)

    def stop(self, folder, filled):
        raise KeyboardInterrupt

    monkeypatch.setattr(PartitionTable, "_point", stop)
    with pytest.raises(KeyboardInterrupt):
        table.replace_days(_facts(spark, [(9, T(2020, 1, 1), "x")]), ["2020-01-01", "2020-01-02"])
    assert _locations(table) == before and rows(table.read(), "id") == [(1,), (2,)]


def test_a_running_reader_keeps_its_files(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a")]))
    files = table.read().inputFiles()
    table.replace_days(_facts(spark, [(2, T(2020, 1, 1), "b")]))
    assert all(os.path.exists(local_path(f)) for f in files)
    assert rows(spark.read.parquet(*files), "id") == [(1,)] and rows(table.read(), "id") == [(2,)]


def test_many_new_days_are_one_statement(spark, monkeypatch):
    table = _own(DayTable, spark, "created_at")
    real, seen = spark.sql, []
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: (seen.append(text), real(text, *a, **k))[1])
    table.create(_facts(spark, [(i, T(2020, 1, 1) + dt.timedelta(days=i), "a") for i in range(300)]))
    monkeypatch.setattr(spark, "sql", real)
    assert len([t for t in seen if t.startswith("ALTER")]) == 1
    assert table.read().count() == 300


def test_days_are_deleted_without_a_spark_job(spark):
    table = _own(DayTable, spark, "created_at")
    table.create(_facts(spark, [(i, T(2020, 1, 1 + i), "a") for i in range(20)]))
    spark.sparkContext.setJobGroup("delete-days", "")
    table.delete_days([f"2020-01-{d:02d}" for d in range(1, 20)])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("delete-days")
    spark.sparkContext.setJobGroup("other", "")
    assert len(jobs) == 0 and rows(table.read(), "id") == [(19,)]


def test_months_keep_day_semantics(spark):
    table = _own(DayTable, spark, "created_at", granularity="month")
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b"), (3, T(2020, 2, 1), "c"), (4, T(2020, 3, 1), "d"), (9, None, "n")]))
    assert len(table.partitions()) == 4
    before = _locations(table)
    # Jan 2 replaced, Feb 1 listed but empty -> gone, Jan 1 and Mar 1 untouched, a stray row added
    table.replace_days(_facts(spark, [(5, T(2020, 1, 2, 7), "new"), (6, T(2020, 1, 1, 9), "stray")]), ["2020-01-02", "2020-02-01"])
    assert rows(table.read(), "id") == [(1,), (4,), (5,), (6,), (9,)]
    assert rows(table.read(days=["2020-01-02"]), "id") == [(5,)]
    after = _locations(table)
    assert after["dt=2020-03-01"] == before["dt=2020-03-01"] and "dt=2020-02-01" not in after
    table.delete_days(["2020-01-01"])
    assert rows(table.read(), "id") == [(4,), (5,), (9,)]
    table.replace_days(_facts(spark, [(6, T(2020, 3, 1), "again"), (7, None, "m")]))  # days=None: Mar 1 and the NULL day
    assert rows(table.read(), "id") == [(5,), (6,), (7,)]


def test_a_refused_load_of_months_writes_its_stage_alone(spark, monkeypatch):
    from tidemart.operators.quality import check_not_null, check_unique
    from tidemart.sinks.tables import LoadRejected

    table = _own(DayTable, spark, "created_at", granularity="month")
    table.checks = {"unique id": lambda df: check_unique(df, "id"), "v not null": lambda df: check_not_null(df, "v")}
    table.create(_facts(spark, [(1, T(2020, 1, 1), "a"), (2, T(2020, 1, 2), "b"), (3, T(2020, 2, 1), "c")]))
    before, loads = _locations(table), []
    load = table._load
    monkeypatch.setattr(table, "_load", lambda *a, **kw: loads.append(1) or load(*a, **kw))
    # an id of its own, one that the month's other day has, and a NULL
    for rejected, reason in (([(5, T(2020, 1, 2), "x"), (5, T(2020, 1, 2), "y")], "unique id fails for 1"),
                             ([(1, T(2020, 1, 2), "x")], "unique id fails for 1"), ([(6, T(2020, 1, 2), None)], "v not null fails for 1")):
        with pytest.raises(LoadRejected, match=reason):
            table.replace_days(_facts(spark, rejected), ["2020-01-02"])
    assert not loads and _locations(table) == before and table.vacuum() == 0
    table.replace_days(_facts(spark, [(3, T(2020, 1, 2), "x")]), ["2020-01-02"])  # id 3 of another month is not judged with it
    assert loads and rows(table.read(), "id") == [(1,), (3,), (3,)]


IMAGE = "id long, v string, updated_at timestamp_ntz"


def _image(spark, buckets=8, n=40):
    table = _own(KeyTable, spark, buckets=buckets)
    table.create(spark.createDataFrame([(i, f"v{i}", T(2020, 1, 1 + i % 20)) for i in range(n)], IMAGE))
    return table


def test_merge_rewrites_only_buckets_in_which_a_row_changes(spark):
    table = _image(spark)
    before = _locations(table)
    bucket = {r["id"]: r["bucket"] for r in table._raw().collect()}
    source = spark.createDataFrame([(1, "new", T(2020, 2, 1)), (2, "late", T(2019, 1, 1)), (3, "same", T(2020, 1, 4))], IMAGE)
    assert table.merge(source, version_col="updated_at") == {"rewritten": [bucket[1]], "appended": []}
    after = _locations(table)
    assert {k for k in before if before[k] != after[k]} == {f"bucket={bucket[1]}"}
    got = {r["id"]: r["v"] for r in table.read().collect()}
    assert got == {i: "new" if i == 1 else f"v{i}" for i in range(40)}
    assert table.merge(source, version_col="updated_at") == {"rewritten": [], "appended": []}  # a replay changes nothing


def test_merge_appends_to_buckets_that_get_new_keys_alone(spark):
    table = _image(spark)
    before = {f for files in _files(table).values() for f in files}
    new = spark.createDataFrame([(1000, "n", T(2020, 1, 1))], IMAGE)
    done = table.merge(new, version_col="updated_at")
    assert done["rewritten"] == [] and len(done["appended"]) == 1
    after = {f for files in _files(table).values() for f in files}
    assert before < after and len(after - before) == 1  # no file went, one came
    assert table.read().count() == 41


def _files(table):
    return {name: [f for f in table._raw().inputFiles() if f"/{name}/" in f] for name in table.partitions()}


def test_merge_equals_the_dataframe_merge_with_null_keys_and_stamps(spark):
    from tidemart.operators.merge import merge

    start = [(None, "n1", T(2020, 1, 1)), (None, "n1", T(2020, 1, 1)), (1, "a", None), (2, "b", T(2020, 1, 1)), (3, "c", T(2020, 1, 1))]
    changes = [(None, "n2", T(2020, 1, 1)), (1, "a2", T(2020, 1, 4)), (2, "b2", T(2020, 1, 1, 5)), (3, "c2", None), (9, "i", None)]
    for version in ("updated_at", None):
        table = _own(KeyTable, spark, buckets=3)
        image, source = spark.createDataFrame(start, IMAGE), spark.createDataFrame(changes, IMAGE)
        table.create(image)
        table.merge(source, version_col=version)
        assert rows(table.read(), "id", "v") == rows(merge(image, source, version_col=version), "id", "v")


def test_merge_of_a_narrower_source_and_of_repeated_keys(spark):
    table = _image(spark)
    table.merge(spark.createDataFrame([(1, T(2020, 3, 1)), (77, T(2020, 3, 1))], "id long, updated_at timestamp_ntz"), version_col="updated_at")
    got = {r["id"]: (r["v"], r["updated_at"]) for r in table.read().collect()}
    assert got[1] == ("v1", T(2020, 3, 1)) and got[77] == (None, T(2020, 3, 1))
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, "x", T(2021, 1, 1)), (1, "y", T(2021, 1, 2))], IMAGE))


def test_intervals_kept_up_to_date_equal_the_full_ones(spark):
    """Three days in mixed order, a late version inside a closed interval, one before all others, and a rerun."""
    from tidemart.plans import jobs, models

    schema = "id long, brand string, department string, category string, updated_at timestamp_ntz"
    data = [(i, f"b{d}", "d", "c", T(2020, 1, d, i % 24)) for i in range(30) for d in (1, 5, 9) if (i + d) % 4]
    data += [(3, "twice", "d", "c", T(2020, 1, 5, 3)), (None, "x", "d", "c", T(2020, 1, 5)), (4, "x", "d", "c", None)]
    delta = spark.createDataFrame(data, schema)
    table = _own(KeyTable, spark, buckets=4)
    for day in ("2020-01-05", "2020-01-09", "2020-01-01", "2020-01-05"):
        touched = jobs.run_product_intervals(table, delta, [day])
    assert touched == []  # the last day was there already
    want = models.product_intervals(delta)
    assert rows(table.read()) == rows(want.select(*table.read().columns))


def test_late_versions_touch_their_buckets_alone(spark):
    from tidemart.plans import jobs

    schema = "id long, brand string, department string, category string, updated_at timestamp_ntz"
    table = _own(KeyTable, spark, buckets=16)
    jobs.run_product_intervals(table, spark.createDataFrame([(i, "b", "d", "c", T(2020, 1, 9)) for i in range(64)], schema))
    before = _locations(table)
    touched = jobs.run_product_intervals(table, spark.createDataFrame([(7, "late", "d", "c", T(2020, 1, 2))], schema))
    after = _locations(table)
    assert len(touched) == 1 and {k for k in after if after[k] != before[k]} == {f"bucket={touched[0]}"}
    assert table.read().filter("id = 7").count() == 2


def test_a_shared_folder_is_asked_for(spark, monkeypatch):
    from tidemart import session

    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Cluster()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
