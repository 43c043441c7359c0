"""Daily runs of the models end to end, as the scheduler would run them."""

from core_data import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemart.plans import jobs, models
from tidemart.plans.daily import warehouse_tables
from tidemart.session import scratch_path
from tidemart.sources import fixtures as fx


def _busy_days(items, n):
    """The n days with the most sales (data-derived, small list)."""
    top = (items.groupBy(F.to_date("created_at").alias("d")).count()
           .orderBy(F.desc("count"), "d").limit(n).collect())
    return sorted(r["d"] for r in top)


def test_daily_runs_match_models_and_are_idempotent(spark):
    items = fx.order_items_source(spark, SF_SMALL)
    delta = fx.products_delta(spark, SF_SMALL)
    days = _busy_days(items, 2)
    spark.sql("CREATE DATABASE IF NOT EXISTS tm_daily")
    t = warehouse_tables(spark, scratch_path(spark, "daily"), "tm_daily")
    fact_t, dim_t, periodic_t, report_t = t["fact"], t["daily"], t["periodic"], t["report"]
    jobs.run_product_dimension_daily(dim_t, delta, None)  # bootstrap
    for day in days + days:  # every day twice: the second run changes nothing
        jobs.run_sales_transaction_fact(fact_t, items, [day])
        jobs.run_product_dimension_daily(dim_t, delta, [day])
        jobs.run_sales_periodic_fact(periodic_t, fact_t, [day])
        jobs.run_sales_report(report_t, fact_t, dim_t.read(), [day])

    expected_fact = models.sales_transaction_fact(items, days)
    assert rows(fact_t.read()) == rows(expected_fact.select(*fact_t.read().columns))
    expected_periodic = models.sales_periodic_fact(expected_fact)
    assert rows(periodic_t.read()) == rows(expected_periodic)
    full_dim = models.product_dimension_daily(delta)
    expected_report = models.sales_report(expected_fact, full_dim)
    assert rows(report_t.read()) == rows(expected_report.select(*report_t.read().columns))
    assert report_t.read().count() > 0


def test_daily_read_prunes_day_folders(spark):
    items = fx.order_items_source(spark, SF_SMALL)
    day = _busy_days(items, 1)[0]
    spark.sql("CREATE DATABASE IF NOT EXISTS tm_prune")
    fact = jobs.run_sales_transaction_fact(warehouse_tables(spark, scratch_path(spark, "prune"), "tm_prune")["fact"], items)
    plan = fact.read(days=[day])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(dt" in plan and day.isoformat() in plan


def test_run_day_schedule(spark):
    from tidemart.operators.latest import keep_latest
    from tidemart.operators.merge import merge
    from tidemart.plans.daily import run_day

    items = fx.order_items_source(spark, SF_SMALL)
    delta = fx.products_delta(spark, SF_SMALL)
    main0 = fx.products_main(spark, SF_SMALL)
    # The two busiest sale days that also carry product changes.
    change_days = {r[0] for r in delta.select(F.to_date("updated_at")).distinct().collect()}
    busiest = (items.groupBy(F.to_date("created_at").alias("d")).count()
               .orderBy(F.desc("count"), "d").collect())
    days = sorted([r["d"] for r in busiest if r["d"] in change_days][:2])
    root = scratch_path(spark, "schedule")
    # Deployed state: the daily product history was back-filled before.
    spark.sql("CREATE DATABASE IF NOT EXISTS tm_schedule")
    jobs.run_product_dimension_daily(warehouse_tables(spark, root, "tm_schedule")["daily"], delta, None)
    for day in days + days[-1:]:  # the last day twice: a rerun changes nothing
        t = run_day(spark, items, delta, root, day, initial_main=main0, database="tm_schedule")
    expected_main = main0
    for day in days:
        changes = keep_latest(delta.filter(F.to_date("updated_at") == F.lit(day)), ["id"], "updated_at")
        expected_main = merge(expected_main, changes, version_col="updated_at")
    assert rows(t["main"].read()) == rows(expected_main.select(*t["main"].read().columns))
    report = t["report"].read()
    fact = models.sales_transaction_fact(items, days)
    full_dim = models.product_dimension_daily(delta)
    assert report.count() > 5
    assert rows(report) == rows(models.sales_report(fact, full_dim, days).select(*report.columns))
    intervals = t["intervals"].read()
    assert rows(intervals) == rows(models.product_intervals(models.product_history(delta, days)).select(*intervals.columns))
