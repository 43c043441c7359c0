"""The report and the periodic fact on sales and versions small enough to work out by hand."""

import datetime as dt
from decimal import Decimal

from core_data import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemart.functions import periods as pr
from tidemart.operators.quality import check_unique
from tidemart.plans import models
from tidemart.sources import fixtures as fx

T, D = dt.datetime, dt.date
FACT = "id long, product_id long, created_at timestamp_ntz, returned_at timestamp_ntz, sale_price decimal(18,2)"
DIM = "id long, brand string, department string, category string, updated_at timestamp_ntz"


def _sales(spark):
    day, later = T(2024, 3, 1, 10), T(2024, 3, 2, 9)
    return spark.createDataFrame([
        (1, 7, day, None, Decimal("10.00")), (2, 7, day, T(2024, 3, 5), Decimal("4.50")), (3, 7, later, None, Decimal("1.25")),
        (4, 8, later, None, Decimal("2.00")), (5, None, later, None, Decimal("3.00"))], FACT)


def test_report_by_hand(spark):
    versions = spark.createDataFrame([
        (7, "old", "Men", "hats", T(2024, 2, 1)), (7, "new", "Men", "hats", T(2024, 3, 2)), (8, "late", "Men", "hats", T(2024, 3, 3))], DIM)
    expected = [
        (D(2024, 3, 1), "hats", "old", "Men", Decimal("14.50")),
        (D(2024, 3, 2), None, None, None, Decimal("5.00")),   # sold before the first version, and without a product
        (D(2024, 3, 2), "hats", "new", "Men", Decimal("1.25"))]
    columns = ["transaction_date", "category", "brand", "department", "total_sales"]
    assert rows(models.sales_report(_sales(spark), versions), *columns) == expected
    one_day = models.sales_report(_sales(spark), versions, [D(2024, 3, 1)])
    assert rows(one_day, *columns) == expected[:1]


def test_periodic_fact_by_hand(spark):
    got = rows(models.sales_periodic_fact(_sales(spark)), "transaction_date", "total_sale")
    assert got == [(D(2024, 3, 1), Decimal("5.50")), (D(2024, 3, 2), Decimal("6.25"))]


def test_report_totals_follow_the_definition(spark):
    """Every sale takes the greatest version time not after it."""
    fact = models.sales_transaction_fact(fx.order_items_source(spark, SF_SMALL))
    dim = models.product_dimension_daily(fx.products_delta(spark, SF_SMALL))
    history, expected = {}, {}
    for v in dim.collect():
        history.setdefault(v.id, []).append((v.updated_at, v.category, v.brand, v.department))
    for s in fact.select("product_id", "created_at", "sale_price").collect():
        best = max((v for v in history.get(s.product_id, []) if v[0] <= s.created_at), default=(None,) * 4)
        key = (s.created_at.date(), *best[1:])
        expected[key] = expected.get(key, Decimal(0)) + s.sale_price
    got = {tuple(r[:4]): r[4] for r in models.sales_report(fact, dim).select("transaction_date", "category", "brand", "department", "total_sales").collect()}
    assert got == expected


def test_fact_without_id(spark):
    items = fx.order_items_source(spark, SF_SMALL)
    with_id, without = models.sales_transaction_fact(items), models.sales_transaction_fact(items, with_id=False)
    assert without.columns == models.FACT_COLUMNS[1:]
    assert without.count() == with_id.count() and without.exceptAll(with_id.drop("id")).count() == 0


def test_group_by_position_in_spark_sql(spark):
    """A4: the SQL form with a position equals the operator on the same rows."""
    frame = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    frame.createOrReplaceTempView("positions")
    by_position = spark.sql("SELECT k AS unique_field, count(*) AS n_records FROM positions WHERE k IS NOT NULL GROUP BY 1 HAVING n_records > 1")
    assert rows(by_position) == rows(check_unique(frame, "k")) == [(2, 2)]


def test_truncation_and_the_current_day(spark):
    stamp = spark.createDataFrame([(T(2024, 3, 10, 2, 7, 42, 500000),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Los_Angeles"):  # 02:07 does not exist there on that day
            spark.conf.set("spark.sql.session.timeZone", name)
            got = stamp.select(*(pr.trunc_to(u, "t").cast("string").alias(u) for u in ("year", "month", "day", "hour", "minute", "second"))).first()
            assert list(got) == ["2024-01-01 00:00:00", "2024-03-01 00:00:00", "2024-03-10 00:00:00", "2024-03-10 02:00:00",
                                 "2024-03-10 02:07:00", "2024-03-10 02:07:42"]
        for name, instant, day in (("Pacific/Kiritimati", "2024-01-01T23:30:00Z", D(2024, 1, 1)), ("Pacific/Honolulu", "2024-01-02T00:30:00Z", D(2024, 1, 2))):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert spark.range(1).select(pr.current_day(F.lit(instant).cast("timestamp"))).first()[0] == day
        today = dt.datetime.now(dt.timezone.utc).date()
        assert spark.range(1).select(pr.current_day()).first()[0] - today in (dt.timedelta(0), dt.timedelta(1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
