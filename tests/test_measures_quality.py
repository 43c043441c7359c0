import datetime as dt
from decimal import Decimal

from core_data import rows

from tidemart.operators.measures import sales_by_attributes, signed_daily_sum
from tidemart.operators.quality import check_not_null, check_unique, passes
from tidemart.sources.extract import literal_rows

T = dt.datetime


def test_returns_are_subtracted(spark):
    facts = spark.createDataFrame([
        (T(2020, 1, 1, 9), None, Decimal("10.00")),
        (T(2020, 1, 1, 10), T(2020, 1, 15), Decimal("4.50")),   # returned
        (T(2020, 1, 2, 0), None, Decimal("1.25")),
    ], "created_at timestamp_ntz, returned_at timestamp_ntz, sale_price decimal(18,2)")
    out = rows(signed_daily_sum(facts), "transaction_date", "total_sale")
    assert out == [(dt.date(2020, 1, 1), Decimal("5.50")), (dt.date(2020, 1, 2), Decimal("1.25"))]


def test_null_attributes_form_a_group(spark):
    df = spark.createDataFrame([
        (T(2020, 1, 1), None, None, None, Decimal("1.00")),
        (T(2020, 1, 1), None, None, None, Decimal("2.00")),
        (T(2020, 1, 1), "c", "b", "d", Decimal("3.00")),
    ], "created_at timestamp_ntz, category string, brand string, department string, "
       "sale_price decimal(18,2)")
    out = rows(sales_by_attributes(df), "category", "total_sales")
    assert out == [(None, Decimal("3.00")), ("c", Decimal("3.00"))]


def test_example_model_checks(spark):
    model = literal_rows(spark, [1, None])          # select 1 union all select null
    assert rows(model) == [(None,), (1,)]
    assert passes(check_unique(model, "id"))
    assert not passes(check_not_null(model, "id"))  # fails by design
    second = model.filter("id = 1")                 # the view on top of it
    assert passes(check_unique(second, "id")) and passes(check_not_null(second, "id"))
    dup = literal_rows(spark, [1, 1, 2, None, None])
    assert rows(check_unique(dup, "id")) == [(1, 2)]
