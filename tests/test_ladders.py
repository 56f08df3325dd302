"""Every ladder on each bound, next to it, and on NULL."""

from __future__ import annotations

import datetime as dt

import pytest
from cartwright import config
from cartwright.config import v1_rules, v2_rules


def classify(spark, ladder, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(ladder.column().alias("label")).collect()]


INT_CASES = [
    (config.AGE_SEGMENT, "age bigint", {24: "Gen Z", 25: "Millennial", 39: "Millennial", 40: "Gen X", 54: "Gen X", 55: "Boomer", None: "Boomer"}),
    (config.CUSTOMER_TENURE, "days_since_registration int", {29: "New", 30: "Active", 364: "Active", 365: "Established", None: "Established"}),
    (config.PRODUCT_STOCK, "stock_quantity int", {0: "Out of Stock", 1: "Low Stock", 9: "Low Stock", 10: "Medium Stock", 49: "Medium Stock", 50: "High Stock", None: "High Stock"}),
    (config.CUSTOMER_RECENCY, "days_since_last_order int", {30: "Active", 31: "At Risk", 90: "At Risk", 91: "Inactive", 180: "Inactive", 181: "Lost", None: "Lost"}),
    (v2_rules().audit_ladder(), "days_since_audit int", {60: "Current", 61: "Due Soon", 90: "Due Soon", 91: "Overdue", None: "Current"}),
]


@pytest.mark.parametrize("ladder, schema, cases", INT_CASES)
def test_bounds(spark, ladder, schema, cases):
    rows = [(value,) for value in cases]
    assert classify(spark, ladder, schema, rows) == list(cases.values())


@pytest.mark.parametrize(
    "ladder, column, cases",
    [
        (config.PRICE_SEGMENT, "price", {"49.99": "Budget", "50": "Mid-range", "149.99": "Mid-range", "150": "Premium", "299.99": "Premium", "300": "Luxury", None: "Luxury"}),
        (config.SHIPPING_COST, "shipping_cost", {"9.99": "Low Cost", "10": "Medium Cost", "19.99": "Medium Cost", "20": "High Cost", None: "High Cost"}),
    ],
)
def test_money_bounds(spark, ladder, column, cases):
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    got = df.selectExpr(f"cast(v as decimal(10,2)) as {column}").select(ladder.column())
    assert [r[0] for r in got.collect()] == list(cases.values())


def test_two_measure_tiers_need_both(spark):
    rows = [(1000, 5), (1000, 4), (500, 3), (999, 2), (200, 2), (200, 1), (None, 9), (5000, None)]
    got = classify(spark, config.CUSTOMER_VALUE, "total_spent int, total_orders int", rows)
    assert got == ["VIP", "High Value", "High Value", "Medium Value", "Medium Value", "Low Value", "Low Value", "Low Value"]
    rows = [(5000, 20), (5000, 19), (2000, 10), (1999, 30), (500, 5), (500, 4)]
    got = classify(spark, config.PRODUCT_PERFORMANCE, "total_revenue int, total_orders int", rows)
    assert got == ["Star", "High Performer", "High Performer", "Medium Performer", "Medium Performer", "Low Performer"]


def test_age_wins_over_discontinued(spark):
    rows = [(29, True), (364, True), (365, True), (365, False), (365, None), (None, True)]
    got = classify(spark, config.PRODUCT_AGE, "days_since_launch int, discontinued boolean", rows)
    assert got == ["New", "Growth", "Discontinued", "Mature", "Mature", "Discontinued"]
    rows = [(30, True), (90, True), (91, True), (91, False), (None, None)]
    schema = "days_since_last_order int, discontinued boolean"
    got = classify(spark, config.PRODUCT_RECENCY, schema, rows)
    assert got == ["Active", "Declining", "Discontinued", "Stagnant", "Stagnant"]


def test_warehouse_stock_and_delivery(spark):
    schema = "available_quantity int, reorder_level int"
    rows = [(0, 5), (5, 5), (6, 5), (10, 5), (11, 5), (None, 5)]
    got = classify(spark, config.WAREHOUSE_STOCK, schema, rows)
    assert got == ["Out of Stock", "Reorder Required", "Low Stock", "Low Stock", "In Stock", "In Stock"]
    day = dt.date(2001, 1, 1)
    schema = "actual_delivery date, delivery_days int, estimated_delivery_days int"
    rows = [(None, None, 3), (day, 3, 3), (day, 4, 3), (day, 5, 3), (day, 2, None)]
    got = classify(spark, config.DELIVERY, schema, rows)
    assert got == ["Pending", "On Time", "Slightly Delayed", "Delayed", "Delayed"]


def test_seasons_and_times_of_both_generations(spark):
    rows = [(dt.date(2001, m, 15),) for m in range(1, 13)] + [(None,)]
    v2 = classify(spark, v2_rules().season, "order_date date", rows)
    v1 = classify(spark, v1_rules().season, "order_date date", rows)
    names = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter", "Autumn"]
    assert v2 == names
    assert v1 == [{"Winter": "winter", "Autumn": "Fall"}.get(n, n) for n in names]
    hours = [(dt.datetime(2001, 1, 1, h, 59),) for h in (0, 5, 6, 11, 12, 16, 17, 18, 20, 21, 23)]
    v2 = classify(spark, v2_rules().time_of_day, "created_timestamp timestamp", hours)
    v1 = classify(spark, v1_rules().time_of_day, "created_timestamp timestamp", hours)
    assert v2 == ["Morning"] * 4 + ["Afternoon"] * 2 + ["Evening"] * 3 + ["Night"] * 2
    assert v1 == ["Early Morning"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 3 + ["Evening"] * 4


def test_run_status(spark):
    got = classify(spark, config.RUN_STATUS, "invalid_records bigint", [(0,), (1,), (None,)])
    assert got == ["SUCCESS", "SUCCESS_WITH_WARNINGS", "SUCCESS_WITH_WARNINGS"]


def test_rule_book_rejects_unknown_settings():
    with pytest.raises(ValueError):
        v2_rules(null_policy="keep")
    with pytest.raises(ValueError):
        v2_rules(version="v3")
