from __future__ import annotations

import datetime as dt

from cartwright import schemas
from cartwright.config import v1_rules, v2_rules
from cartwright.operators import quality, stage
from cartwright.sources.sample import raw_view, sample_rules

RULES = sample_rules(v2_rules())
STRICT = sample_rules(v2_rules(null_policy="reject"))
OLD = sample_rules(v1_rules())


def orders(spark, rows):
    df = spark.createDataFrame(rows, "order_id string, customer_id string, v string")
    return df.selectExpr("*", "cast(v AS decimal(10,2)) AS order_amount")


def test_null_logic_loses_rows_unless_told_to_reject(spark):
    df = orders(
        spark,
        [
            ("1", "a", "5"),
            ("2", "a", "0.01"),
            (None, "a", "5"),
            ("3", None, None),
            ("4", "a", None),
            ("5", "a", "0"),
            ("6", "a", None),
        ],
    )
    valid = {r.order_id for r in quality.accept(df, "orders", RULES).collect()}
    assert valid == {"1", "2"}
    dropped = [r.order_id for r in quality.reject(df, "orders", RULES).collect()]
    assert sorted(map(str, dropped)) == ["3", "5", "None"]
    assert quality.reject(df, "orders", STRICT).count() == 5
    report = quality.quality_report(df, "orders", RULES).first()
    assert (report.total_records, report.valid_records, report.invalid_records) == (7, 2, 3)
    assert report.lost_records == 2
    assert quality.quality_report(df, "orders", STRICT).first().lost_records == 0


def test_email_and_phone_counters(spark):
    rows = [
        ("1", "a@b.c", "123-456-7890"),
        ("2", "a@b", "1234567890ab"),
        ("3", "a.b", "123-456-789"),
        ("4", None, None),
        ("5", "", "-"),
    ]
    df = spark.createDataFrame(rows, "customer_id string, email string, phone string")
    df = df.selectExpr("*", "DATE'1980-01-01' AS date_of_birth")
    for rules in (RULES, OLD):
        report = quality.quality_report(df, "customers", rules).first()
        assert (report.invalid_emails, report.invalid_phones, report.null_emails) == (3, 3, 1)
    assert quality.quality_report(df, "customers", OLD).first().null_phones == 1
    # The format of the phone is counted but not required.
    assert quality.accept(df, "customers", RULES).count() == 1


def test_older_customer_rules_reject_nothing(spark):
    rows = [(None, None, None, dt.date(2030, 1, 1)), ("1", "x", "y", dt.date(2030, 1, 1))]
    schema = "customer_id string, email string, phone string, date_of_birth date"
    df = spark.createDataFrame(rows, schema)
    assert quality.reject(df, "customers", OLD).count() == 0
    assert quality.reject(df, "customers", RULES).count() == 2


def test_boundaries_of_each_domain(spark, data):
    products = spark.createDataFrame(
        [("a", "0.01", 0, RULES.as_of), ("b", "1", -1, RULES.as_of), ("c", "1", 0, dt.date(2001, 8, 3))],
        "product_id string, v string, stock_quantity int, launch_date date",
    ).selectExpr("*", "cast(v AS decimal(10,2)) AS price")
    assert [r.product_id for r in quality.accept(products, "products", RULES).collect()] == ["a"]
    shipping = spark.createDataFrame(
        [("a", "0", "0.01", "0"), ("b", "0", "0", "0"), ("c", "-0.01", "1", "0"), ("d", "1", "1", "-1")],
        "shipping_id string, c string, w string, i string",
    ).selectExpr(
        "shipping_id",
        "cast(c AS decimal(10,2)) AS shipping_cost",
        "cast(w AS decimal(8,2)) AS package_weight",
        "cast(i AS decimal(10,2)) AS insurance_value",
    )
    assert [r.shipping_id for r in quality.accept(shipping, "shipping", RULES).collect()] == ["a"]


def test_split_is_consistent_on_the_sample(spark, data):
    for domain in schemas.DOMAINS:
        df = stage.stamp(raw_view(spark, data, domain), domain, RULES)
        report = quality.quality_report(df, domain, RULES).first()
        assert quality.accept(df, domain, RULES).count() == report.valid_records
        assert quality.reject(df, domain, RULES).count() == report.invalid_records


def test_metadata_and_error_columns(spark, data):
    errors = stage.error_rows(raw_view(spark, data, "products"), "products", RULES)
    row = errors.first()
    assert row.batch_id == "20010802_103000"
    assert row.source_system == "ecommerce_products"
    assert row.error_reason == "Data quality validation failed"
    assert "price_segment" not in errors.columns
    assert OLD.source_system("products") == "ecommerce_orders"
    assert OLD.source_system("shipping") == "ecommerce_shipping"


def test_derived_product_columns(spark):
    df = spark.createDataFrame(
        [("2x3x4",), ("2x3",), ("2xABCx4",), (None,), ("1.5x2x2",), ("1x2x3x4",)],
        "dimensions_cm string",
    ).selectExpr(
        "*",
        "cast(12 AS decimal(8,2)) AS weight_kg",
        "cast(60 AS decimal(10,2)) AS price",
        "5 AS stock_quantity",
        "DATE'2001-07-01' AS launch_date",
        "false AS discontinued",
    )
    rows = stage.derive(df, "products", RULES).collect()
    assert [r.volume_cm3 for r in rows] == [24.0, 0.0, None, 0.0, 6.0, 0.0]
    assert [r.density_kg_cm3 for r in rows] == [0.5, 0.0, 0.0, 0.0, 2.0, 0.0]
    assert rows[0].dimensions_array == ["2", "3", "4"]
    assert {r.lifecycle_stage for r in rows} == {"Growth"}


def test_age_counts_years_of_365_days(spark):
    df = spark.createDataFrame(
        [(dt.date(2001, 8, 2),), (dt.date(2000, 8, 3),), (dt.date(2000, 8, 2),), (None,)],
        "date_of_birth date",
    ).selectExpr("*", "DATE'2001-08-01' AS registration_date")
    assert [r.age for r in stage.derive(df, "customers", RULES).collect()] == [0, 0, 1, None]
    assert "lifecycel_stage" in stage.derive(df, "customers", OLD).columns
