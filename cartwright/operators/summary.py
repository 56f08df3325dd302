"""The global summary and the season, segment and category reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.config import RuleBook


# The totals of the summary in the table's order, as name, aggregate and input.
TOTALS = (
    ("total_orders", F.count, "order_id"),
    ("total_revenue", F.sum, "order_amount"),
    ("avg_order_value", F.avg, "order_amount"),
    ("unique_customers", F.countDistinct, "customer_id"),
    ("unique_products", F.countDistinct, "product_id"),
    ("total_profit", F.sum, "order_profit_margin"),
    ("avg_estimated_clv", F.avg, "estimated_clv"),
)
# Ratios of totals, as name, dividend and divisor; the first is named by the rules.
RATIOS = (
    (None, "total_profit", "total_revenue"),
    ("revenue_per_customer", "total_revenue", "unique_customers"),
    ("orders_per_customer", "total_orders", "unique_customers"),
)


def analytics_summary(enriched: DataFrame, rules: RuleBook) -> DataFrame:
    """One row over the order fact; a ratio with a zero divisor is NULL, the profit's is a percentage."""
    totals = enriched.agg(*(aggregate(column).alias(name) for name, aggregate, column in TOTALS))
    ratios = {name or rules.profit_ratio_name: F.try_divide(above, below) for name, above, below in RATIOS}
    ratios[rules.profit_ratio_name] *= 100
    stamps = {"report_date": rules.today(), "report_timestamp": rules.clock()}
    return totals.withColumns({**ratios, **stamps})


def _report(
    df: DataFrame, by: str, counted: str, measured: str, names: tuple[str, str, str]
) -> DataFrame:
    count, total, average = names
    return df.groupBy(by).agg(
        F.count(counted).alias(count),
        F.sum(measured).alias(total),
        F.avg(measured).alias(average),
    )


def seasonal_analysis(enriched: DataFrame) -> DataFrame:
    names = ("orders_count", "seasonal_revenue", "avg_seasonal_order_value")
    return _report(enriched, "season", "order_id", "order_amount", names)


def segment_analysis(customers: DataFrame) -> DataFrame:
    names = ("customers_count", "segment_revenue", "avg_segment_value")
    return _report(customers, "customer_segment", "customer_id", "total_spent", names)


def category_analysis(products: DataFrame) -> DataFrame:
    names = ("products_count", "category_revenue", "avg_category_revenue")
    return _report(products, "category", "product_id", "total_revenue", names)
