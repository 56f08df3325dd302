"""Derived columns of each domain, as layers: a layer may use the columns of the layers before it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright import config
from cartwright.config import RuleBook

Layer = dict[str, Column]


def days_until(end: Column, start: str | Column) -> Column:
    return F.datediff(end, start)


def age_in_years(as_of: Column, born: str) -> Column:
    """Whole years of 365 days; leap days are not corrected for."""
    return F.floor(days_until(as_of, born) / 365)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0))


def box_volume(parts: Column) -> Column:
    """Product of three numeric parts, 0 for any other count, NULL where a part is not a number."""
    length, width, height = (F.get(parts, F.lit(i)).try_cast("double") for i in range(3))
    return F.when(F.size(parts) == 3, length * width * height).otherwise(F.lit(0))


def customer_layers(rules: RuleBook) -> list[Layer]:
    return [
        {
            "age": age_in_years(rules.today(), "date_of_birth"),
            "days_since_registration": days_until(rules.today(), "registration_date"),
        },
        {
            "age_segment": config.AGE_SEGMENT.column(),
            rules.customer_tenure_name: config.CUSTOMER_TENURE.column(),
        },
    ]


def product_layers(rules: RuleBook) -> list[Layer]:
    return [
        {
            "price_segment": config.PRICE_SEGMENT.column(),
            "stock_status": config.PRODUCT_STOCK.column(),
            "days_since_launch": days_until(rules.today(), "launch_date"),
            "dimensions_array": F.split("dimensions_cm", "x"),
        },
        {
            "lifecycle_stage": config.PRODUCT_AGE.column(),
            "volume_cm3": box_volume(F.col("dimensions_array")),
        },
        {"density_kg_cm3": ratio_or_zero(F.col("weight_kg"), F.col("volume_cm3"))},
    ]


def inventory_layers(rules: RuleBook) -> list[Layer]:
    return [
        {
            "stock_utilization_rate": ratio_or_zero(
                F.col("reserved_quantity"), F.col("stock_quantity")
            ),
            "stock_status": config.WAREHOUSE_STOCK.column(),
            "days_since_restock": days_until(rules.today(), "last_restocked"),
            "days_since_audit": days_until(rules.today(), "last_audit"),
        },
        {"audit_status": rules.audit_ladder().column()},
    ]


def shipping_layers(rules: RuleBook) -> list[Layer]:
    shipped_on = F.to_date("created_timestamp")
    return [
        {
            # NULL until delivered, because datediff of a NULL date is NULL.
            "delivery_days": days_until(F.col("actual_delivery"), shipped_on),
            "estimated_delivery_days": days_until(F.col("estimated_delivery"), shipped_on),
            "cost_category": config.SHIPPING_COST.column(),
            # Valid rows have a weight; a rejected one may not and must not fail the job.
            "cost_per_kg": F.try_divide("shipping_cost", "package_weight"),
        },
        {"delivery_performance": config.DELIVERY.column()},
    ]


def order_fact_layers(rules: RuleBook) -> list[Layer]:
    """Derived columns of the enriched order fact."""
    return [
        {
            "order_profit_margin": F.expr(rules.margin),
            "estimated_clv": F.expr(rules.lifetime_value),
            "season": rules.season.column(),
            "day_of_week": F.dayofweek("order_date"),
            "time_of_day": rules.time_of_day.column(),
        },
        {"is_weekend": F.expr(rules.weekend)},
    ]


def customer_analytics_layers(rules: RuleBook) -> list[Layer]:
    return [
        {
            "days_since_first_order": days_until(rules.today(), "first_order_date"),
            "days_since_last_order": days_until(rules.today(), "last_order_date"),
        },
        {
            "order_frequency_days": F.try_divide("days_since_first_order", "total_orders"),
            "customer_segment": config.CUSTOMER_VALUE.column(),
            "lifecycle_stage": config.CUSTOMER_RECENCY.column(),
        },
    ]


def product_analytics_layers(rules: RuleBook) -> list[Layer]:
    last: Layer = {
        "revenue_per_customer": F.try_divide("total_revenue", "unique_customers"),
        "performance_category": config.PRODUCT_PERFORMANCE.column(),
        "product_lifecycle": config.PRODUCT_RECENCY.column(),
    }
    if rules.product_order_frequency:
        last["order_frequency_days"] = F.try_divide("days_since_first_order", "total_orders")
    return [
        {
            "days_since_first_order": days_until(rules.today(), "first_order_date"),
            "days_since_last_order": days_until(rules.today(), "last_order_date"),
        },
        last,
    ]
