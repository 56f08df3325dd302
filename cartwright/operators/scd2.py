"""Type 2 history as pure transforms from (history, batch) to the next history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.config import RuleBook
from cartwright.operators.joins import DEFAULT_SKEW, SkewPolicy, spread_join

_KEY = "__open_key"
_HIT = "__in_batch"

# Columns of the three history tables, before the SCD2 columns.
ORDER_HISTORY = (
    "order_id", "customer_id", "product_id", "order_date", "order_amount", "currency",
    "payment_method", "shipping_address", "order_status", "created_timestamp",
    "processed_timestamp", "batch_id", "source_system", "order_profit_margin", "estimated_clv",
    "season", "day_of_week", "is_weekend", "time_of_day",
)
CUSTOMER_HISTORY = (
    "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth",
    "registration_date", "address", "city", "state", "zip_code", "country", "customer_tier",
    "last_login", "customer_created_timestamp", "age", "age_segment", "days_since_registration",
    "lifecycle_stage", "total_orders", "total_spent", "avg_order_value", "customer_segment",
)
PRODUCT_HISTORY = (
    "product_id", "product_name", "category", "subcategory", "brand", "price",
    "product_currency", "product_stock_quantity", "product_weight_kg", "dimensions_cm", "color",
    "material", "description", "launch_date", "discontinued", "product_created_timestamp",
    "product_price_segment", "product_stock_status", "days_since_launch",
    "product_lifecycle_stage", "volume_cm3", "density_kg_cm3", "total_orders", "total_revenue",
    "unique_customers", "performance_category", "product_lifecycle",
)


@dataclass(frozen=True)
class History:
    """A history table: its source table, key and columns."""

    source: str
    key: str
    columns: tuple[str, ...]

    def batch(self, source: DataFrame) -> DataFrame:
        return source.select(*self.columns)

    def guarded(self, rules: RuleBook) -> bool:
        return rules.guard_closed_rows or self.key == "order_id"


HISTORIES = {
    "orders_target": History("enriched_orders", "order_id", ORDER_HISTORY),
    "customers_target": History("customer_analytics", "customer_id", CUSTOMER_HISTORY),
    "products_target": History("product_analytics", "product_id", PRODUCT_HISTORY),
}


def stamp_current(batch: DataFrame, rules: RuleBook) -> DataFrame:
    return batch.withColumns(
        {
            "effective_date": rules.today(),
            "expiry_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def _batch_keys(batch: DataFrame, key: str) -> DataFrame:
    return batch.select(key).filter(F.col(key).isNotNull()).distinct()


def scd2_apply(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    rules: RuleBook,
    guard: bool = True,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """The history after ``batch``.

    Rows of ``target`` whose key is in the batch are closed at ``as_of``; all batch rows are added as
    current, without change detection and without removing duplicates. A NULL key is in no batch,
    and the guard spares rows that were closed before. Such rows join on a NULL and so match
    nothing. A caller that stores closed rows apart need not pass them under the guard.
    """
    touchable = F.coalesce(F.col("is_current"), F.lit(False)) if guard else F.lit(True)
    marked = target.withColumn(_KEY, F.when(touchable, F.col(key)))
    keys = _batch_keys(batch, key).select(F.col(key).alias(_KEY), F.lit(True).alias(_HIT))
    joined = spread_join(marked, keys, _KEY, "left", policy=policy)
    hit = F.col(_HIT).isNotNull()
    updated = joined.withColumns(
        {
            "expiry_date": F.when(hit, rules.today()).otherwise(F.col("expiry_date")),
            "is_current": F.when(hit, F.lit(False)).otherwise(F.col("is_current")),
        }
    ).drop(_KEY, _HIT)
    return updated.unionByName(stamp_current(batch, rules))
