"""The enriched order fact and the customer and product analytics built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.config import RuleBook
from cartwright.functions import metrics
from cartwright.operators.joins import DEFAULT_SKEW, Heavy, SkewPolicy, broadcastable, heavy_keys, spread_join
from cartwright.operators.stage import add_layers

# Columns that carry the same name in several domains and the prefix they get.
_METADATA = ("created_timestamp", "batch_id", "processed_timestamp", "source_system")
PREFIXED = {
    "customers": ("customer", (*_METADATA, "lifecycle_stage")),
    "products": (
        "product",
        (
            *_METADATA,
            "currency",
            "weight_kg",
            "lifecycle_stage",
            "stock_quantity",
            "stock_status",
            "price_segment",
        ),
    ),
    "inventory": ("inventory", (*_METADATA, "stock_status", "stock_quantity")),
    "shipping": ("shipping", (*_METADATA, "currency")),
}
V1_PREFIXED = {
    **PREFIXED,
    "inventory": ("inventory", (*_METADATA, "stock_status")),
    "shipping": ("shipping", (*_METADATA, "currency", "package_weight")),
}

# What the order fact takes from inventory and shipping, besides the key.
INVENTORY_PAYLOAD = ("inventory_stock_status", "inventory_stock_quantity", "reorder_level")
SHIPPING_PAYLOAD = (
    "carrier",
    "shipping_status",
    "delivery_performance",
    "delivery_days",
    "estimated_delivery_days",
    "cost_per_kg",
    "shipping_cost",
    "shipping_currency",
)


# The order that the columns of the order fact follow.
_JOINED = (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("inventory", "product_id"),
    ("shipping", "order_id"),
)


def prefixed(stage: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """Rename the clashing columns of a stage table; names that are absent are skipped."""
    prefix, names = (V1_PREFIXED if rules.is_v1 else PREFIXED)[domain]
    return stage.withColumnsRenamed({name: f"{prefix}_{name}" for name in names})


def join_profile(
    stages: dict[str, DataFrame], policy: SkewPolicy = DEFAULT_SKEW
) -> dict[tuple[str, str], Heavy]:
    """The heaviest join keys of the stages, for ``enriched_orders``: one job over the key columns.

    A stage within the broadcast limit isn't read, and the orders only for stages beyond it.
    """
    large = {
        domain: key
        for domain, key in _JOINED
        if policy.always_spread or not broadcastable(stages[domain])
    }
    frames = {domain: (stages[domain], [key]) for domain, key in large.items()}
    if large:
        frames["orders"] = (stages["orders"], sorted(set(large.values())))
    return heavy_keys(frames, policy)


def enriched_orders(
    stages: dict[str, DataFrame],
    rules: RuleBook,
    policy: SkewPolicy = DEFAULT_SKEW,
    profile: dict[tuple[str, str], Heavy] | None = None,
) -> DataFrame:
    """Orders left-joined with all other domains, plus the derived order columns.

    An order repeats once per warehouse of its product and once per shipment. Of the sides that
    need a shuffle, the narrow shipping columns are joined first and the inventory fan-out last,
    next to the products on the same placement, so that the widest and most numerous rows are never
    shuffled again. Neither that order nor the columns' depends on the size of a side.

    ``profile`` has the heaviest keys by (domain, column) where they are known, as from ``join_profile``
    or from the writes of the stages.
    """
    profile = join_profile(stages, policy) if profile is None else profile
    sides = {
        domain: prefixed(stages[domain], domain, rules)
        for domain in ("customers", "products", "inventory", "shipping")
    }
    if not rules.is_v1:
        sides["inventory"] = sides["inventory"].select("product_id", *INVENTORY_PAYLOAD)
        sides["shipping"] = sides["shipping"].select("order_id", *SHIPPING_PAYLOAD)
    orders = stages["orders"]
    steps = {
        "order_id": ["shipping"],
        "customer_id": ["customers"],
        "product_id": ["products", "inventory"],
    }
    fact = orders
    for key, domains in steps.items():
        fact = spread_join(
            fact,
            [sides[domain] for domain in domains],
            key,
            "left",
            policy=policy,
            left_heavy=profile.get(("orders", key), {}),
            right_heavy=[profile.get((domain, key), {}) for domain in domains],
            left_cells_by=["order_id"],
        )
    fact = fact.select(*_contract_columns(orders, sides))
    return add_layers(fact, metrics.order_fact_layers(rules))


def _contract_columns(orders: DataFrame, sides: dict[str, DataFrame]) -> list[str]:
    """Columns as joins with one domain after the other leave them, each putting its key first."""
    names = orders.columns
    for domain, key in _JOINED:
        added = [name for name in sides[domain].columns if name != key]
        names = [key, *(name for name in names if name != key), *added]
    return names


def _sales(orders: str, revenue: str, average: str, profit: str) -> list[Column]:
    """The measures that all groupings of the order fact share."""
    return [
        F.count("order_id").alias(orders),
        F.sum("order_amount").alias(revenue),
        F.avg("order_amount").alias(average),
        F.sum("order_profit_margin").alias(profit),
    ]


def _order_span() -> list[Column]:
    return [
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ]


def customer_analytics(
    enriched: DataFrame,
    customers: DataFrame,
    rules: RuleBook,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    per_customer = enriched.groupBy("customer_id").agg(
        *_sales("total_orders", "total_spent", "avg_order_value", "total_profit_generated"),
        *_order_span(),
        F.countDistinct("product_id").alias("unique_products_purchased"),
        F.countDistinct("category").alias("unique_categories_purchased"),
        F.avg("estimated_clv").alias("avg_estimated_clv"),
    )
    details = prefixed(customers, "customers", rules)
    joined = spread_join(
        per_customer, details, "customer_id", "left", policy=policy, left_unique=True
    )
    return add_layers(joined, metrics.customer_analytics_layers(rules))


def product_analytics(
    enriched: DataFrame,
    products: DataFrame,
    rules: RuleBook,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Orders without a product form one group under a NULL ``product_id``."""
    per_product = enriched.groupBy("product_id").agg(
        *_sales("total_orders", "total_revenue", "avg_order_value", "total_profit"),
        *_order_span(),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    details = prefixed(products, "products", rules)
    joined = spread_join(
        per_product, details, "product_id", "left", policy=policy, left_unique=True
    )
    return add_layers(joined, metrics.product_analytics_layers(rules))
