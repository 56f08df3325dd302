"""Cross-table checks: the offending rows of each check, and all counts in one plan.

The row form returns the rows a check complains about. The count form joins nothing: every row of
every stage becomes one entry for each of its keys, the entries of all stages are grouped once, and all
checks are sums over the groups. Each stage is read once. The partial aggregation runs before the
shuffle, so a key with a third of all rows reaches the shuffle as one row per task. As it holds every group
its task meets, the rows of a large stage are first dealt to tasks of a bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.config import RuleBook
from cartwright.operators.joins import DEFAULT_SKEW, SkewPolicy, bytes_read, orphans, spread_join

Stages = dict[str, DataFrame]


def unreasonable_amount(rules: RuleBook) -> Column:
    limits = rules.thresholds
    amount = F.col("order_amount")
    return (amount < limits.min_order_amount) | (amount > limits.max_order_amount)


def unreasonable_cost(rules: RuleBook) -> Column:
    cost = F.col("shipping_cost")
    return (cost < 0) | (cost > rules.thresholds.max_shipping_cost)


def outside_hours(rules: RuleBook) -> Column:
    """Hours before the first or after the last business hour; the last hour counts to its end."""
    hour = F.hour("created_timestamp")
    limits = rules.thresholds
    return (hour < limits.business_hours_start) | (hour > limits.business_hours_end)


def below_premium(rules: RuleBook) -> Column:
    return F.col("order_amount") < rules.thresholds.premium_min_order


def price_differs(rules: RuleBook) -> Column:
    tolerance = F.lit(rules.thresholds.price_tolerance).cast("decimal(10,2)")
    return F.abs(F.col("order_amount") - F.col("price")) > tolerance


# --- rows ---------------------------------------------------------------------------------------


def _unmatched(left: str, right: str, key: str) -> Callable[..., DataFrame]:
    def rows(stages: Stages, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
        return orphans(stages[left], stages[right], key, policy)

    return rows


def _where(domain: str, condition: Callable[[RuleBook], Column]) -> Callable[..., DataFrame]:
    def rows(stages: Stages, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
        return stages[domain].filter(condition(rules))

    return rows


def _orders_with(
    other: str,
    key: str,
    columns: list[str],
    condition: Callable[[RuleBook], Column],
    applies: str = "true",
) -> Callable[..., DataFrame]:
    def rows(stages: Stages, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
        partners = stages[other].filter(F.expr(applies)).select(key, *columns)
        return spread_join(stages["orders"], partners, key, policy=policy).filter(condition(rules))

    return rows


def stock_mismatch(
    stages: Stages, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Product and warehouse rows whose stock differs (older rules; counted, never stored)."""
    products = stages["products"].select(
        "product_id", F.col("stock_quantity").alias("product_stock")
    )
    inventory = stages["inventory"].select(
        "product_id", "inventory_id", F.col("stock_quantity").alias("inventory_stock")
    )
    paired = spread_join(inventory, products, "product_id", policy=policy)
    return paired.filter("product_stock != inventory_stock")


OFFENDERS: dict[str, Callable[..., DataFrame]] = {
    "orphaned_orders": _unmatched("orders", "customers", "customer_id"),
    "orphaned_customers": _unmatched("customers", "orders", "customer_id"),
    "unreasonable_order_amounts": _where("orders", unreasonable_amount),
    "orders_invalid_product": _unmatched("orders", "products", "product_id"),
    "price_mismatch": _orders_with("products", "product_id", ["price"], price_differs),
    "orders_without_shipping": _unmatched("orders", "shipping", "order_id"),
    "unreasonable_shipping_cost": _where("shipping", unreasonable_cost),
    "products_without_inventory": _unmatched("products", "inventory", "product_id"),
    "low_value_premium_orders": _orders_with(
        "customers",
        "customer_id",
        ["customer_tier"],
        below_premium,
        applies="customer_tier = 'premium'",
    ),
    "orders_outside_hours": _where("orders", outside_hours),
    "discontinued_product_orders": _orders_with(
        "products", "product_id", ["discontinued"], lambda rules: F.lit(True), applies="discontinued"
    ),
    "products_without_orders": _unmatched("products", "orders", "product_id"),
    "shipping_without_orders": _unmatched("shipping", "orders", "order_id"),
    "inventory_without_products": _unmatched("inventory", "products", "product_id"),
    "stock_mismatch": stock_mismatch,
}

# The stage tables each check reads.
DOMAINS_OF: dict[str, tuple[str, ...]] = {
    "orphaned_orders": ("orders", "customers"),
    "orphaned_customers": ("customers", "orders"),
    "unreasonable_order_amounts": ("orders",),
    "orders_invalid_product": ("orders", "products"),
    "price_mismatch": ("orders", "products"),
    "orders_without_shipping": ("orders", "shipping"),
    "unreasonable_shipping_cost": ("shipping",),
    "products_without_inventory": ("products", "inventory"),
    "low_value_premium_orders": ("orders", "customers"),
    "orders_outside_hours": ("orders",),
    "discontinued_product_orders": ("orders", "products"),
    "products_without_orders": ("products", "orders"),
    "shipping_without_orders": ("shipping", "orders"),
    "inventory_without_products": ("inventory", "products"),
    "stock_mismatch": ("products", "inventory"),
}


# --- counts -------------------------------------------------------------------------------------

# The kinds of keys that rows are grouped by; prices and stocks stand beside a product's key.
_CUSTOMER, _PRODUCT, _ORDER, _PRICE, _STOCK = range(5)

# The measures of each kind. Kinds share the columns that hold them, by position, as a task keeps a row of
# every group it meets in memory; those of the stock check come last, so that others don't carry them.
_MEASURES = {
    _CUSTOMER: ("orders", "customers", "cheap", "premium", "unreasonable", "off_hours"),
    _PRODUCT: ("orders", "products", "inventory", "ended", "valued", "priced", "stocked", "counted"),
    _ORDER: ("orders", "shipping", "unreasonable"),
    _PRICE: ("orders", "products"),
    _STOCK: ("inventory", "products"),
}


def _place(kind: int, name: str) -> str:
    return f"m{_MEASURES[kind].index(name)}"


@dataclass(frozen=True)
class _Entry:
    """One key of a row and what the row adds to the measures of that key."""

    kind: int
    key: str
    measures: dict[str, Column | int]
    value: Column | None = None

    def placed(self) -> dict[str, Column | int]:
        return {_place(self.kind, name): amount for name, amount in self.measures.items()}


#: Entries that one task turns into groups, where the number of a stage's rows is known.
TASK_ENTRIES = 500_000

#: Elsewhere bytes of a stage's input, counted once for each entry of a row.
TASK_BYTES = 16 * 2**20

# A stage's own key, which tells apart the rows that share the others.
_OWN_KEY = {
    "orders": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "inventory": "inventory_id",
    "shipping": "shipping_id",
}


def _dealt(stage: DataFrame, domain: str, entries: list[_Entry], rows: int | None = None) -> DataFrame:
    """The rows of a large stage in tasks that each group some ``TASK_ENTRIES`` entries.

    Else a task's memory follows the size of splits or of shuffled blocks, in which a row takes a few bytes
    and each of its groups some 150. Rows are dealt by all their keys, so that no frequent one keeps them together.
    Where ``rows`` isn't known, tasks get the entries of ``TASK_BYTES`` of the input, however many rows those
    hold; a stage whose size is unknown too stays as it is.
    """
    parts = bytes_read(stage) / TASK_BYTES if rows is None else rows / TASK_ENTRIES
    tasks = ceil(parts * len(entries))
    keys = dict.fromkeys([_OWN_KEY[domain], *(e.key for e in entries)])
    return stage.repartition(tasks, *keys) if tasks > 1 else stage


def _entries(stage: DataFrame, entries: list[_Entry], places: list[str]) -> DataFrame:
    """The entries of every row of a stage, as (kind, key, value, measures)."""

    def entry(e: _Entry) -> Column:
        value, placed = F.lit(None) if e.value is None else e.value, e.placed()
        amounts = [F.coalesce(F.lit(placed.get(p, 0)).cast("bigint"), F.lit(0)).alias(p) for p in places]
        # A decimal of up to 18 digits is kept as a number of eight bytes.
        return F.struct(
            F.lit(e.kind).alias("kind"), F.col(e.key).alias("key"), value.cast("decimal(18,2)").alias("value"), *amounts
        )

    return stage.select(F.inline(F.array(*map(entry, entries))))


def _total(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")


def _of(kind: int, amount: Column) -> Column:
    return F.when(F.col("kind") == kind, amount)


def _in(kind: int, name: str) -> Column:
    return F.col(_place(kind, name))


def _sum(kind: int, name: str) -> Column:
    return _total(_of(kind, _in(kind, name)))


def _without(kind: int, own: str, other: str) -> Column:
    """Rows of one side whose key the other side lacks; a NULL key has no partner."""
    return _total(_of(kind, F.when(F.col("key").isNull() | (_in(kind, other) == 0), _in(kind, own))))


def _pairs(kind: int, own: str, other: str, value: bool = False) -> Column:
    """Rows an inner join of two sides would give; with ``value``, also on the value."""
    # A group without a value holds rows that have none, and agrees with no other.
    present = F.col("key").isNotNull() & (F.col("value").isNotNull() if value else F.lit(True))
    return _total(_of(kind, F.when(present, _in(kind, own) * _in(kind, other))))


def _as_rows(counts: DataFrame) -> DataFrame:
    """One row of named counts to rows of (validation_type, count)."""
    entries = [
        F.struct(F.lit(name).alias("validation_type"), F.col(name).alias("count"))
        for name in counts.columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def _within_tolerance(rules: RuleBook) -> list[Column]:
    """All amounts, in whole cents apart, from which a price doesn't differ."""
    cents = int(Decimal(rules.thresholds.price_tolerance).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)
    return [F.col("price") + F.lit(step).cast("decimal(20,2)") / 100 for step in range(-cents, cents + 1)]


def check_counts(
    stages: Stages,
    rules: RuleBook,
    policy: SkewPolicy = DEFAULT_SKEW,
    stock_check: bool | None = None,
    rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """(validation_type, count) for all checks, stored or not, from one plan.

    Pairs whose values differ are all pairs with values less those whose values agree; an order's amount
    agrees with a price if it is one of the amounts within the tolerance, in cents, and so meets
    it in one group.

    The stock check belongs to the older rules; ``stock_check`` overrides that. ``rows`` tells how many rows
    each stage has at most; it steers the number of tasks, not the result.
    """
    rows = rows or {}
    stock_check = rules.is_v1 if stock_check is None else stock_check
    amount, price, stock = F.col("order_amount"), F.col("price"), F.col("stock_quantity")
    orders = [
        _Entry(
            _CUSTOMER,
            "customer_id",
            {
                "orders": 1,
                "cheap": below_premium(rules),
                "unreasonable": unreasonable_amount(rules),
                "off_hours": outside_hours(rules),
            },
        ),
        _Entry(_PRODUCT, "product_id", {"orders": 1, "valued": amount.isNotNull()}),
        _Entry(_ORDER, "order_id", {"orders": 1}),
        _Entry(_PRICE, "product_id", {"orders": 1}, amount),
    ]
    customers = [
        _Entry(_CUSTOMER, "customer_id", {"customers": 1, "premium": F.col("customer_tier") == "premium"})
    ]
    products = [
        _Entry(
            _PRODUCT,
            "product_id",
            {"products": 1, "ended": F.col("discontinued"), "priced": price.isNotNull()},
        ),
        *(_Entry(_PRICE, "product_id", {"products": 1}, near) for near in _within_tolerance(rules)),
    ]
    inventory = [_Entry(_PRODUCT, "product_id", {"inventory": 1})]
    shipping = [
        _Entry(_ORDER, "order_id", {"shipping": 1, "unreasonable": unreasonable_cost(rules)})
    ]
    if stock_check:
        products[0].measures["stocked"] = stock.isNotNull()
        products.append(_Entry(_STOCK, "product_id", {"products": 1}, stock))
        inventory[0].measures["counted"] = stock.isNotNull()
        inventory.append(_Entry(_STOCK, "product_id", {"inventory": 1}, stock))
    listed = {
        "orders": orders,
        "customers": customers,
        "products": products,
        "inventory": inventory,
        "shipping": shipping,
    }
    places = sorted({p for entries in listed.values() for e in entries for p in e.placed()})
    stacked = reduce(
        DataFrame.unionAll,
        (
            _entries(_dealt(stages[domain], domain, entries, rows.get(domain)), entries, places)
            for domain, entries in listed.items()
        ),
    )
    grouped = stacked.groupBy("kind", "key", "value").agg(*(F.sum(p).alias(p) for p in places))
    counts = {
        "orphaned_orders": _without(_CUSTOMER, "orders", "customers"),
        "orphaned_customers": _without(_CUSTOMER, "customers", "orders"),
        "unreasonable_order_amounts": _sum(_CUSTOMER, "unreasonable"),
        "low_value_premium_orders": _pairs(_CUSTOMER, "cheap", "premium"),
        "orders_outside_hours": _sum(_CUSTOMER, "off_hours"),
        "orders_invalid_product": _without(_PRODUCT, "orders", "products"),
        "products_without_inventory": _without(_PRODUCT, "products", "inventory"),
        "discontinued_product_orders": _pairs(_PRODUCT, "orders", "ended"),
        "products_without_orders": _without(_PRODUCT, "products", "orders"),
        "inventory_without_products": _without(_PRODUCT, "inventory", "products"),
        "orders_without_shipping": _without(_ORDER, "orders", "shipping"),
        "unreasonable_shipping_cost": _sum(_ORDER, "unreasonable"),
        "shipping_without_orders": _without(_ORDER, "shipping", "orders"),
        "price_mismatch": _pairs(_PRODUCT, "valued", "priced") - _pairs(_PRICE, "orders", "products", value=True),
    }
    if stock_check:
        counts["stock_mismatch"] = _pairs(_PRODUCT, "counted", "stocked") - _pairs(_STOCK, "inventory", "products", value=True)
    return _as_rows(grouped.agg(*(count.alias(name) for name, count in counts.items())))


# --- results ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    description: str
    v1_name: str | None = None
    v1_description: str | None = None


# The checks that are stored, with severities and texts of both generations.
CHECKS = (
    Check("orphaned_orders", "HIGH", "Orders without valid customers"),
    Check("orphaned_customers", "MEDIUM", "Customers without any orders"),
    Check(
        "unreasonable_order_amounts",
        "HIGH",
        "Orders with amounts outside expected range",
        "unreasonable_orders",
        "Orders with unreasonable amounts",
    ),
    Check(
        "orders_invalid_product",
        "HIGH",
        "Orders with no matching product",
        "orphaned_orders_products",
        "Orders with invalid products",
    ),
    Check(
        "price_mismatch",
        "MEDIUM",
        "Order amount differs from product price",
        None,
        "Orders with price mismatches",
    ),
    Check(
        "orders_without_shipping",
        "HIGH",
        "Orders with no shipping record",
        None,
        "Orders without shipping information",
    ),
    Check(
        "unreasonable_shipping_cost",
        "MEDIUM",
        "Shipping cost outside expected range",
        "unreasonable_shipping",
        "Shipping with unreasonable costs",
    ),
    Check(
        "products_without_inventory",
        "MEDIUM",
        "Products with no inventory record",
        None,
        "Products without inventory",
    ),
    Check("low_value_premium_orders", "LOW", "Premium customers with low-value orders"),
    Check("orders_outside_hours", "LOW", "Orders placed outside business hours"),
    Check(
        "discontinued_product_orders",
        "HIGH",
        "Orders placed for discontinued products",
        "discontinued_orders",
        "Orders for discontinued products",
    ),
)


def _lookup(name: Column, entries: dict[str, str]) -> Column:
    pairs = [F.lit(text) for item in entries.items() for text in item]
    return F.element_at(F.create_map(*pairs), name)


def grade(counts: DataFrame, rules: RuleBook) -> DataFrame:
    """Stored checks with severity and description, stamped with the run's clock."""
    kind = F.col("validation_type")
    stored = counts.filter(kind.isin([check.name for check in CHECKS]))
    severity = _lookup(kind, {check.name: check.severity for check in CHECKS})
    names = {check.name: (rules.is_v1 and check.v1_name) or check.name for check in CHECKS}
    texts = {
        check.name: (rules.is_v1 and check.v1_description) or check.description for check in CHECKS
    }
    results = stored.select(
        _lookup(kind, names).alias("validation_type"),
        F.col("count"),
        F.when(F.col("count") > 0, severity).otherwise("NONE").alias("severity"),
        _lookup(kind, texts).alias("description"),
    )
    if rules.is_v1:
        return results.withColumns(
            {"validation_timestamp": rules.clock(), "batch_id": F.lit(rules.batch())}
        )
    return results.withColumn("validated_at", rules.clock())


def validation_results(
    stages: Stages,
    rules: RuleBook,
    policy: SkewPolicy = DEFAULT_SKEW,
    rows: Mapping[str, int] | None = None,
) -> DataFrame:
    return grade(check_counts(stages, rules, policy, stock_check=False, rows=rows), rules)


def validation_gate(results: DataFrame, rules: RuleBook) -> DataFrame:
    """One row: issues by severity and the overall status, which only HIGH issues fail."""
    passed, failed = ("PASS", "FAIL") if rules.is_v1 else ("PASSED", "FAILED")
    levels = ("high", "medium", "low") if rules.is_v1 else ("high",)
    issues = results.agg(
        *(
            F.count_if(F.col("severity") == level.upper()).alias(f"{level}_severity_issues")
            for level in levels
        ),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_findings"),
    )
    status = F.when(F.col("high_severity_issues") > 0, failed).otherwise(passed)
    return issues.withColumn("overall_status", status)

