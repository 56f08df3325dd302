"""Row validity, the valid / rejected split, and one-pass data-quality counters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.config import ERROR_REASON, RuleBook


def _col(name: str) -> Column:
    return F.col(name)


def _has(*names: str) -> list[Column]:
    return [_col(name).isNotNull() for name in names]


def _looks_like_email(column: Column) -> Column:
    return column.contains("@") & column.contains(".")


def _looks_like_phone(column: Column) -> Column:
    # Fixed value: a phone such as 123-456-7890 has 12 characters.
    return column.contains("-") & (F.length(column) == 12)


@dataclass(frozen=True)
class Quality:
    """What one domain demands of a row, and which defects it counts."""

    requirements: Callable[[RuleBook], list[Column]]
    defects: Callable[[RuleBook], dict[str, Column]]


def _order_defects(rules: RuleBook) -> dict[str, Column]:
    return {
        "null_order_ids": _col("order_id").isNull(),
        "null_customer_ids": _col("customer_id").isNull(),
        "invalid_amounts": _col("order_amount") <= 0,
    }


def _customer_defects(rules: RuleBook) -> dict[str, Column]:
    # Comparisons with NULL are NULL and so are not counted; a missing email or phone is no bad one.
    defects = {
        "null_customer_ids": _col("customer_id").isNull(),
        "null_emails": _col("email").isNull(),
        "future_birth_dates": _col("date_of_birth") > rules.today(),
        "invalid_emails": ~_looks_like_email(_col("email")),
        "invalid_phones": ~_looks_like_phone(_col("phone")),
    }
    if rules.is_v1:
        defects["null_phones"] = _col("phone").isNull()
    return defects


def _product_defects(rules: RuleBook) -> dict[str, Column]:
    return {
        "null_product_ids": _col("product_id").isNull(),
        "invalid_prices": _col("price") <= 0,
        "negative_stock": _col("stock_quantity") < 0,
        "future_launch_dates": _col("launch_date") > rules.today(),
    }


def _inventory_defects(rules: RuleBook) -> dict[str, Column]:
    return {
        "null_inventory_ids": _col("inventory_id").isNull(),
        "negative_stock": _col("stock_quantity") < 0,
        "negative_reserved": _col("reserved_quantity") < 0,
        "invalid_available": _col("available_quantity") < 0,
    }


def _shipping_defects(rules: RuleBook) -> dict[str, Column]:
    return {
        "null_shipping_ids": _col("shipping_id").isNull(),
        "invalid_costs": _col("shipping_cost") < 0,
        "negative_weights": _col("package_weight") <= 0,
        "invalid_insurance": _col("insurance_value") < 0,
    }


QUALITY: dict[str, Quality] = {
    "orders": Quality(
        lambda rules: [*_has("order_id", "customer_id"), _col("order_amount") > 0],
        _order_defects,
    ),
    "customers": Quality(
        lambda rules: [
            *_has("customer_id", "email", "phone"),
            _looks_like_email(_col("email")),
            _col("date_of_birth") <= rules.today(),
        ],
        _customer_defects,
    ),
    "products": Quality(
        lambda rules: [
            *_has("product_id"),
            _col("price") > 0,
            _col("stock_quantity") >= 0,
            _col("launch_date") <= rules.today(),
        ],
        _product_defects,
    ),
    "inventory": Quality(
        lambda rules: [
            *_has("inventory_id"),
            *(
                _col(f"{kind}_quantity") >= 0 for kind in ("stock", "reserved", "available")
            ),
        ],
        _inventory_defects,
    ),
    "shipping": Quality(
        lambda rules: [
            *_has("shipping_id"),
            _col("shipping_cost") >= 0,
            _col("package_weight") > 0,
            _col("insurance_value") >= 0,
        ],
        _shipping_defects,
    ),
}


def validity(domain: str, rules: RuleBook) -> Column:
    """The domain's valid predicate: TRUE, FALSE, or NULL where a compared value is missing."""
    return reduce(and_, QUALITY[domain].requirements(rules))


def rejection(domain: str, rules: RuleBook) -> Column:
    """The rejected predicate.

    Under ``null_policy="drop"`` a row whose validity is NULL is neither valid nor rejected. The
    older customer rules demand that every requirement fails at once, which no row can meet (a
    missing email cannot also lack an ``@``), so they reject nothing.
    """
    if rules.is_v1 and domain == "customers":
        email = _col("email")
        every_failure = [
            *(_col(name).isNull() for name in ("customer_id", "email", "phone")),
            ~email.contains("@"),
            ~email.contains("."),
            _col("date_of_birth") > rules.today(),
        ]
        return reduce(and_, every_failure)
    valid = validity(domain, rules)
    return ~F.coalesce(valid, F.lit(False)) if rules.null_policy == "reject" else ~valid


def accept(df: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    return df.filter(validity(domain, rules))


def reject(df: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    return df.filter(rejection(domain, rules))


def annotate_rejects(df: DataFrame, rules: RuleBook) -> DataFrame:
    return df.withColumns(
        {"error_reason": F.lit(ERROR_REASON), "error_timestamp": rules.clock()}
    )


def counters(domain: str, rules: RuleBook) -> list[Column]:
    """All counters of a domain as aggregates, so that they cost one pass whatever their number."""
    measures = {
        **QUALITY[domain].defects(rules),
        "valid_records": validity(domain, rules),
        "invalid_records": rejection(domain, rules),
    }
    return [
        F.count(F.lit(1)).alias("total_records"),
        *(F.count_if(measure).alias(name) for name, measure in measures.items()),
    ]


def quality_report(df: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """One row of counters; ``lost_records`` are rows that NULL logic puts in neither output."""
    lost = F.expr("total_records - valid_records - invalid_records")
    return df.agg(*counters(domain, rules)).withColumn("lost_records", lost)
