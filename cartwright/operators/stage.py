"""Raw rows of a domain to its stage rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.config import RuleBook
from cartwright.functions import metrics
from cartwright.operators import quality

VERDICT = "verdict"
VALID = "valid"
REJECTED = "rejected"

LAYERS: dict[str, Callable[[RuleBook], list[metrics.Layer]]] = {
    "orders": lambda rules: [],
    "customers": metrics.customer_layers,
    "products": metrics.product_layers,
    "inventory": metrics.inventory_layers,
    "shipping": metrics.shipping_layers,
}


def add_layers(df: DataFrame, layers: list[metrics.Layer]) -> DataFrame:
    for layer in layers:
        df = df.withColumns(layer)
    return df


def stamp(df: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """Batch metadata of every ingested row."""
    return df.withColumns(
        {
            "processed_timestamp": rules.clock(),
            "batch_id": F.lit(rules.batch()),
            "source_system": F.lit(rules.source_system(domain)),
        }
    )


def derive(valid: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    return add_layers(valid, LAYERS[domain](rules))


def accept_and_derive(stamped: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    return derive(quality.accept(stamped, domain, rules), domain, rules)


def judged_rows(stamped: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """Valid and rejected rows together, told apart by ``verdict``; rows that are neither are gone.

    The derived columns are filled on rejected rows too, which lets one write serve both.
    """
    verdict = F.when(quality.validity(domain, rules), VALID).when(
        quality.rejection(domain, rules), REJECTED
    )
    judged = stamped.withColumn(VERDICT, verdict).filter(F.col(VERDICT).isNotNull())
    return derive(judged, domain, rules)


def stage_rows(raw: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """Valid rows with metadata and derived columns: the content of ``<domain>_stage``."""
    return accept_and_derive(stamp(raw, domain, rules), domain, rules)


def error_rows(raw: DataFrame, domain: str, rules: RuleBook) -> DataFrame:
    """Rejected rows with metadata and reason: the rows added to ``<domain>_errors``."""
    stamped = stamp(raw, domain, rules)
    return quality.annotate_rejects(quality.reject(stamped, domain, rules), rules)
