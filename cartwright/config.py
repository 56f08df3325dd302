"""Rule books: every threshold, label and clock that a transform may depend on.

Transforms never read the wall clock or a global: they take a ``RuleBook``. Two generations of
rules exist and give different results; ``v2_rules`` is the default, ``v1_rules`` the older set.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cartwright.functions.ladders import Ladder, above, at_most, below, ladder, one_of, reaching

# CSV dialect of the raw files.
CSV_OPTIONS = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}

# Text written to the error tables.
ERROR_REASON = "Data quality validation failed"


@dataclass(frozen=True)
class Thresholds:
    """Limits used by the validation checks and the audit ladder."""

    min_order_amount: int = 1
    max_order_amount: int = 10000
    max_shipping_cost: int = 100
    premium_min_order: int = 100
    business_hours_start: int = 8
    business_hours_end: int = 18
    audit_overdue_days: int = 90
    audit_due_soon_days: int = 60
    price_tolerance: str = "0.01"


# Classification ladders shared by both rule generations.
AGE_SEGMENT = below("age", (25, "Gen Z"), (40, "Millennial"), (55, "Gen X"), default="Boomer")
CUSTOMER_TENURE = below(
    "days_since_registration", (30, "New"), (365, "Active"), default="Established"
)
PRICE_SEGMENT = below(
    "price", (50, "Budget"), (150, "Mid-range"), (300, "Premium"), default="Luxury"
)
PRODUCT_STOCK = ladder(
    [
        ("stock_quantity = 0", "Out of Stock"),
        ("stock_quantity < 10", "Low Stock"),
        ("stock_quantity < 50", "Medium Stock"),
    ],
    default="High Stock",
)
PRODUCT_AGE = ladder(
    [
        ("days_since_launch < 30", "New"),
        ("days_since_launch < 365", "Growth"),
        ("discontinued", "Discontinued"),
    ],
    default="Mature",
)
WAREHOUSE_STOCK = ladder(
    [
        ("available_quantity = 0", "Out of Stock"),
        ("available_quantity <= reorder_level", "Reorder Required"),
        ("available_quantity <= reorder_level * 2", "Low Stock"),
    ],
    default="In Stock",
)
DELIVERY = ladder(
    [
        ("actual_delivery IS NULL", "Pending"),
        ("delivery_days <= estimated_delivery_days", "On Time"),
        ("delivery_days <= estimated_delivery_days + 1", "Slightly Delayed"),
    ],
    default="Delayed",
)
SHIPPING_COST = below(
    "shipping_cost", (10, "Low Cost"), (20, "Medium Cost"), default="High Cost"
)
CUSTOMER_VALUE = reaching(
    "total_spent",
    "total_orders",
    (1000, 5, "VIP"),
    (500, 3, "High Value"),
    (200, 2, "Medium Value"),
    default="Low Value",
)
CUSTOMER_RECENCY = at_most(
    "days_since_last_order", (30, "Active"), (90, "At Risk"), (180, "Inactive"), default="Lost"
)
PRODUCT_PERFORMANCE = reaching(
    "total_revenue",
    "total_orders",
    (5000, 20, "Star"),
    (2000, 10, "High Performer"),
    (500, 5, "Medium Performer"),
    default="Low Performer",
)
PRODUCT_RECENCY = ladder(
    [
        ("days_since_last_order <= 30", "Active"),
        ("days_since_last_order <= 90", "Declining"),
        ("discontinued", "Discontinued"),
    ],
    default="Stagnant",
)
RUN_STATUS = ladder([("invalid_records = 0", "SUCCESS")], default="SUCCESS_WITH_WARNINGS")

# Ladders that differ between the generations.
V2_SEASON = one_of(
    "month(order_date)",
    ((12, 1, 2), "Winter"),
    ((3, 4, 5), "Spring"),
    ((6, 7, 8), "Summer"),
    default="Autumn",
)
V1_SEASON = one_of(
    "month(order_date)",
    ((12, 1, 2), "winter"),
    ((3, 4, 5), "Spring"),
    ((6, 7, 8), "Summer"),
    default="Fall",
)
V2_TIME_OF_DAY = below(
    "hour(created_timestamp)",
    (12, "Morning"),
    (17, "Afternoon"),
    (21, "Evening"),
    default="Night",
)
V1_TIME_OF_DAY = below(
    "hour(created_timestamp)",
    (6, "Early Morning"),
    (12, "Morning"),
    (18, "Afternoon"),
    default="Evening",
)


@dataclass(frozen=True)
class RuleBook:
    """One immutable set of rules plus the clock a run works with."""

    version: str = "v2"
    as_of: dt.date | None = None
    now: dt.datetime | None = None
    batch_id: str | None = None
    # "drop": a row whose validity is NULL is neither valid nor rejected; "reject": it is rejected.
    null_policy: str = "drop"
    thresholds: Thresholds = field(default_factory=Thresholds)
    season: Ladder = V2_SEASON
    time_of_day: Ladder = V2_TIME_OF_DAY
    margin: str = "order_amount - price"
    lifetime_value: str = "order_amount * 12"
    weekend: str = "day_of_week IN (1, 7)"
    profit_ratio_name: str = "profit_margin_pct"
    customer_tenure_name: str = "lifecycle_stage"
    product_order_frequency: bool = False
    # Whether SCD2 expiry of customers and products leaves already closed rows alone.
    guard_closed_rows: bool = True

    def __post_init__(self) -> None:
        if self.null_policy not in ("drop", "reject"):
            raise ValueError(f"null_policy must be 'drop' or 'reject', not {self.null_policy!r}")
        if self.version not in ("v1", "v2"):
            raise ValueError(f"version must be 'v1' or 'v2', not {self.version!r}")

    @property
    def is_v1(self) -> bool:
        return self.version == "v1"

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    def clock(self) -> Column:
        if self.now is None:
            return F.current_timestamp()
        # Read as wall-clock time of the session zone, so results do not depend on the driver's zone.
        return F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def wall_clock(self) -> dt.datetime:
        return self.now or dt.datetime.now()

    def batch(self) -> str:
        return self.batch_id or self.wall_clock().strftime("%Y%m%d_%H%M%S")

    def audit_ladder(self) -> Ladder:
        return above(
            "days_since_audit",
            (self.thresholds.audit_overdue_days, "Overdue"),
            (self.thresholds.audit_due_soon_days, "Due Soon"),
            default="Current",
        )

    def source_system(self, domain: str) -> str:
        if self.is_v1 and domain in ("customers", "products"):
            return "ecommerce_orders"
        return f"ecommerce_{domain}"

    def pinned(self, spark: SparkSession) -> RuleBook:
        """The same rules with clock and batch id fixed, so that one run stamps one value."""
        today, now = spark.sql(
            "SELECT current_date(), date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        ).first()
        now = self.now or dt.datetime.fromisoformat(now)
        return replace(
            self,
            now=now,
            as_of=self.as_of or (now.date() if self.now else today),
            batch_id=self.batch_id or now.strftime("%Y%m%d_%H%M%S"),
        )


def v2_rules(**overrides: object) -> RuleBook:
    return RuleBook(**overrides)


def v1_rules(**overrides: object) -> RuleBook:
    # What the older generation computes differently.
    older = dict(
        version="v1",
        season=V1_SEASON,
        time_of_day=V1_TIME_OF_DAY,
        margin="order_amount * 0.3D",
        lifetime_value=(
            "order_amount * CASE WHEN customer_tier = 'premium' THEN 10"
            " WHEN customer_tier = 'gold' THEN 7 WHEN customer_tier = 'silver' THEN 5 ELSE 3 END"
        ),
        weekend="coalesce(day_of_week IN (1, 7), false)",
        profit_ratio_name="profit_margin_percentage",
        customer_tenure_name="lifecycel_stage",
        product_order_frequency=True,
        guard_closed_rows=False,
    )
    return RuleBook(**{**older, **overrides})
