"""SQL that states, independently of the library, what every catalog query must return.

The texts run on DuckDB over the same tables. They share named subqueries; ``with_parts`` puts the
ones a text needs in front of it. Decimal divisions are done on whole cents, rounded half up.
"""

from __future__ import annotations

import re

from cartwright.sources import sample

DAY = "DATE '2001-08-02'"
NOW = "TIMESTAMP '2001-08-02 10:30:00'"
BATCH = "'20010802_103000'"


def days(start: str, end: str = DAY) -> str:
    return f"date_diff('day', {start}, {end})"


def cents(expression: str) -> str:
    return f"CAST(({expression}) * 100 AS HUGEINT)"


def quotient(numerator: str, denominator: str, digits: int = 6) -> str:
    """Whole numbers divided and rounded half up to ``digits`` places; NULL for a zero divisor."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"nullif(CAST({denominator} AS HUGEINT), 0)"
    whole = f"((2 * abs({n}) * {10**digits} + {d}) // (2 * {d}))"
    return f"CAST(sign({n}) * {whole} AS DOUBLE) / {10**digits}"


def mean(expression: str) -> str:
    return quotient(f"sum({cents(expression)})", f"100 * count({expression})")


def casts(kind: str, names: str) -> list[str]:
    return [f"CAST({name} AS {kind}) AS {name}" for name in names.split()]


def dec(names: str) -> list[str]:
    return casts("DOUBLE", names)


def big(names: str) -> list[str]:
    return casts("BIGINT", names)


def text(names: str) -> list[str]:
    return casts("VARCHAR", names)


def export(source: str, *replacements: list[str], where: str = "") -> str:
    items = ", ".join(item for group in replacements for item in group)
    return f"SELECT * REPLACE ({items}) FROM {source} {where}".strip()


PARTS: dict[str, str] = {f"raw_{domain}": sql.strip() for domain, sql in sample.SQL.items()}

PARTS |= {f"text_{domain}": sample.text_sql(domain, f"raw_{domain}") for domain in sample.SQL}

for _domain in sample.SQL:
    for _version, _system in (
        ("", _domain),
        ("v1_", "orders" if _domain in ("customers", "products") else _domain),
    ):
        PARTS[f"{_version}stamped_{_domain}"] = (
            f"SELECT *, {NOW} AS processed_timestamp, {BATCH} AS batch_id,"
            f" 'ecommerce_{_system}' AS source_system FROM raw_{_domain}"
        )

VALID = {
    "orders": "order_id IS NOT NULL AND customer_id IS NOT NULL AND order_amount > 0",
    "customers": (
        "customer_id IS NOT NULL AND email IS NOT NULL AND phone IS NOT NULL"
        f" AND contains(email, '@') AND contains(email, '.') AND date_of_birth <= {DAY}"
    ),
    "products": (
        f"product_id IS NOT NULL AND price > 0 AND stock_quantity >= 0 AND launch_date <= {DAY}"
    ),
    "inventory": (
        "inventory_id IS NOT NULL AND stock_quantity >= 0 AND reserved_quantity >= 0"
        " AND available_quantity >= 0"
    ),
    "shipping": (
        "shipping_id IS NOT NULL AND shipping_cost >= 0 AND package_weight > 0"
        " AND insurance_value >= 0"
    ),
}

V1_REJECTED = {
    "orders": "order_id IS NULL OR customer_id IS NULL OR order_amount <= 0",
    "customers": (
        "customer_id IS NULL AND email IS NULL AND phone IS NULL AND NOT contains(email, '@')"
        f" AND NOT contains(email, '.') AND date_of_birth > {DAY}"
    ),
    "products": (
        f"product_id IS NULL OR price <= 0 OR stock_quantity < 0 OR launch_date > {DAY}"
    ),
    "inventory": (
        "inventory_id IS NULL OR stock_quantity < 0 OR reserved_quantity < 0"
        " OR available_quantity < 0"
    ),
    "shipping": (
        "shipping_id IS NULL OR shipping_cost < 0 OR package_weight <= 0 OR insurance_value < 0"
    ),
}

COUNTERS = {
    "orders": {
        "null_order_ids": "order_id IS NULL",
        "null_customer_ids": "customer_id IS NULL",
        "invalid_amounts": "order_amount <= 0",
    },
    "customers": {
        "null_customer_ids": "customer_id IS NULL",
        "null_emails": "email IS NULL",
        "future_birth_dates": f"date_of_birth > {DAY}",
        "invalid_emails": (
            "email IS NOT NULL AND (NOT contains(email, '@') OR NOT contains(email, '.'))"
        ),
        "invalid_phones": "phone IS NOT NULL AND (NOT contains(phone, '-') OR length(phone) <> 12)",
    },
    "products": {
        "null_product_ids": "product_id IS NULL",
        "invalid_prices": "price <= 0",
        "negative_stock": "stock_quantity < 0",
        "future_launch_dates": f"launch_date > {DAY}",
    },
    "inventory": {
        "null_inventory_ids": "inventory_id IS NULL",
        "negative_stock": "stock_quantity < 0",
        "negative_reserved": "reserved_quantity < 0",
        "invalid_available": "available_quantity < 0",
    },
    "shipping": {
        "null_shipping_ids": "shipping_id IS NULL",
        "invalid_costs": "shipping_cost < 0",
        "negative_weights": "package_weight <= 0",
        "invalid_insurance": "insurance_value < 0",
    },
}

V1_CUSTOMER_COUNTERS = {
    **COUNTERS["customers"],
    "invalid_emails": (
        "(email IS NOT NULL AND NOT contains(email, '@')) OR NOT contains(email, '.')"
    ),
    "invalid_phones": "(phone IS NOT NULL AND NOT contains(phone, '-')) OR length(phone) <> 12",
    "null_phones": "phone IS NULL",
}

for _domain, _condition in VALID.items():
    for _version in ("", "v1_"):
        PARTS[f"{_version}valid_{_domain}"] = (
            f"SELECT * FROM {_version}stamped_{_domain} WHERE {_condition}"
        )

_TENURE = f"""CASE WHEN {days("registration_date")} < 30 THEN 'New'
    WHEN {days("registration_date")} < 365 THEN 'Active' ELSE 'Established' END"""
_AGE = f"CAST(floor({days('date_of_birth')} / 365) AS BIGINT)"

for _version, _tenure in (("", "lifecycle_stage"), ("v1_", "lifecycel_stage")):
    PARTS[f"{_version}customers_stage"] = f"""
    SELECT *, {_AGE} AS age,
      CASE WHEN {_AGE} < 25 THEN 'Gen Z' WHEN {_AGE} < 40 THEN 'Millennial'
           WHEN {_AGE} < 55 THEN 'Gen X' ELSE 'Boomer' END AS age_segment,
      {days("registration_date")} AS days_since_registration, {_TENURE} AS {_tenure}
    FROM {_version}valid_customers"""
    PARTS[f"{_version}orders_stage"] = f"SELECT * FROM {_version}valid_orders"
    PARTS[f"{_version}products_stage"] = f"""
    SELECT *, CASE WHEN volume_cm3 > 0 THEN CAST(weight_kg AS DOUBLE) / volume_cm3
                   ELSE 0 END AS density_kg_cm3
    FROM (
      SELECT *,
        CASE WHEN price < 50 THEN 'Budget' WHEN price < 150 THEN 'Mid-range'
             WHEN price < 300 THEN 'Premium' ELSE 'Luxury' END AS price_segment,
        CASE WHEN stock_quantity = 0 THEN 'Out of Stock' WHEN stock_quantity < 10 THEN 'Low Stock'
             WHEN stock_quantity < 50 THEN 'Medium Stock' ELSE 'High Stock' END AS stock_status,
        {days("launch_date")} AS days_since_launch,
        CASE WHEN {days("launch_date")} < 30 THEN 'New' WHEN {days("launch_date")} < 365
             THEN 'Growth' WHEN discontinued THEN 'Discontinued' ELSE 'Mature'
        END AS lifecycle_stage,
        string_split(dimensions_cm, 'x') AS dimensions_array,
        CASE WHEN len(string_split(dimensions_cm, 'x')) = 3
             THEN TRY_CAST(string_split(dimensions_cm, 'x')[1] AS DOUBLE)
                * TRY_CAST(string_split(dimensions_cm, 'x')[2] AS DOUBLE)
                * TRY_CAST(string_split(dimensions_cm, 'x')[3] AS DOUBLE)
             ELSE 0 END AS volume_cm3
      FROM {_version}valid_products) p"""
    PARTS[f"{_version}inventory_stage"] = f"""
    SELECT *,
      CASE WHEN stock_quantity > 0 THEN CAST(reserved_quantity AS DOUBLE) / stock_quantity
           ELSE 0 END AS stock_utilization_rate,
      CASE WHEN available_quantity = 0 THEN 'Out of Stock'
           WHEN available_quantity <= reorder_level THEN 'Reorder Required'
           WHEN available_quantity <= 2 * reorder_level THEN 'Low Stock'
           ELSE 'In Stock' END AS stock_status,
      {days("last_restocked")} AS days_since_restock, {days("last_audit")} AS days_since_audit,
      CASE WHEN {days("last_audit")} > 90 THEN 'Overdue' WHEN {days("last_audit")} > 60
           THEN 'Due Soon' ELSE 'Current' END AS audit_status
    FROM {_version}valid_inventory"""
    PARTS[f"{_version}shipping_stage"] = f"""
    SELECT *,
      CASE WHEN actual_delivery IS NULL THEN 'Pending'
           WHEN delivery_days <= estimated_delivery_days THEN 'On Time'
           WHEN delivery_days <= estimated_delivery_days + 1 THEN 'Slightly Delayed'
           ELSE 'Delayed' END AS delivery_performance
    FROM (
      SELECT *,
        {days("CAST(created_timestamp AS DATE)", "actual_delivery")} AS delivery_days,
        {days("CAST(created_timestamp AS DATE)", "estimated_delivery")} AS estimated_delivery_days,
        CASE WHEN shipping_cost < 10 THEN 'Low Cost' WHEN shipping_cost < 20 THEN 'Medium Cost'
             ELSE 'High Cost' END AS cost_category,
        {quotient(cents("shipping_cost"), cents("package_weight"))} AS cost_per_kg
      FROM {_version}valid_shipping) s"""


def renamed(prefix: str, names: str) -> str:
    return ", ".join(f"{name} AS {prefix}_{name}" for name in names.split())


_META = "created_timestamp batch_id processed_timestamp source_system"
_PRODUCT = renamed(
    "product",
    f"{_META} currency weight_kg lifecycle_stage stock_quantity stock_status price_segment",
)
PARTS["customers_r"] = (
    f"SELECT * RENAME ({renamed('customer', _META + ' lifecycle_stage')}) FROM customers_stage"
)
PARTS["v1_customers_r"] = f"SELECT * RENAME ({renamed('customer', _META)}) FROM v1_customers_stage"
PARTS["products_r"] = f"SELECT * RENAME ({_PRODUCT}) FROM products_stage"
PARTS["v1_products_r"] = f"SELECT * RENAME ({_PRODUCT}) FROM v1_products_stage"
PARTS["inventory_r"] = """
    SELECT product_id, stock_status AS inventory_stock_status,
      stock_quantity AS inventory_stock_quantity, reorder_level FROM inventory_stage"""
PARTS["v1_inventory_r"] = (
    f"SELECT * RENAME ({renamed('inventory', _META + ' stock_status')}) FROM v1_inventory_stage"
)
PARTS["shipping_r"] = """
    SELECT order_id, carrier, shipping_status, delivery_performance, delivery_days,
      estimated_delivery_days, cost_per_kg, shipping_cost, currency AS shipping_currency
    FROM shipping_stage"""
PARTS["v1_shipping_r"] = (
    f"SELECT * RENAME ({renamed('shipping', _META + ' currency package_weight')})"
    " FROM v1_shipping_stage"
)

for _version in ("", "v1_"):
    PARTS[f"{_version}joined"] = f"""
    SELECT o.*, c.* EXCLUDE (customer_id), p.* EXCLUDE (product_id), i.* EXCLUDE (product_id),
      s.* EXCLUDE (order_id)
    FROM {_version}orders_stage o
    LEFT JOIN {_version}customers_r c ON c.customer_id = o.customer_id
    LEFT JOIN {_version}products_r p ON p.product_id = o.product_id
    LEFT JOIN {_version}inventory_r i ON i.product_id = o.product_id
    LEFT JOIN {_version}shipping_r s ON s.order_id = o.order_id"""

PARTS["fact"] = """
    SELECT *, order_amount - price AS order_profit_margin, order_amount * 12 AS estimated_clv,
      CASE WHEN month(order_date) IN (12, 1, 2) THEN 'Winter'
           WHEN month(order_date) IN (3, 4, 5) THEN 'Spring'
           WHEN month(order_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
      dayofweek(order_date) + 1 AS day_of_week,
      (dayofweek(order_date) + 1) IN (1, 7) AS is_weekend,
      CASE WHEN hour(created_timestamp) < 12 THEN 'Morning'
           WHEN hour(created_timestamp) < 17 THEN 'Afternoon'
           WHEN hour(created_timestamp) < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day
    FROM joined"""
PARTS["v1_fact"] = """
    SELECT *, CAST(order_amount AS DOUBLE) * 0.3 AS order_profit_margin,
      order_amount * CASE customer_tier WHEN 'premium' THEN 10 WHEN 'gold' THEN 7
                          WHEN 'silver' THEN 5 ELSE 3 END AS estimated_clv,
      CASE WHEN month(order_date) IN (12, 1, 2) THEN 'winter'
           WHEN month(order_date) IN (3, 4, 5) THEN 'Spring'
           WHEN month(order_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
      dayofweek(order_date) + 1 AS day_of_week,
      coalesce((dayofweek(order_date) + 1) IN (1, 7), false) AS is_weekend,
      CASE WHEN hour(created_timestamp) < 6 THEN 'Early Morning'
           WHEN hour(created_timestamp) < 12 THEN 'Morning'
           WHEN hour(created_timestamp) < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day
    FROM v1_joined"""


def _profit(version: str, alias: str) -> str:
    if version:
        return f"round(sum(order_profit_margin), 3) AS {alias}"
    return f"CAST(sum(order_profit_margin) AS DOUBLE) AS {alias}"


def customer_analytics(version: str, when: str) -> str:
    return f"""
    SELECT *, CAST(days_since_first_order AS DOUBLE) / total_orders AS order_frequency_days,
      CASE WHEN total_spent >= 1000 AND total_orders >= 5 THEN 'VIP'
           WHEN total_spent >= 500 AND total_orders >= 3 THEN 'High Value'
           WHEN total_spent >= 200 AND total_orders >= 2 THEN 'Medium Value'
           ELSE 'Low Value' END AS customer_segment,
      CASE WHEN days_since_last_order <= 30 THEN 'Active'
           WHEN days_since_last_order <= 90 THEN 'At Risk'
           WHEN days_since_last_order <= 180 THEN 'Inactive' ELSE 'Lost' END AS lifecycle_stage
    FROM (
      SELECT a.*, c.* EXCLUDE (customer_id), {days("first_order_date")} AS days_since_first_order,
        {days("last_order_date")} AS days_since_last_order
      FROM (
        SELECT customer_id, count(order_id) AS total_orders, sum(order_amount) AS total_spent,
          {mean("order_amount")} AS avg_order_value, min(order_date) AS first_order_date,
          max(order_date) AS last_order_date,
          count(DISTINCT product_id) AS unique_products_purchased,
          count(DISTINCT category) AS unique_categories_purchased,
          {_profit(version, "total_profit_generated")},
          {mean("estimated_clv")} AS avg_estimated_clv
        FROM {version}fact WHERE {when} GROUP BY customer_id) a
      LEFT JOIN {version}customers_r c ON c.customer_id = a.customer_id) x"""


def product_analytics(version: str, when: str) -> str:
    frequency = (
        ", CAST(days_since_first_order AS DOUBLE) / total_orders AS order_frequency_days"
        if version
        else ""
    )
    return f"""
    SELECT *, {quotient(cents("total_revenue"), "100 * unique_customers")} AS revenue_per_customer,
      CASE WHEN total_revenue >= 5000 AND total_orders >= 20 THEN 'Star'
           WHEN total_revenue >= 2000 AND total_orders >= 10 THEN 'High Performer'
           WHEN total_revenue >= 500 AND total_orders >= 5 THEN 'Medium Performer'
           ELSE 'Low Performer' END AS performance_category,
      CASE WHEN days_since_last_order <= 30 THEN 'Active'
           WHEN days_since_last_order <= 90 THEN 'Declining'
           WHEN discontinued THEN 'Discontinued' ELSE 'Stagnant' END AS product_lifecycle
      {frequency}
    FROM (
      SELECT a.*, p.* EXCLUDE (product_id), {days("first_order_date")} AS days_since_first_order,
        {days("last_order_date")} AS days_since_last_order
      FROM (
        SELECT product_id, count(order_id) AS total_orders, sum(order_amount) AS total_revenue,
          {mean("order_amount")} AS avg_order_value,
          count(DISTINCT customer_id) AS unique_customers, {_profit(version, "total_profit")},
          min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM {version}fact WHERE {when} GROUP BY product_id) a
      LEFT JOIN {version}products_r p ON p.product_id = a.product_id) x"""


FIRST = "order_date < DATE '2001-01-01'"
SECOND = "(order_date >= DATE '2000-07-01' OR order_date IS NULL)"
HISTORY_COLUMNS = {
    "orders": """order_id, customer_id, product_id, order_date, order_amount, currency,
      payment_method, shipping_address, order_status, created_timestamp, processed_timestamp,
      batch_id, source_system, order_profit_margin, estimated_clv, season, day_of_week,
      is_weekend, time_of_day""",
    "customers": """customer_id, first_name, last_name, email, phone, date_of_birth,
      registration_date, address, city, state, zip_code, country, customer_tier, last_login,
      customer_created_timestamp, age, age_segment, days_since_registration, lifecycle_stage,
      total_orders, total_spent, avg_order_value, customer_segment""",
    "products": """product_id, product_name, category, subcategory, brand, price,
      product_currency, product_stock_quantity, product_weight_kg, dimensions_cm, color, material,
      description, launch_date, discontinued, product_created_timestamp, product_price_segment,
      product_stock_status, days_since_launch, product_lifecycle_stage, volume_cm3,
      density_kg_cm3, total_orders, total_revenue, unique_customers, performance_category,
      product_lifecycle""",
}

for _version in ("", "v1_"):
    PARTS[f"{_version}customer_analytics"] = customer_analytics(_version, "true")
    PARTS[f"{_version}product_analytics"] = product_analytics(_version, "true")
    for _load, _when in (("first", FIRST), ("second", SECOND), ("whole", "true")):
        _built = {
            "orders": f"SELECT * FROM {_version}fact WHERE {_when}",
            "customers": customer_analytics(_version, _when),
            "products": product_analytics(_version, _when),
        }
        for _name, _sql in _built.items():
            PARTS[f"{_version}{_name}_{_load}"] = (
                f"SELECT {HISTORY_COLUMNS[_name]} FROM ({_sql}) b"
            )


def history(
    version: str, name: str, load_twice: bool, guard: bool = True, closed: bool = False
) -> str:
    """History after one or two loads on consecutive days, with or without older closed rows."""
    key = f"{name[:-1]}_id"

    def version_of(load: str, start: str, end: str, current: str) -> str:
        return (
            f"SELECT *, CAST({start} AS DATE) AS effective_date, CAST({end} AS DATE)"
            f" AS expiry_date, {current} AS is_current FROM {version}{name}_{load}"
        )

    state = version_of("first" if load_twice else "whole", DAY, "NULL", "true")
    if closed:
        state += " UNION ALL " + version_of("first", f"{DAY} - 30", DAY, "false")
    if load_twice:
        today = f"CAST({DAY} + 1 AS DATE)"
        batch = f"{version}{name}_second"
        hit = f"{key} IN (SELECT {key} FROM {batch} WHERE {key} IS NOT NULL)"
        if guard:
            hit = f"is_current AND {hit}"
        state = f"""
        SELECT * REPLACE (CASE WHEN {hit} THEN {today} ELSE expiry_date END AS expiry_date,
                          CASE WHEN {hit} THEN false ELSE is_current END AS is_current)
        FROM ({state}) h0 UNION ALL {version_of("second", today, "NULL", "true")}"""
    return f"({state}) h"


def with_parts(final: str) -> str:
    """``final`` behind the named subqueries it needs, in order of need."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
            if name in PARTS and name not in ordered:
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(final)
    if not ordered:
        return final
    heads = ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered)
    return f"WITH {heads}\n{final}"


STAGE_EXPORT = {
    "orders": [
        *dec("order_amount"),
        *text("created_timestamp processed_timestamp"),
    ],
    "customers": text("last_login created_timestamp processed_timestamp"),
    "products": [
        *dec("price weight_kg"),
        *big("stock_quantity"),
        *text("created_timestamp processed_timestamp"),
    ],
    "inventory": [
        *big("stock_quantity reserved_quantity available_quantity reorder_level"),
        *text("created_timestamp processed_timestamp"),
    ],
    "shipping": [
        *dec("shipping_cost package_weight insurance_value"),
        *text("created_timestamp processed_timestamp"),
    ],
}
DIMENSIONS = ["array_to_string(dimensions_array, '|') AS dimensions_array"]
CUSTOMER_EXPORT = text("last_login customer_created_timestamp customer_processed_timestamp")
PRODUCT_EXPORT = [
    *dec("price product_weight_kg"),
    *big("product_stock_quantity"),
    *text("product_created_timestamp product_processed_timestamp"),
    *DIMENSIONS,
]
FACT_EXPORT = [
    *STAGE_EXPORT["orders"],
    *CUSTOMER_EXPORT,
    *PRODUCT_EXPORT,
    *dec("shipping_cost order_profit_margin estimated_clv"),
    *big("reorder_level"),
]
HISTORY_EXPORT = {
    "orders": [
        *STAGE_EXPORT["orders"],
        *dec("order_profit_margin estimated_clv"),
    ],
    "customers": [*text("last_login customer_created_timestamp"), *dec("total_spent")],
    "products": [
        *dec("price product_weight_kg total_revenue"),
        *big("product_stock_quantity"),
        *text("product_created_timestamp"),
    ],
}


def quality_report(domain: str, counters: dict[str, str], valid: str, invalid: str) -> str:
    items = ", ".join(
        f"count(*) FILTER (WHERE {condition}) AS {name}" for name, condition in counters.items()
    )
    return f"""SELECT *, total_records - valid_records - invalid_records AS lost_records FROM (
      SELECT count(*) AS total_records, {items},
        count(*) FILTER (WHERE {valid}) AS valid_records,
        count(*) FILTER (WHERE {invalid}) AS invalid_records
      FROM raw_{domain}) q"""


def errors(domain: str, condition: str, version: str = "") -> str:
    return f"""SELECT * REPLACE ({", ".join(STAGE_EXPORT[domain])}),
      'Data quality validation failed' AS error_reason,
      CAST({NOW} AS VARCHAR) AS error_timestamp
    FROM {version}stamped_{domain} WHERE {condition}"""


def unmatched(version: str, left: str, right: str, key: str) -> str:
    return f"""FROM {version}{left}_stage l WHERE NOT EXISTS (
      SELECT 1 FROM {version}{right}_stage r WHERE r.{key} = l.{key})"""


def offender_sources(version: str = "") -> dict[str, str]:
    """FROM clauses whose rows are the offenders of each check."""
    v = version
    return {
        "orphaned_orders": unmatched(v, "orders", "customers", "customer_id"),
        "orphaned_customers": unmatched(v, "customers", "orders", "customer_id"),
        "unreasonable_order_amounts": (
            f"FROM {v}orders_stage l WHERE order_amount < 1 OR order_amount > 10000"
        ),
        "orders_invalid_product": unmatched(v, "orders", "products", "product_id"),
        "price_mismatch": (
            f"FROM {v}orders_stage l JOIN (SELECT product_id, price FROM {v}products_stage) r"
            " USING (product_id) WHERE abs(order_amount - price) > 0.01"
        ),
        "orders_without_shipping": unmatched(v, "orders", "shipping", "order_id"),
        "unreasonable_shipping_cost": (
            f"FROM {v}shipping_stage l WHERE shipping_cost < 0 OR shipping_cost > 100"
        ),
        "products_without_inventory": unmatched(v, "products", "inventory", "product_id"),
        "low_value_premium_orders": (
            f"FROM {v}orders_stage l JOIN (SELECT customer_id, customer_tier"
            f" FROM {v}customers_stage) r USING (customer_id)"
            " WHERE customer_tier = 'premium' AND order_amount < 100"
        ),
        "orders_outside_hours": (
            f"FROM {v}orders_stage l"
            " WHERE hour(created_timestamp) < 8 OR hour(created_timestamp) > 18"
        ),
        "discontinued_product_orders": (
            f"FROM {v}orders_stage l JOIN (SELECT product_id, discontinued"
            f" FROM {v}products_stage) r USING (product_id) WHERE discontinued"
        ),
        "products_without_orders": unmatched(v, "products", "orders", "product_id"),
        "shipping_without_orders": unmatched(v, "shipping", "orders", "order_id"),
        "inventory_without_products": unmatched(v, "inventory", "products", "product_id"),
        "stock_mismatch": (
            "FROM (SELECT product_id, inventory_id, stock_quantity AS inventory_stock"
            f" FROM {v}inventory_stage) l JOIN (SELECT product_id, stock_quantity AS product_stock"
            f" FROM {v}products_stage) r USING (product_id) WHERE inventory_stock <> product_stock"
        ),
    }


OFFENDER_DOMAIN = {
    "orphaned_customers": "customers",
    "unreasonable_shipping_cost": "shipping",
    "products_without_inventory": "products",
    "products_without_orders": "products",
    "shipping_without_orders": "shipping",
    "inventory_without_products": "inventory",
}
STAGE_EXTRA = {"products": DIMENSIONS}


def offenders(check: str) -> str:
    source = offender_sources()[check]
    domain = OFFENDER_DOMAIN.get(check, "orders")
    items = STAGE_EXPORT[domain] + STAGE_EXTRA.get(domain, [])
    if check == "price_mismatch":
        items = items + dec("price")
    return f"SELECT * REPLACE ({', '.join(items)}) {source}"


# (name, severity, description) of the stored checks in both generations.
RESULTS = [
    ("orphaned_orders", "HIGH", "Orders without valid customers"),
    ("orphaned_customers", "MEDIUM", "Customers without any orders"),
    ("unreasonable_order_amounts", "HIGH", "Orders with amounts outside expected range"),
    ("orders_invalid_product", "HIGH", "Orders with no matching product"),
    ("price_mismatch", "MEDIUM", "Order amount differs from product price"),
    ("orders_without_shipping", "HIGH", "Orders with no shipping record"),
    ("unreasonable_shipping_cost", "MEDIUM", "Shipping cost outside expected range"),
    ("products_without_inventory", "MEDIUM", "Products with no inventory record"),
    ("low_value_premium_orders", "LOW", "Premium customers with low-value orders"),
    ("orders_outside_hours", "LOW", "Orders placed outside business hours"),
    ("discontinued_product_orders", "HIGH", "Orders placed for discontinued products"),
]
V1_TEXTS = {
    "unreasonable_order_amounts": ("unreasonable_orders", "Orders with unreasonable amounts"),
    "orders_invalid_product": ("orphaned_orders_products", "Orders with invalid products"),
    "price_mismatch": ("price_mismatch", "Orders with price mismatches"),
    "orders_without_shipping": (
        "orders_without_shipping",
        "Orders without shipping information",
    ),
    "unreasonable_shipping_cost": ("unreasonable_shipping", "Shipping with unreasonable costs"),
    "products_without_inventory": ("products_without_inventory", "Products without inventory"),
    "discontinued_product_orders": ("discontinued_orders", "Orders for discontinued products"),
}


def check_counts(version: str) -> str:
    sources = offender_sources(version)
    names = [name for name in sources if version or name != "stock_mismatch"]
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS validation_type, count(*) AS count {sources[name]}" for name in names
    )


def validation_results(version: str) -> str:
    sources = offender_sources(version)
    rows = []
    for name, severity, description in RESULTS:
        label, description = (
            V1_TEXTS.get(name, (name, description)) if version else (name, description)
        )
        rows.append(
            f"SELECT '{label}' AS validation_type, count(*) AS count, CASE WHEN count(*) > 0"
            f" THEN '{severity}' ELSE 'NONE' END AS severity, '{description}' AS description"
            f" {sources[name]}"
        )
    return "\nUNION ALL ".join(rows)


def results(version: str) -> str:
    stamp = (
        f"CAST({NOW} AS VARCHAR) AS validation_timestamp, {BATCH} AS batch_id"
        if version
        else f"CAST({NOW} AS VARCHAR) AS validated_at"
    )
    return f"SELECT *, {stamp} FROM ({validation_results(version)}) r"


def gate(version: str) -> str:
    levels = ("high", "medium", "low") if version else ("high",)
    passed, failed = ("PASS", "FAIL") if version else ("PASSED", "FAILED")
    issues = ", ".join(
        f"count(*) FILTER (WHERE severity = '{level.upper()}') AS {level}_severity_issues"
        for level in levels
    )
    return f"""SELECT {issues}, CAST(sum(count) AS BIGINT) AS total_findings,
      CASE WHEN count(*) FILTER (WHERE severity = 'HIGH') > 0 THEN '{failed}'
           ELSE '{passed}' END AS overall_status
    FROM ({validation_results(version)}) r"""


LOG_TIME = "'2001-08-02T10:30:00.000000'"


def log_select(task: str, total: str, valid: str, invalid: str, source: str) -> str:
    return f"""SELECT CAST(0 AS BIGINT) AS archived_files, {invalid} AS invalid_records,
      CASE WHEN {invalid} = 0 THEN 'SUCCESS' ELSE 'SUCCESS_WITH_WARNINGS' END AS status,
      '{task}' AS task, {LOG_TIME} AS timestamp, {total} AS total_records,
      {valid} AS valid_records FROM {source}"""


def process_log() -> str:
    return "\nUNION ALL ".join(
        log_select(
            f"{domain}_stage_load",
            "count(*)",
            f"count(*) FILTER (WHERE {condition})",
            f"count(*) FILTER (WHERE NOT ({condition}))",
            f"raw_{domain}",
        )
        for domain, condition in VALID.items()
    )


def summary(version: str) -> str:
    if version:
        profit = "round(sum(order_profit_margin), 3)"
        ratio = "round(sum(order_profit_margin) / CAST(sum(order_amount) AS DOUBLE) * 100, 6)"
        name = "profit_margin_percentage"
    else:
        profit = "CAST(sum(order_profit_margin) AS DOUBLE)"
        ratio = quotient(
            "100 * sum(CAST(order_profit_margin * 100 AS HUGEINT))",
            "sum(CAST(order_amount * 100 AS HUGEINT))",
        )
        name = "profit_margin_pct"
    return f"""
    SELECT count(order_id) AS total_orders, CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
      {mean("order_amount")} AS avg_order_value,
      count(DISTINCT customer_id) AS unique_customers,
      count(DISTINCT product_id) AS unique_products, {profit} AS total_profit,
      {mean("estimated_clv")} AS avg_estimated_clv, {ratio} AS {name},
      {quotient(f"sum({cents('order_amount')})", "100 * count(DISTINCT customer_id)")}
        AS revenue_per_customer,
      CAST(count(order_id) AS DOUBLE) / nullif(count(DISTINCT customer_id), 0)
        AS orders_per_customer,
      {DAY} AS report_date, CAST({NOW} AS VARCHAR) AS report_timestamp
    FROM {version}fact"""


def report(by: str, counted: str, measured: str, names: tuple[str, str, str], source: str) -> str:
    return f"""SELECT {by}, count({counted}) AS {names[0]},
      CAST(sum({measured}) AS DOUBLE) AS {names[1]}, {mean(measured)} AS {names[2]}
    FROM {source} GROUP BY {by}"""


def row_counts() -> str:
    tables = {f"{domain}_stage": f"{domain}_stage" for domain in VALID}
    tables["enriched_orders"] = "fact"
    tables["customer_analytics"] = "customer_analytics"
    tables["product_analytics"] = "product_analytics"
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {part}"
        for name, part in tables.items()
    )


def v1_log() -> str:
    nothing = "CAST(NULL AS BIGINT)"
    steps = [
        ("data_validation", "CAST(NULL AS VARCHAR)", nothing, ""),
        ("data_enrichment", "'SUCCESS'", nothing, ""),
        ("final_merge_operation", "'SUCCESS'", "count(order_id)", "FROM v1_fact"),
    ]
    return "\nUNION ALL ".join(
        f"""SELECT {nothing} AS archived_files, {nothing} AS invalid_records, {status} AS status,
      '{task}' AS task, {LOG_TIME} AS timestamp, {total} AS total_records, {total} AS valid_records {source}"""
        for task, status, total, source in steps
    )


def v1_appended() -> str:
    return f"""SELECT r.* REPLACE (b.batch AS batch_id) FROM ({results("v1_")}) r
      CROSS JOIN (SELECT unnest([{BATCH}, 'later']) AS batch) b"""


def scanned(domain: str) -> str:
    """What parsing the text of a domain's CSV files under its schema gives."""
    kinds = sample.columns_of(domain)
    last = list(kinds)[-1]
    shown = {"DATE": "{}", "BOOLEAN": "{}", "INT": "CAST({} AS BIGINT)", "TIMESTAMP": "CAST({} AS VARCHAR)"}
    items, broken = [], ["is_short", "is_long"]
    for name, kind in kinds.items():
        if kind == "STRING":
            items.append(name)
            continue
        source = f"CASE WHEN NOT is_short THEN {name} END" if name == last else name
        parsed = f"TRY_CAST({source} AS {kind})"
        broken.append(f"({source} IS NOT NULL AND {parsed} IS NULL)")
        items.append(f"{shown.get(kind, 'CAST({} AS DOUBLE)').format(parsed)} AS {name}")
    return f"SELECT {', '.join(items)}, {' OR '.join(broken)} AS is_corrupt FROM text_{domain}"


def _finals() -> dict[str, str]:
    q: dict[str, str] = {}
    for domain, valid in VALID.items():
        q[f"{domain}_csv"] = scanned(domain)
        q[f"{domain}_valid"] = export(f"valid_{domain}", STAGE_EXPORT[domain])
        q[f"{domain}_rejected"] = errors(domain, f"NOT ({valid})")
        q[f"{domain}_rejected_strict"] = errors(domain, f"NOT coalesce({valid}, false)")
        q[f"dq_{domain}"] = quality_report(domain, COUNTERS[domain], valid, f"NOT ({valid})")
        q[f"{domain}_stage"] = export(
            f"{domain}_stage", STAGE_EXPORT[domain], STAGE_EXTRA.get(domain, [])
        )
        q[f"v1_{domain}_rejected"] = errors(domain, V1_REJECTED[domain], "v1_")
    q["orders_stream"] = q["orders_stage"]
    q["process_log"] = process_log()
    q["v1_process_log"] = v1_log()
    q["v1_appended_results"] = v1_appended()
    q["row_counts"] = row_counts()
    for check in offender_sources():
        if check != "stock_mismatch":
            q[check] = offenders(check)
    q["v1_stock_mismatch"] = (
        f"SELECT * REPLACE ({', '.join(big('inventory_stock product_stock'))})"
        f" {offender_sources('v1_')['stock_mismatch']}"
    )
    for version in ("", "v1_"):
        q[f"{version}check_counts"] = check_counts(version)
        q[f"{version}validation_results"] = results(version)
        q[f"{version}validation_gate"] = gate(version)
    q["validation_log"] = log_select(
        "data_validation",
        "total_findings",
        "CAST(0 AS BIGINT)",
        "high_severity_issues",
        f"({gate('')}) g",
    )
    q["enriched_orders"] = export("fact", FACT_EXPORT, big("inventory_stock_quantity"))
    q["enriched_orders_spread"] = q["enriched_orders"]
    q["v1_enriched_orders"] = export(
        "v1_fact",
        FACT_EXPORT,
        dec("shipping_package_weight insurance_value"),
        big("stock_quantity reserved_quantity available_quantity"),
        text(
            "inventory_created_timestamp inventory_processed_timestamp"
            " shipping_created_timestamp shipping_processed_timestamp"
        ),
    )
    for version in ("", "v1_"):
        q[f"{version}customer_analytics"] = export(
            f"{version}customer_analytics", CUSTOMER_EXPORT, dec("total_spent")
        )
        q[f"{version}product_analytics"] = export(
            f"{version}product_analytics", PRODUCT_EXPORT, dec("total_revenue")
        )
        q[f"{version}analytics_summary"] = summary(version)
        q[f"{version}seasonal_analysis"] = report(
            "season",
            "order_id",
            "order_amount",
            ("orders_count", "seasonal_revenue", "avg_seasonal_order_value"),
            f"{version}fact",
        )
    q["customer_analytics_spread"] = q["customer_analytics"]
    q["segment_analysis"] = report(
        "customer_segment",
        "customer_id",
        "total_spent",
        ("customers_count", "segment_revenue", "avg_segment_value"),
        "customer_analytics",
    )
    q["category_analysis"] = report(
        "category",
        "product_id",
        "total_revenue",
        ("products_count", "category_revenue", "avg_category_revenue"),
        "product_analytics",
    )
    for name in HISTORY_COLUMNS:
        for label, load_twice in (("first", False), ("second", True)):
            q[f"scd2_{name}_{label}"] = export(history("", name, load_twice), HISTORY_EXPORT[name])
        # The older rules spare closed rows of orders only.
        q[f"v1_scd2_{name}"] = export(
            history("v1_", name, True, guard=name == "orders", closed=True), HISTORY_EXPORT[name]
        )
    q["scd2_customers_closed"] = export(
        history("", "customers", True, closed=True), HISTORY_EXPORT["customers"]
    )
    q["v1_bad_email_phone"] = quality_report(
        "customers", V1_CUSTOMER_COUNTERS, VALID["customers"], V1_REJECTED["customers"]
    )
    q["v1_customers_stage"] = export("v1_customers_stage", STAGE_EXPORT["customers"])
    return q


def oracle_sql() -> dict[str, str]:
    return {name: with_parts(sql) for name, sql in _finals().items()}
