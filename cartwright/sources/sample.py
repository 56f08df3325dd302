"""The five raw domains derived from a star schema, as SQL that Spark and DuckDB read alike.

The expressions plant defective rows for every rule: missing and malformed values, amounts out of
range, keys without partner, several warehouses per product.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import replace
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import schemas
from cartwright.config import RuleBook
from cartwright.sources.tables import rows_of

# The clock of all sample queries.
AS_OF = dt.date(2001, 8, 2)
NOW = dt.datetime(2001, 8, 2, 10, 30, 0)
BATCH_ID = "20010802_103000"

CUSTOMERS = """
SELECT CASE WHEN c_custkey%97=96 THEN NULL ELSE CAST(c_custkey AS STRING) END AS customer_id,
  'Customer' AS first_name, c_name AS last_name,
  CASE WHEN c_custkey%41=40 THEN NULL WHEN c_custkey%43=42 THEN 'user'||c_custkey||'.example'
       ELSE 'user'||c_custkey||'@example.com' END AS email,
  CASE WHEN c_custkey%47=46 THEN NULL WHEN c_custkey%53=52 THEN '5550100'
       ELSE '555-010-'||lpad(CAST(c_custkey%10000 AS STRING),4,'0') END AS phone,
  CASE WHEN c_custkey%59=58 THEN NULL WHEN c_custkey%61=60 THEN DATE'2030-01-01'
       ELSE DATE'1930-01-01'+CAST(c_custkey*7919%26000 AS INT) END AS date_of_birth,
  DATE'2001-08-01'-CAST(c_custkey*13%900 AS INT) AS registration_date,
  'Address '||c_custkey AS address, 'City '||c_nationkey AS city, 'S'||(c_nationkey%10) AS state,
  lpad(CAST(c_custkey%100000 AS STRING),5,'0') AS zip_code, n_name AS country,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'BUILDING' THEN 'gold'
       WHEN 'FURNITURE' THEN 'silver' ELSE 'standard' END AS customer_tier,
  TIMESTAMP'2001-07-01 12:00:00' AS last_login, TIMESTAMP'2000-01-01 09:00:00' AS created_timestamp
FROM customer LEFT JOIN nation ON n_nationkey=c_nationkey
"""

PRODUCTS = """
SELECT CASE WHEN p_partkey%101=100 THEN NULL ELSE CAST(p_partkey AS STRING) END AS product_id,
  p_name AS product_name, p_type AS category, p_type||'-'||(p_size%5) AS subcategory, p_brand AS brand,
  CASE WHEN p_partkey%67=66 THEN CAST(0 AS DECIMAL(10,2)) WHEN p_partkey%71=70 THEN NULL
       ELSE CAST(CAST(p_partkey*3701%40000+1000 AS DOUBLE)/100 AS DECIMAL(10,2)) END AS price,
  'USD' AS currency,
  CAST(CASE WHEN p_partkey%73=72 THEN -1 ELSE p_partkey*7%90 END AS INT) AS stock_quantity,
  CAST(CAST(p_size*25 AS DOUBLE)/100 AS DECIMAL(8,2)) AS weight_kg,
  CASE WHEN p_partkey%19=18 THEN '10x20' WHEN p_partkey%79=78 THEN '10xABCx5'
       ELSE CAST(10+p_partkey%5 AS STRING)||'x'||CAST(5+p_partkey%7 AS STRING)||'x'||CAST(1+p_partkey%3 AS STRING) END AS dimensions_cm,
  'color-'||(p_partkey%6) AS color, 'steel' AS material, p_name AS description,
  CASE WHEN p_partkey%83=82 THEN DATE'2030-01-01' ELSE DATE'2001-07-31'-CAST(p_partkey*11%1500 AS INT) END AS launch_date,
  p_partkey%10=0 AS discontinued, TIMESTAMP'2000-01-01 09:00:00' AS created_timestamp
FROM part
"""

ORDERS = """
SELECT CASE WHEN o_orderkey%211=210 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS order_id,
  CASE WHEN o_orderkey%223=222 THEN NULL WHEN o_orderkey%37=36 THEN 'missing-'||o_custkey
       ELSE CAST(o_custkey AS STRING) END AS customer_id,
  CAST(p AS STRING) AS product_id, CAST(o_orderdate AS DATE) AS order_date,
  CASE WHEN o_orderkey%227=226 THEN NULL WHEN o_orderkey%229=228 THEN CAST(-5 AS DECIMAL(10,2))
       WHEN o_orderkey%31=30 THEN CAST(0.5 AS DECIMAL(10,2))
       WHEN o_orderkey%29=28 THEN CAST(CAST(FLOOR(o_totalprice) AS DOUBLE)/20 AS DECIMAL(10,2))
       WHEN o_orderkey%11=0 THEN CAST(CAST(p*3701%40000+1000 AS DOUBLE)/100 AS DECIMAL(10,2))
       ELSE CAST(CAST(CAST(FLOOR(o_totalprice) AS BIGINT)%100000 AS DOUBLE)/100 AS DECIMAL(10,2)) END AS order_amount,
  'USD' AS currency, CASE o_orderkey%3 WHEN 0 THEN 'card' WHEN 1 THEN 'wallet' ELSE 'transfer' END AS payment_method,
  'Address '||o_custkey AS shipping_address, o_orderstatus AS order_status,
  CAST(CAST(CAST(o_orderdate AS DATE) AS STRING)||' '||lpad(CAST(o_orderkey*5%24 AS STRING),2,'0')||':00:00' AS TIMESTAMP) AS created_timestamp
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem GROUP BY l_orderkey) l ON l_orderkey=o_orderkey
"""

INVENTORY = """
SELECT CASE WHEN (p+s)%103=102 THEN NULL ELSE CAST(p AS STRING)||'-'||CAST(s AS STRING) END AS inventory_id,
  CASE WHEN (p+s)%107=106 OR p%157=156 THEN 'missing-'||p ELSE CAST(p AS STRING) END AS product_id,
  'W'||s AS warehouse_id, 'Warehouse '||s AS warehouse_name, 'Loc '||(s%7) AS location,
  CAST(CASE WHEN (p*31+s)%109=108 THEN -1 ELSE (p*31+s)%120 END AS INT) AS stock_quantity,
  CAST((p+s)%40 AS INT) AS reserved_quantity, CAST((p*17+s)%60 AS INT) AS available_quantity, CAST(p%25 AS INT) AS reorder_level,
  DATE'2001-08-01'-CAST((p+s)%200 AS INT) AS last_restocked, DATE'2001-08-01'-CAST((p*3+s)%150 AS INT) AS last_audit,
  TIMESTAMP'2000-01-01 09:00:00' AS created_timestamp
FROM (SELECT DISTINCT l_partkey AS p, coalesce(n_regionkey, 0) AS s
      FROM lineitem LEFT JOIN supplier ON s_suppkey=l_suppkey
      LEFT JOIN nation ON n_nationkey=s_nationkey) t
"""

SHIPPING = """
SELECT CASE WHEN o_orderkey%131=130 THEN NULL ELSE 'SH'||o_orderkey END AS shipping_id,
  CASE WHEN o_orderkey%127=126 THEN 'missing-'||o_orderkey ELSE CAST(o_orderkey AS STRING) END AS order_id,
  'TRK'||o_orderkey AS tracking_number, 'Carrier-'||(o_orderkey%4) AS carrier,
  CASE o_orderkey%2 WHEN 0 THEN 'standard' ELSE 'express' END AS service_type,
  'W'||(o_orderkey%10) AS origin_warehouse, 'Address '||o_custkey AS destination_address,
  CASE WHEN o_orderkey%137=136 THEN CAST(-1 AS DECIMAL(10,2)) WHEN o_orderkey%17=16 THEN CAST(150 AS DECIMAL(10,2))
       ELSE CAST(CAST(o_orderkey*7%3000 AS DOUBLE)/100 AS DECIMAL(10,2)) END AS shipping_cost,
  'USD' AS currency, CAST(o_orderdate AS DATE)+CAST(3+o_orderkey%5 AS INT) AS estimated_delivery,
  CASE WHEN o_orderkey%7=6 THEN NULL ELSE CAST(o_orderdate AS DATE)+CAST(1+o_orderkey%11 AS INT) END AS actual_delivery,
  CASE WHEN o_orderkey%7=6 THEN 'in_transit' ELSE 'delivered' END AS shipping_status,
  CASE WHEN o_orderkey%139=138 THEN CAST(0 AS DECIMAL(8,2)) ELSE CAST(CAST(o_orderkey%2000+50 AS DOUBLE)/100 AS DECIMAL(8,2)) END AS package_weight,
  '10x10x10' AS package_dimensions,
  CASE WHEN o_orderkey%149=148 THEN CAST(-1 AS DECIMAL(10,2)) ELSE CAST(o_orderkey%500 AS DECIMAL(10,2)) END AS insurance_value,
  CAST(CAST(CAST(o_orderdate AS DATE) AS STRING)||' '||lpad(CAST(o_orderkey*5%24 AS STRING),2,'0')||':00:00' AS TIMESTAMP) AS created_timestamp
FROM orders
"""

SQL = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "shipping": SHIPPING,
}

# Tables each view reads. The first is the one whose rows it is made of, so it has no more rows than that.
INPUTS = {
    "orders": ("orders", "lineitem"),
    "customers": ("customer", "nation"),
    "products": ("part",),
    "inventory": ("lineitem", "supplier", "nation"),
    "shipping": ("orders",),
}

#: Rows of a table that one task groups, where their number is known.
TASK_ROWS = 500_000

# The keys by which a table that a view groups is dealt: orders are joined by theirs too, so it costs no further
# exchange; a part with many rows is spread by its suppliers.
DEALT_BY = {"orders": {"lineitem": ("l_orderkey",)}, "inventory": {"lineitem": ("l_partkey", "l_suppkey")}}


# What is written in place of a value in the CSV files, by column and condition.
CSV_DEFECTS: dict[str, list[tuple[str, str, str]]] = {
    "orders": [
        ("order_amount", "order_id LIKE '%17'", "n/a"),
        ("order_amount", "order_id LIKE '%43'", "123456789.00"),
        ("order_date", "order_id LIKE '%23'", "2001-02-30"),
        ("created_timestamp", "order_id LIKE '%31'", "noon"),
        ("shipping_address", "order_id LIKE '%71'", 'Flat "2", second floor'),
    ],
    "customers": [
        ("date_of_birth", "customer_id LIKE '%17'", "unknown"),
        ("registration_date", "customer_id LIKE '%31'", "2001-13-01"),
        ("last_login", "customer_id LIKE '%23'", "never"),
        ("address", "customer_id LIKE '%71'", 'The "Mill", 2'),
    ],
    "products": [
        ("price", "product_id LIKE '%17'", "free"),
        ("stock_quantity", "product_id LIKE '%23'", "dozens"),
        ("discontinued", "product_id LIKE '%31'", "maybe"),
        ("weight_kg", "product_id LIKE '%43'", "12kg"),
        ("launch_date", "product_id LIKE '%47'", "soon"),
        ("description", "product_id LIKE '%71'", 'so-called "steel", blue'),
    ],
    "inventory": [
        ("stock_quantity", "inventory_id LIKE '%7-1'", "many"),
        ("reorder_level", "inventory_id LIKE '%3-0'", "99999999999"),
        ("last_audit", "inventory_id LIKE '%3-2'", "never"),
        ("warehouse_name", "inventory_id LIKE '%5-1'", 'Dock "B", left'),
    ],
    "shipping": [
        ("shipping_cost", "shipping_id LIKE '%17'", "$5"),
        ("estimated_delivery", "shipping_id LIKE '%23'", "soon"),
        ("package_weight", "shipping_id LIKE '%43'", "99999999.00"),
        ("insurance_value", "shipping_id LIKE '%31'", "--"),
        ("destination_address", "shipping_id LIKE '%71'", 'Flat "2", second floor'),
    ],
}
# Lines that lack their last field, and lines with one more.
CSV_SHORT = {
    "orders": "order_id LIKE '%59'",
    "customers": "customer_id LIKE '%59'",
    "products": "product_id LIKE '%59'",
    "inventory": "inventory_id LIKE '%9-3'",
    "shipping": "shipping_id LIKE '%59'",
}
CSV_LONG = {
    "orders": "order_id LIKE '%61'",
    "customers": "customer_id LIKE '%61'",
    "products": "product_id LIKE '%61'",
    "inventory": "inventory_id LIKE '%1-4'",
    "shipping": "shipping_id LIKE '%61'",
}


def columns_of(domain: str) -> dict[str, str]:
    """Names and types of the domain's raw columns."""
    return dict(re.findall(r"(\w+) ([A-Z]+(?:\(\d+,\d+\))?)", schemas.RAW[domain]))


def text_sql(domain: str, source: str) -> str:
    """The raw rows of ``source`` as text, defects planted, with whether a line is short or long."""
    items = []
    for name in columns_of(domain):
        planted = "".join(
            f"WHEN {condition} THEN '{text}' "
            for column, condition, text in CSV_DEFECTS[domain]
            if column == name
        )
        text = f"CAST({name} AS STRING)"
        items.append(f"CASE {planted}ELSE {text} END AS {name}" if planted else f"{text} AS {name}")
    short, long = CSV_SHORT[domain], CSV_LONG[domain]
    return (
        f"SELECT {', '.join(items)}, coalesce({short}, false) AS is_short,"
        f" coalesce({long}, false) AS is_long FROM {source}"
    )


def deliver_csv(spark: SparkSession, directory: str, domain: str, folder: str) -> None:
    """Write the raw view of a domain as CSV files with headers and defects of all kinds."""
    raw_view(spark, directory, domain).createOrReplaceTempView(f"raw_{domain}")
    rows = spark.sql(text_sql(domain, f"raw_{domain}"))
    names = list(columns_of(domain))
    whole, cut = F.to_csv(F.struct(*names)), F.to_csv(F.struct(*names[:-1]))
    line = F.when(F.col("is_short"), cut).when(F.col("is_long"), F.concat(whole, F.lit(",surplus"))).otherwise(whole)
    # A file is what one task writes; its first row is the one numbered zero.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    header = F.when(first, ",".join(names) + "\n").otherwise("")
    rows.select(F.concat(header, line)).write.text(folder)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def _dealt(table: DataFrame, rows: int, keys: Iterable[str]) -> DataFrame:
    """The rows of a large table in tasks of some ``TASK_ROWS``, whatever the size of splits and of shuffled blocks."""
    tasks = ceil(rows / TASK_ROWS)
    return table.repartition(tasks, *keys) if tasks > 1 else table


def raw_views(
    spark: SparkSession,
    directory: str,
    domains: Iterable[str] = tuple(SQL),
    rows: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """The named raw domains over the parquet tables of ``directory``.

    With ``rows``, as of ``most_rows``, tables that a view groups are dealt to tasks of a bounded size before.
    """
    counts = {INPUTS[domain][0]: n for domain, n in (rows or {}).items()}
    views = {}
    for domain in domains:
        for name in INPUTS[domain]:
            keys = DEALT_BY.get(domain, {}).get(name, ())
            table = _table(spark, directory, name)
            _dealt(table, counts.get(name, 0) if keys else 0, keys).createOrReplaceTempView(name)
        views[domain] = spark.sql(SQL[domain])
    return views


def most_rows(spark: SparkSession, directory: str) -> dict[str, int]:
    """The most rows that each raw domain, and so its stage, can have: those of the table it is made of."""
    counts = rows_of({tables[0]: _table(spark, directory, tables[0]) for tables in INPUTS.values()})
    return {domain: counts[tables[0]] for domain, tables in INPUTS.items()}


def raw_view(spark: SparkSession, directory: str, domain: str) -> DataFrame:
    return raw_views(spark, directory, [domain])[domain]


def sample_rules(rules: RuleBook) -> RuleBook:
    return replace(rules, as_of=AS_OF, now=NOW, batch_id=BATCH_ID)
