"""Column contracts of the raw files."""

from __future__ import annotations

ORDERS = """
    order_id STRING, customer_id STRING, product_id STRING, order_date DATE,
    order_amount DECIMAL(10,2), currency STRING, payment_method STRING,
    shipping_address STRING, order_status STRING, created_timestamp TIMESTAMP
"""

CUSTOMERS = """
    customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING,
    date_of_birth DATE, registration_date DATE, address STRING, city STRING, state STRING,
    zip_code STRING, country STRING, customer_tier STRING, last_login TIMESTAMP,
    created_timestamp TIMESTAMP
"""

PRODUCTS = """
    product_id STRING, product_name STRING, category STRING, subcategory STRING, brand STRING,
    price DECIMAL(10,2), currency STRING, stock_quantity INT, weight_kg DECIMAL(8,2),
    dimensions_cm STRING, color STRING, material STRING, description STRING, launch_date DATE,
    discontinued BOOLEAN, created_timestamp TIMESTAMP
"""

INVENTORY = """
    inventory_id STRING, product_id STRING, warehouse_id STRING, warehouse_name STRING,
    location STRING, stock_quantity INT, reserved_quantity INT, available_quantity INT,
    reorder_level INT, last_restocked DATE, last_audit DATE, created_timestamp TIMESTAMP
"""

SHIPPING = """
    shipping_id STRING, order_id STRING, tracking_number STRING, carrier STRING,
    service_type STRING, origin_warehouse STRING, destination_address STRING,
    shipping_cost DECIMAL(10,2), currency STRING, estimated_delivery DATE,
    actual_delivery DATE, shipping_status STRING, package_weight DECIMAL(8,2),
    package_dimensions STRING, insurance_value DECIMAL(10,2), created_timestamp TIMESTAMP
"""

RAW = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "shipping": SHIPPING,
}

DOMAINS = tuple(RAW)

