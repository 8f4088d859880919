"""Declared schemas and the fixed domain values of the shipment model."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
VALID_STATUSES = [
    "ORDER_PLACED",
    "PROCESSING",
    "SHIPPED",
    "IN_TRANSIT",
    "OUT_FOR_DELIVERY",
    "DELIVERED",
    "DELAYED",
]
# weight_category: below 1 LIGHT, below 10 MEDIUM, below 25 HEAVY, else EXTRA_HEAVY
WEIGHT_BANDS = [(1, "LIGHT"), (10, "MEDIUM"), (25, "HEAVY")]
WEIGHT_TOP_BAND = "EXTRA_HEAVY"
DELAYED = "DELAYED"
DELIVERED = "DELIVERED"
IN_TRANSIT = "IN_TRANSIT"
PASS = "PASS"
FAIL = "FAIL"
MIN_ROW_COUNT = 50
# KPI card colour band on the average delay rate: above 20 red, above 10 amber
KPI_BAND_RED_ABOVE = 20
KPI_BAND_AMBER_ABOVE = 10
ROUTE_SEPARATOR = " → "
BRONZE_BATCH_SIZE = 10
# The text report: headings, and the line templates of each section.
REPORT_SECTIONS = [
    "CARRIER PERFORMANCE DATA",
    "SHIPMENT STATUS SUMMARY",
    "TOP DELAYED ROUTES",
    "PRODUCT SUMMARY",
]
REPORT_CARRIER_LINES = [
    "Carrier: %s",
    "- Total Shipments: %s",
    "- Delayed: %s",
    "- Delivered: %s",
    "- Delay Rate: %s%%",
    "- Avg Weight: %s kg",
]
REPORT_STATUS_LINE = "Status %s: %s shipments"
REPORT_ROUTE_LINE = "%s%s%s: %s%% delay rate"
REPORT_PRODUCT_LINE = "%s: %s shipments, %s%% delay rate"
# Check names of the silver checks, in the reference's order.
CHECK_MIN_ROWS = "Minimum row count >= 50"
CHECK_NULLS = "No nulls in {}"
CHECK_STATUS = "All status values are valid"
CHECK_WEIGHT = "All weights are positive"
CHECK_DUPLICATES = "No duplicate shipment IDs"
CHECK_DQ_FLAG = "All DQ flags are PASS"
NULL_CHECK_COLUMNS = ["carrier", "status", "origin", "destination"]
# ---------------------------------------------------------------------------

# Defaults of this library: events per landed file, messages per micro-batch.
FILE_RECORDS = 1_000_000
MESSAGES_PER_TRIGGER = 5_000_000
FILES_PER_TRIGGER = 1_000
# Sort columns of a report line (k1 descending with nulls last).
REPORT_ORDER = ["section_no", "k1", "k2", "k3", "sub"]

# One bronze shipment event (13 flat fields). Timestamps stay ISO-8601 text,
# as they arrive; typed copies are derived with try_to_timestamp.
SHIPMENT = StructType(
    [
        StructField("shipment_id", LongType()),
        StructField("order_id", LongType()),
        StructField("product", StringType()),
        StructField("carrier", StringType()),
        StructField("tracking_number", StringType()),
        StructField("status", StringType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("quantity", LongType()),
        StructField("weight_kg", DoubleType()),
        StructField("shipped_at", StringType()),
        StructField("delivered_at", StringType()),
        StructField("event_timestamp", StringType()),
    ]
)
SHIPMENT_COLUMNS = [f.name for f in SHIPMENT.fields]

CORRUPT_RECORD = "_corrupt_record"
# Bronze reader schema: malformed records land in _corrupt_record instead of
# silently changing the inferred schema.
SHIPMENT_WITH_CORRUPT = StructType(SHIPMENT.fields + [StructField(CORRUPT_RECORD, StringType())])

VALIDATION_COLUMNS = ["is_valid_status", "is_valid_weight", "has_origin", "has_destination", "dq_flag"]
BUSINESS_COLUMNS = ["weight_category", "is_delayed", "is_delivered"]
SILVER_COLUMNS = SHIPMENT_COLUMNS + VALIDATION_COLUMNS + ["processed_at"] + BUSINESS_COLUMNS

# Operational (OLTP) tables, typed as declared by the source database DDL.
SUPPLIERS = StructType(
    [
        StructField("supplier_id", IntegerType(), False),
        StructField("supplier_name", StringType(), False),
        StructField("country", StringType()),
        StructField("region", StringType()),
        StructField("contact_email", StringType()),
        StructField("rating", DecimalType(3, 2)),
        StructField("is_active", BooleanType()),
        StructField("created_at", TimestampType()),
    ]
)
PRODUCTS = StructType(
    [
        StructField("product_id", IntegerType(), False),
        StructField("product_name", StringType(), False),
        StructField("category", StringType()),
        StructField("unit_price", DecimalType(10, 2)),
        StructField("supplier_id", IntegerType()),
        StructField("created_at", TimestampType()),
    ]
)
INVENTORY = StructType(
    [
        StructField("inventory_id", IntegerType(), False),
        StructField("product_id", IntegerType()),
        StructField("warehouse_id", StringType()),
        StructField("quantity", IntegerType(), False),
        StructField("reorder_level", IntegerType()),
        StructField("last_updated", TimestampType()),
    ]
)
ORDERS = StructType(
    [
        StructField("order_id", IntegerType(), False),
        StructField("product_id", IntegerType()),
        StructField("supplier_id", IntegerType()),
        StructField("quantity", IntegerType(), False),
        StructField("order_status", StringType()),
        StructField("order_date", TimestampType()),
        StructField("expected_delivery", DateType()),
        StructField("actual_delivery", DateType()),
    ]
)
SHIPMENTS = StructType(
    [
        StructField("shipment_id", IntegerType(), False),
        StructField("order_id", IntegerType()),
        StructField("carrier", StringType()),
        StructField("tracking_number", StringType()),
        StructField("status", StringType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("shipped_at", TimestampType()),
        StructField("delivered_at", TimestampType()),
    ]
)
OPERATIONAL_SCHEMAS = {
    "suppliers": SUPPLIERS,
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "orders": ORDERS,
    "shipments": SHIPMENTS,
}

# Constraints of the operational DDL, as data. Fixed values from the DDL.
PRIMARY_KEYS = {
    "suppliers": "supplier_id",
    "products": "product_id",
    "inventory": "inventory_id",
    "orders": "order_id",
    "shipments": "shipment_id",
}
NOT_NULL = [
    ("suppliers", "supplier_name"),
    ("products", "product_name"),
    ("inventory", "quantity"),
    ("orders", "quantity"),
]
# (child table, child column, parent table, parent key)
FOREIGN_KEYS = [
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("orders", "product_id", "products", "product_id"),
    ("orders", "supplier_id", "suppliers", "supplier_id"),
    ("shipments", "order_id", "orders", "order_id"),
]
VARCHAR_LIMITS = [
    ("suppliers", "supplier_name", 100),
    ("suppliers", "country", 50),
    ("suppliers", "region", 50),
    ("suppliers", "contact_email", 100),
    ("products", "product_name", 100),
    ("products", "category", 50),
    ("inventory", "warehouse_id", 20),
    ("orders", "order_status", 20),
    ("shipments", "carrier", 50),
    ("shipments", "tracking_number", 100),
    ("shipments", "status", 20),
    ("shipments", "origin", 100),
    ("shipments", "destination", 100),
]
# (table, column, precision, scale)
DECIMAL_COLUMNS = [
    ("suppliers", "rating", 3, 2),
    ("products", "unit_price", 10, 2),
]
# Column defaults; the value "now" means the run's timestamp.
DEFAULTS = {
    "suppliers": {"is_active": True, "created_at": "now"},
    "products": {"created_at": "now"},
    "inventory": {"reorder_level": 100, "last_updated": "now"},
    "orders": {"order_status": "PENDING", "order_date": "now"},
    "shipments": {"status": "IN_TRANSIT", "shipped_at": "now"},
}
