"""The order-event contract: field names, types and reference values."""

from __future__ import annotations

# The event payload, one JSON object per order item.
EVENT_DDL = """
    order_id STRING,
    customer_id STRING,
    product_id STRING,
    product_category STRING,
    seller_id STRING,
    quantity INT,
    unit_price DOUBLE,
    freight_value DOUBLE,
    total_price DOUBLE,
    order_status STRING,
    customer_state STRING,
    customer_city STRING,
    payment_type STRING,
    payment_value DOUBLE,
    event_time STRING,
    order_delivered_ts STRING,
    order_estimated_ts STRING,
    processing_time STRING
"""

# The statuses an event may carry.
STATUSES = ["created", "confirmed", "shipped", "delivered", "cancelled"]

# The 27 federative units a customer may live in.
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]

# Shop status on the left, contract status on the right.
RAW_STATUS_TO_STATUS = {
    "created": "created",
    "approved": "confirmed",
    "invoiced": "confirmed",
    "processing": "confirmed",
    "shipped": "shipped",
    "delivered": "delivered",
    "unavailable": "cancelled",
    "canceled": "cancelled",
}

# Time formats on the wire.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PROCESSING_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DELIVERY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Message envelope as a Kafka source delivers it.
ENVELOPE_DDL = """
    key BINARY, value BINARY, topic STRING,
    partition INT, offset BIGINT, timestamp TIMESTAMP
"""

EVENT_FIELDS = [line.split()[0] for line in EVENT_DDL.strip().splitlines()]
PARSED_TIMES = ["event_ts", "processing_ts"]
QC_FLAGS = [
    "qc_has_order_id", "qc_valid_status", "qc_valid_state",
    "qc_positive_qty", "qc_positive_price", "qc_has_event_time",
]

# Column sets of the layers.
SILVER_COLUMNS = EVENT_FIELDS + PARSED_TIMES + ["kafka_ts", "ingestion_ts"]
BRONZE_COLUMNS = SILVER_COLUMNS + [
    "kafka_partition", "kafka_offset", "msg_key", "json_str", "is_valid",
]
QUARANTINE_COLUMNS = BRONZE_COLUMNS + QC_FLAGS

# What the two console views show.
CONSOLE_VALID_COLUMNS = [
    "order_id", "customer_id", "product_id", "product_category", "quantity",
    "total_price", "order_status", "customer_state", "payment_type", "event_ts",
]
CONSOLE_QUARANTINE_COLUMNS = ["order_id", "json_str"] + QC_FLAGS

# Batch metrics as they lie in the JSON files: both generations of writers
# store every field as text, and name the silver count differently.
METRICS_FIELDS = [
    "batch_id", "timestamp", "pipeline_version",
    "total_records", "valid_records", "quarantine_records",
    "silver_records", "silver_upserted", "duplicates_removed",
    "valid_pct", "quarantine_pct", "dedup_pct", "batch_duration_sec",
    "cumulative_total", "cumulative_valid", "cumulative_quarantine",
    "cumulative_silver", "cumulative_dedup", "cumulative_batches",
]
METRICS_DDL = ", ".join(f"{name} STRING" for name in METRICS_FIELDS)

# Olist CSV inputs of the replay producer: the columns that are read.
SHOP_TABLES = {
    "orders": """order_id STRING, customer_id STRING, order_status STRING,
        order_purchase_timestamp STRING, order_approved_at STRING,
        order_delivered_carrier_date STRING, order_delivered_customer_date STRING,
        order_estimated_delivery_date STRING""",
    "items": """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date STRING, price DOUBLE, freight_value DOUBLE""",
    "payments": """order_id STRING, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE""",
    "customers": """customer_id STRING, customer_unique_id STRING,
        customer_zip_code_prefix STRING, customer_city STRING, customer_state STRING""",
    "products": """product_id STRING, product_category_name STRING,
        product_name_lenght STRING, product_description_lenght STRING,
        product_photos_qty STRING, product_weight_g STRING, product_length_cm STRING,
        product_height_cm STRING, product_width_cm STRING""",
}

# Layers are written once and kept: a third smaller than with the default codec.
COMPRESSION = "zstd"

# Messages, and layers that hold their texts, are most of what a load writes: a higher level and pages
# of 8 MB make them another sixth smaller.
TEXT_FILES = {
    "compression": COMPRESSION,
    "parquet.compression.codec.zstd.level": 6,
    "parquet.page.size": 8 * 1024 * 1024,
}

DEFAULT_DATABASE = "millrace"
DEFAULT_TOPIC = "orders"
