"""Schemas, keys and vocabularies of the event contract and the star schema."""

from __future__ import annotations

# ---- fixed values: vocabularies and seeds ---------------------------------
PAYMENT_TYPE_SEED = [
    ("credit_card", True, True),
    ("debit_card", True, False),
    ("voucher", True, False),
    ("boleto", False, False),
]
EVENT_TYPE_SEED = [
    ("order_created", "order", False),
    ("order_approved", "order", False),
    ("order_canceled", "order", True),
    ("order_delivered", "delivery", True),
    ("payment_approved", "payment", False),
    ("payment_failed", "payment", True),
    ("review_submitted", "review", True),
]
TOPICS = ("order_events", "payment_events", "delivery_events", "review_events", "inventory_events")
# One enum per topic: the types the producers emit plus the two contract-only ones.
TOPIC_EVENT_TYPES = {
    "order_events": ("order_created", "order_approved", "order_canceled"),
    "payment_events": ("payment_approved", "payment_failed"),
    "delivery_events": ("order_shipped", "order_delivered"),
    "review_events": ("review_created",),
    "inventory_events": ("inventory_item_added",),
}
SOURCE_TABLE = {
    "order_events": "orders",
    "payment_events": "order_payments",
    "delivery_events": "orders",
    "review_events": "order_reviews",
    "inventory_events": "order_items",
}
REQUIRED_FIELDS = ("event_id", "event_type", "schema_version", "event_ts", "source_system", "order_id", "payload")
OPTIONAL_FIELDS = ("ingestion_hint_ts", "source_table", "trace_id", "customer_id", "seller_id")
REQUIRED_METADATA = ("_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_ingest_ts", "_contract_version")
ISO_8601 = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"
CONTRACT_VERSION = "1.0"
# ---------------------------------------------------------------------------

PAYLOAD_FIELDS = {
    "order_events": "order_status string, purchase_ts string, approved_ts string, "
    "estimated_delivery_ts string, order_value double, item_count int",
    "payment_events": "payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(18,2), payment_status string",
    "delivery_events": "carrier_status string, shipped_ts string, delivered_customer_ts string, "
    "delivery_delay_hours decimal(10,2)",
    "review_events": "review_id string, review_score int, review_created_ts string, "
    "review_answer_ts string, review_comment_title string",
    "inventory_events": "order_item_id int, product_id string, price decimal(18,2), "
    "freight_value decimal(18,2), shipping_limit_ts string",
}

ENVELOPE = (
    "event_id string, event_type string, schema_version string, event_ts string, ingestion_hint_ts string, "
    "source_system string, source_table string, trace_id string, order_id string, customer_id string, "
    "seller_id string"
)

METADATA = (
    "_kafka_topic string, _kafka_partition int, _kafka_offset bigint, _kafka_key string, "
    "_kafka_ingest_ts string, _raw_file_ts string, _contract_version string"
)

# Business keys of every merged table.
KEYS = {
    "dim_customer": ["customer_id"],
    "dim_seller": ["seller_id"],
    "dim_product": ["product_id"],
    "fact_order_events": ["event_id"],
    "fact_payments": ["event_id"],
    "fact_delivery_events": ["event_id"],
    "fact_reviews": ["event_id"],
    "fact_order_items": ["order_id", "order_item_id"],
}

# Source tables as the loader reads them.
RELATIONAL = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price decimal(18,2), freight_value decimal(18,2)",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(18,2)",
    "reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "products": "product_id string, product_category_name string, product_name_lenght string, "
    "product_description_lenght string, product_photos_qty string, product_weight_g string, "
    "product_length_cm string, product_height_cm string, product_width_cm string",
    "translation": "product_category_name string, product_category_name_english string",
}
