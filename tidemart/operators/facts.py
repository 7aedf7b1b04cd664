"""Typed fact and dimension rows from raw topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import hours_between
from tidemart.operators.merge import newest
from tidemart.sources.lake import ingest_ts

#: When and where a row was read; of the rows of one key the greatest wins.
ORDER = "_ingest_ts timestamp_ntz, _partition int, _offset bigint"
LATEST = ("_ingest_ts", "_partition", "_offset")


def read_order() -> list[Column]:
    return [
        ingest_ts().cast("timestamp_ntz").alias("_ingest_ts"),
        F.col("_kafka_partition").alias("_partition"),
        F.col("_kafka_offset").alias("_offset"),
    ]


def stamp(text: str) -> Column:
    """Text to a zone-less UTC timestamp, NULL when it cannot be read."""
    return F.try_to_timestamp(F.col(text)).cast("timestamp_ntz")


def latest_by(df: DataFrame, keys: list[str], order: tuple[str, ...] = LATEST) -> DataFrame:
    """The newest row of each key.

    An aggregate, not a ranking window: copies of one key collapse before the
    shuffle, so a key with a third of all rows stays cheap.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def _common(loaded_at: Column) -> list[Column]:
    return [
        stamp("event_ts").alias("event_ts"),
        stamp("event_ts").cast("date").alias("event_date"),
        F.col("source_system"),
        F.col("schema_version"),
        loaded_at.cast("timestamp_ntz").alias("ingestion_ts"),
        *read_order(),
    ]


def _newest(rows: DataFrame, keys: list[str], ordered: bool) -> DataFrame:
    """The newest row of each key, with its order columns if the rows are to be merged."""
    return newest(rows, keys, list(LATEST)) if ordered else latest_by(rows, keys)


def _fact(raw: DataFrame, loaded_at: Column, ordered: bool, *columns: Column | str) -> DataFrame:
    rows = raw.where("event_id is not null").select("event_id", "order_id", *columns, *_common(loaded_at))
    return _newest(rows, ["event_id"], ordered)


def fact_order_events(raw: DataFrame, loaded_at: Column, ordered: bool = False) -> DataFrame:
    return _fact(
        raw,
        loaded_at,
        ordered,
        "event_type",
        "customer_id",
        "seller_id",
        "payload.order_status",
        stamp("payload.purchase_ts").alias("purchase_ts"),
        stamp("payload.approved_ts").alias("approved_ts"),
        stamp("payload.estimated_delivery_ts").alias("estimated_delivery_ts"),
    )


def fact_payments(raw: DataFrame, loaded_at: Column, ordered: bool = False) -> DataFrame:
    names = ("payment_sequential", "payment_type", "payment_installments", "payment_value", "payment_status")
    return _fact(raw, loaded_at, ordered, "customer_id", *[F.col(f"payload.{n}").alias(n) for n in names])


def fact_delivery_events(raw: DataFrame, loaded_at: Column, ordered: bool = False) -> DataFrame:
    return _fact(
        raw,
        loaded_at,
        ordered,
        "event_type",
        "payload.carrier_status",
        stamp("payload.shipped_ts").alias("shipped_ts"),
        stamp("payload.delivered_customer_ts").alias("delivered_customer_ts"),
        "payload.delivery_delay_hours",
        "seller_id",
        "customer_id",
    )


def fact_reviews(raw: DataFrame, loaded_at: Column, ordered: bool = False) -> DataFrame:
    """Reviews; the response time is computed here too, not only on the bulk path."""
    made, answered = stamp("payload.review_created_ts"), stamp("payload.review_answer_ts")
    return _fact(
        raw,
        loaded_at,
        ordered,
        "payload.review_id",
        "payload.review_score",
        made.alias("review_created_ts"),
        answered.alias("review_answer_ts"),
        F.round(hours_between(made, answered), 2).cast("decimal(10,2)").alias("review_response_hours"),
        "payload.review_comment_title",
        "customer_id",
        "seller_id",
    )


def fact_order_items(raw: DataFrame, ordered: bool = False) -> DataFrame:
    """Order items; rows without a seller stay until :func:`backfill_sellers`."""
    rows = raw.select(
        "order_id",
        "payload.order_item_id",
        "payload.product_id",
        "seller_id",
        stamp("payload.shipping_limit_ts").alias("shipping_limit_date"),
        "payload.price",
        "payload.freight_value",
        stamp("event_ts").cast("date").alias("event_date"),
        *read_order(),
    ).where("order_id <> '' and product_id <> '' and order_item_id is not null")
    return _newest(rows, ["order_id", "order_item_id"], ordered)


def backfill_sellers(items: DataFrame, order_events: DataFrame) -> DataFrame:
    """Fill missing sellers from the order's events, then drop rows still without one."""
    return find_sellers(items, order_events).where("seller_id is not null")


def find_sellers(items: DataFrame, order_events: DataFrame) -> DataFrame:
    """Fill missing sellers from the order's events; where there is none, the seller is null."""
    named = items.where("seller_id <> ''")
    missing = items.where("seller_id is null or seller_id = ''").drop("seller_id")
    # Only the orders in question are looked up in the event history.
    sellers = (
        order_events.where("seller_id is not null")
        .join(missing.select("order_id").distinct(), "order_id", "left_semi")
        .groupBy("order_id")
        .agg(F.min_by("seller_id", F.struct("event_ts", "event_id")).alias("seller_id"))
    )
    return named.unionByName(missing.join(sellers, "order_id", "left").select(*items.columns))


# ---- dimensions ------------------------------------------------------------------


def _blank(names: list[str], kind: str = "string") -> list[Column]:
    return [F.lit(None).cast(kind).alias(n) for n in names]


CUSTOMER_ATTRIBUTES = ["customer_unique_id", "customer_city", "customer_state", "customer_zip_prefix"]
SELLER_ATTRIBUTES = ["seller_city", "seller_state", "seller_zip_prefix"]
PRODUCT_SIZES = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]


def _ids(raw: DataFrame, path: str, name: str) -> DataFrame:
    return raw.select(F.col(path).alias(name)).where(f"{name} <> ''").distinct()


def _enriched(from_events: DataFrame, details: DataFrame | None, key: str) -> DataFrame:
    """Known ids with side-loaded attributes; the enriched row always wins."""
    if details is None:
        return from_events
    names = [c for c in from_events.columns if c != key]
    both = details.withColumn("known", F.lit(1)).unionByName(from_events.withColumn("known", F.lit(0)))
    return latest_by(both, [key], ("known",)).select(key, *names)


def customers_from_details(details: DataFrame) -> DataFrame:
    return details.where("customer_id <> ''").select(
        "customer_id",
        "customer_unique_id",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        *_blank(["customer_zip_prefix"]),
    )


def products_from_details(details: DataFrame) -> DataFrame:
    return details.where("product_id <> ''").select(
        "product_id", F.col("product_category").alias("product_category_name"), *_blank(PRODUCT_SIZES, "int")
    )


def dim_customer(raw: DataFrame, details: DataFrame | None = None) -> DataFrame:
    events = _ids(raw, "customer_id", "customer_id").select("customer_id", *_blank(CUSTOMER_ATTRIBUTES))
    return _enriched(events, None if details is None else customers_from_details(details), "customer_id")


def dim_seller(raw: DataFrame) -> DataFrame:
    return _ids(raw, "seller_id", "seller_id").select("seller_id", *_blank(SELLER_ATTRIBUTES))


def dim_product(raw: DataFrame, details: DataFrame | None = None) -> DataFrame:
    events = _ids(raw, "payload.product_id", "product_id").select(
        "product_id", *_blank(["product_category_name"]), *_blank(PRODUCT_SIZES, "int")
    )
    return _enriched(events, None if details is None else products_from_details(details), "product_id")
