"""Events derived from the transactional tables, and their message envelope.

Every builder returns one row per event with a typed ``payload`` struct:
event_ts, event_type, topic, order_id, customer_id, seller_id, seq, payload.
``seq`` tells several events of one order apart (payment number, item, review).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import hours_between
from tidemart.schemas import CONTRACT_VERSION, SOURCE_TABLE
from tidemart.sources.relational import Tables

SOURCE_SYSTEM = "marketplace"


def order_item_rollup(items: DataFrame) -> DataFrame:
    """Item count, value and first seller (by item number) per order."""
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        F.coalesce(F.sum("price"), F.lit(0)).cast("decimal(18,2)").alias("order_value"),
        F.min_by("seller_id", "order_item_id").alias("seller_id"),
    )


def orders_rolled(t: Tables) -> DataFrame:
    return t["orders"].join(order_item_rollup(t["items"]), "order_id", "left")


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _event(df: DataFrame, topic: str, kind: str, ts: str | Column, payload: list[Column], seq: Column | None = None):
    stamp = F.col(ts) if isinstance(ts, str) else ts
    return df.withColumn("event_ts", stamp).where("event_ts is not null").select(
        "event_ts",
        F.lit(kind).alias("event_type"),
        F.lit(topic).alias("topic"),
        "order_id",
        "customer_id",
        "seller_id",
        (F.lit("") if seq is None else seq.cast("string")).alias("seq"),
        F.struct(*payload).alias("payload"),
    )


def _basket() -> list[Column]:
    return [
        F.coalesce("order_value", F.lit(0)).cast("decimal(18,2)").alias("order_value"),
        F.coalesce("item_count", F.lit(0)).cast("int").alias("item_count"),
    ]


def order_created_events(t: Tables) -> DataFrame:
    payload = [
        F.coalesce("order_status", F.lit("created")).alias("order_status"),
        _text("order_purchase_timestamp").alias("purchase_ts"),
        _text("order_approved_at").alias("approved_ts"),
        _text("order_estimated_delivery_date").alias("estimated_delivery_ts"),
        *_basket(),
    ]
    return _event(orders_rolled(t), "order_events", "order_created", "order_purchase_timestamp", payload)


def order_approved_events(t: Tables) -> DataFrame:
    payload = [
        F.lit("approved").alias("order_status"),
        _text("order_purchase_timestamp").alias("purchase_ts"),
        _text("order_approved_at").alias("approved_ts"),
        *_basket(),
    ]
    return _event(orders_rolled(t), "order_events", "order_approved", "order_approved_at", payload)


def _order_columns(t: Tables, *extra: str) -> DataFrame:
    sellers = order_item_rollup(t["items"]).select("order_id", "seller_id")
    return t["orders"].select("order_id", "customer_id", *extra).join(sellers, "order_id", "left")


def payment_approved_events(t: Tables) -> DataFrame:
    joined = t["payments"].join(
        _order_columns(t, "order_approved_at", "order_purchase_timestamp"), "order_id", "left"
    )
    payload = [
        F.coalesce("payment_sequential", F.lit(1)).alias("payment_sequential"),
        F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"),
        "payment_installments",
        F.coalesce("payment_value", F.lit(0)).cast("decimal(18,2)").alias("payment_value"),
        F.lit("approved").alias("payment_status"),
    ]
    ts = F.coalesce("order_approved_at", "order_purchase_timestamp")
    return _event(joined, "payment_events", "payment_approved", ts, payload, F.col("payment_sequential"))


def order_shipped_events(t: Tables) -> DataFrame:
    payload = [
        F.lit("shipped").alias("carrier_status"),
        _text("order_delivered_carrier_date").alias("shipped_ts"),
        _text("order_delivered_customer_date").alias("delivered_customer_ts"),
        F.lit(None).cast("decimal(10,2)").alias("delivery_delay_hours"),
    ]
    return _event(orders_rolled(t), "delivery_events", "order_shipped", "order_delivered_carrier_date", payload)


def delay_hours(promised: str, arrived: str) -> Column:
    return F.round(hours_between(promised, arrived), 2).cast("decimal(10,2)")


def order_delivered_events(t: Tables) -> DataFrame:
    payload = [
        F.lit("delivered").alias("carrier_status"),
        _text("order_delivered_carrier_date").alias("shipped_ts"),
        _text("order_delivered_customer_date").alias("delivered_customer_ts"),
        delay_hours("order_estimated_delivery_date", "order_delivered_customer_date").alias("delivery_delay_hours"),
    ]
    return _event(orders_rolled(t), "delivery_events", "order_delivered", "order_delivered_customer_date", payload)


def review_created_events(t: Tables) -> DataFrame:
    joined = t["reviews"].join(_order_columns(t), "order_id", "left")
    payload = [
        F.coalesce("review_id", F.lit("")).alias("review_id"),
        F.coalesce("review_score", F.lit(0)).alias("review_score"),
        _text("review_creation_date").alias("review_created_ts"),
        _text("review_answer_timestamp").alias("review_answer_ts"),
        "review_comment_title",
    ]
    return _event(joined, "review_events", "review_created", "review_creation_date", payload, F.col("review_id"))


def inventory_item_added_events(t: Tables) -> DataFrame:
    """One event per order item; the item's own seller is kept."""
    joined = t["items"].join(t["orders"].select("order_id", "customer_id"), "order_id", "left")
    payload = [
        "order_item_id",
        "product_id",
        F.coalesce("price", F.lit(0)).cast("decimal(18,2)").alias("price"),
        F.coalesce("freight_value", F.lit(0)).cast("decimal(18,2)").alias("freight_value"),
        _text("shipping_limit_date").alias("shipping_limit_ts"),
    ]
    return _event(
        joined, "inventory_events", "inventory_item_added", "shipping_limit_date", payload, F.col("order_item_id")
    )


BUILDERS = (
    order_created_events,
    order_approved_events,
    payment_approved_events,
    order_shipped_events,
    order_delivered_events,
    review_created_events,
    inventory_item_added_events,
)


#: The builders whose events go to each topic.
TOPIC_BUILDERS = {
    "order_events": (order_created_events, order_approved_events),
    "payment_events": (payment_approved_events,),
    "delivery_events": (order_shipped_events, order_delivered_events),
    "review_events": (review_created_events,),
    "inventory_events": (inventory_item_added_events,),
}


def _json(col: Column | str) -> Column:
    return F.to_json(col, {"ignoreNullFields": "false"})


def event_timeline(t: Tables) -> DataFrame:
    """All events with the payload as JSON text.

    The order is left to whoever writes the timeline (a range-partitioned sort
    on event_ts there costs the same and happens once).
    """
    return reduce(DataFrame.unionByName, [b(t).withColumn("payload", _json("payload")) for b in BUILDERS])


def event_id() -> Column:
    """Identity of an event from its business fields, so that a replay repeats it."""
    return F.sha2(F.concat_ws("|", "topic", "event_type", "order_id", "seq", F.col("event_ts").cast("string")), 256)


def build_envelope(events: DataFrame, hint_ts: Column) -> DataFrame:
    """Messages (topic, key, value) with the contract's envelope around the payload."""
    table = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in SOURCE_TABLE.items() for x in kv]), F.col("topic")),
        F.lit("unknown"),
    )
    order_id = F.coalesce("order_id", F.col("event_id"))
    envelope = F.struct(
        "event_id",
        "event_type",
        F.lit(CONTRACT_VERSION).alias("schema_version"),
        F.replace(F.col("event_ts").cast("string"), F.lit(" "), F.lit("T")).alias("event_ts"),
        F.replace(hint_ts.cast("string"), F.lit(" "), F.lit("T")).alias("ingestion_hint_ts"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        table.alias("source_table"),
        F.sha2(F.concat(F.lit("trace|"), "event_id"), 256).alias("trace_id"),
        order_id.alias("order_id"),
        "customer_id",
        "seller_id",
        "payload",
    )
    return events.withColumn("event_id", event_id()).select(
        "topic", order_id.alias("key"), _json(envelope).alias("value"), "event_ts"
    )


def topic_envelopes(t: Tables, hint_ts: Column, topic: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [build_envelope(b(t), hint_ts) for b in TOPIC_BUILDERS[topic]])


def all_envelopes(t: Tables, hint_ts: Column) -> DataFrame:
    return reduce(DataFrame.unionByName, [topic_envelopes(t, hint_ts, topic) for topic in TOPIC_BUILDERS])


def as_messages(envelopes: DataFrame, ingest_ts: Column, partitions: int = 3) -> DataFrame:
    """Message-log columns as a Kafka source gives them, keyed by order.

    Offsets only have to be unique and rise within a task's output, so no task
    has to number a whole partition.
    """
    return envelopes.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        ingest_ts.cast("timestamp").alias("timestamp"),
    )
