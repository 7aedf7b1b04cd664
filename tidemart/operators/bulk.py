"""Direct load of the marts from the transactional tables, without the event path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import hours_between
from tidemart.operators.timeline import delay_hours
from tidemart.sources.projection import calendar, distinct_days
from tidemart.sources.relational import Tables

SOURCE = "bulk"


def first_rows(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest one, so that the choice does not depend on file order."""
    rest = [c for c in df.columns if c != key]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("r"))
        .select(key, *[F.col(f"r.{c}").alias(c) for c in rest])
    )


def bulk_dim_customer(t: Tables) -> DataFrame:
    return first_rows(
        t["customers"].select(
            "customer_id",
            "customer_unique_id",
            "customer_city",
            "customer_state",
            F.substring("customer_zip_code_prefix", 1, 5).alias("customer_zip_prefix"),
        ),
        "customer_id",
    )


def bulk_dim_seller(t: Tables) -> DataFrame:
    return first_rows(
        t["sellers"].select(
            "seller_id", "seller_city", "seller_state", F.substring("seller_zip_code_prefix", 1, 5).alias("seller_zip_prefix")
        ),
        "seller_id",
    )


SIZES = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


def bulk_dim_product(t: Tables) -> DataFrame:
    whole = [F.col(c).try_cast("double").cast("int").alias(c) for c in SIZES]
    return first_rows(t["products"].select("product_id", "product_category_name", *whole), "product_id")


def _tail(kind: str, seq: Column, ts: Column, loaded_at: Column) -> list[Column]:
    return [
        F.sha2(F.concat_ws("|", F.lit(SOURCE), F.lit(kind), "order_id", seq), 256).alias("event_id"),
        ts.alias("event_ts"),
        ts.cast("date").alias("event_date"),
        F.lit(SOURCE).alias("source_system"),
        F.lit("1.0").alias("schema_version"),
        loaded_at.alias("ingestion_ts"),
    ]


def bulk_fact_order_events(t: Tables, loaded_at: Column) -> DataFrame:
    """Created rows carry neither approval nor estimate here; sellers are unknown."""
    none = F.lit(None)

    def rows(kind: str, ts: str, status: Column, approved: Column) -> DataFrame:
        return t["orders"].where(F.col(ts).isNotNull()).select(
            "order_id",
            F.lit(kind).alias("event_type"),
            "customer_id",
            none.cast("string").alias("seller_id"),
            status.alias("order_status"),
            F.col("order_purchase_timestamp").alias("purchase_ts"),
            approved.cast("timestamp_ntz").alias("approved_ts"),
            none.cast("timestamp_ntz").alias("estimated_delivery_ts"),
            *_tail(kind, F.lit(""), F.col(ts), loaded_at),
        )

    created = rows("order_created", "order_purchase_timestamp", F.col("order_status"), none)
    approved = rows("order_approved", "order_approved_at", F.lit("approved"), F.col("order_approved_at"))
    return created.unionByName(approved)


def bulk_fact_payments(t: Tables, loaded_at: Column) -> DataFrame:
    orders = t["orders"].select("order_id", "customer_id", "order_approved_at", "order_purchase_timestamp")
    ts = F.coalesce("order_approved_at", "order_purchase_timestamp")
    return (
        t["payments"]
        .join(orders, "order_id", "left")
        .where(ts.isNotNull())
        .select(
            "order_id",
            F.coalesce("payment_sequential", F.lit(1)).alias("payment_sequential"),
            F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"),
            F.coalesce("payment_installments", F.lit(1)).alias("payment_installments"),
            F.coalesce("payment_value", F.lit(0)).cast("decimal(18,2)").alias("payment_value"),
            F.lit("approved").alias("payment_status"),
            "customer_id",
            *_tail("payment", F.col("payment_sequential").cast("string"), ts, loaded_at),
        )
    )


def bulk_fact_delivery_events(t: Tables, loaded_at: Column) -> DataFrame:
    """Shipped rows do not know the arrival; delivered rows carry the delay."""
    none = F.lit(None)
    shipped_ts, arrived_ts = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")

    def rows(kind: str, status: str, ts: Column, arrived: Column, delay: Column) -> DataFrame:
        return t["orders"].where(ts.isNotNull()).select(
            "order_id",
            F.lit(kind).alias("event_type"),
            F.lit(status).alias("carrier_status"),
            shipped_ts.alias("shipped_ts"),
            arrived.cast("timestamp_ntz").alias("delivered_customer_ts"),
            delay.cast("decimal(10,2)").alias("delivery_delay_hours"),
            none.cast("string").alias("seller_id"),
            "customer_id",
            *_tail(kind, F.lit(""), ts, loaded_at),
        )

    delay = delay_hours("order_estimated_delivery_date", "order_delivered_customer_date")
    return rows("order_shipped", "shipped", shipped_ts, none, none).unionByName(
        rows("order_delivered", "delivered", arrived_ts, arrived_ts, delay)
    )


def bulk_fact_reviews(t: Tables, loaded_at: Column) -> DataFrame:
    made, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    response = F.round(hours_between("review_creation_date", "review_answer_timestamp"), 2)
    return (
        t["reviews"]
        .join(t["orders"].select("order_id", "customer_id"), "order_id", "left")
        .where(made.isNotNull())
        .select(
            "review_id",
            "order_id",
            F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce("review_score", F.lit(3)))).alias("review_score"),
            made.alias("review_created_ts"),
            answered.alias("review_answer_ts"),
            response.cast("decimal(10,2)").alias("review_response_hours"),
            "review_comment_title",
            "customer_id",
            F.lit(None).cast("string").alias("seller_id"),
            *_tail("review", F.col("review_id"), made, loaded_at),
        )
    )


def bulk_fact_order_items(t: Tables) -> DataFrame:
    """Items dated by the purchase (the event path dates them by the shipping limit)."""
    orders = t["orders"].select("order_id", F.col("order_purchase_timestamp").cast("date").alias("event_date"))
    return t["items"].join(orders, "order_id", "left")


def dim_date_build(t: Tables) -> DataFrame:
    stamps = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return calendar(distinct_days(t["orders"], *stamps))


def dense_calendar(spark, first: str, last: str) -> DataFrame:
    """Every day from ``first`` to ``last``, whether or not something happened."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date")
    )
    return calendar(days)


def bulk_marts(t: Tables, loaded_at: Column) -> dict[str, DataFrame]:
    return {
        "dim_date": dim_date_build(t),
        "dim_customer": bulk_dim_customer(t),
        "dim_seller": bulk_dim_seller(t),
        "dim_product": bulk_dim_product(t),
        "fact_order_events": bulk_fact_order_events(t, loaded_at),
        "fact_payments": bulk_fact_payments(t, loaded_at),
        "fact_delivery_events": bulk_fact_delivery_events(t, loaded_at),
        "fact_reviews": bulk_fact_reviews(t, loaded_at),
        "fact_order_items": bulk_fact_order_items(t),
    }


def full_reload(t: Tables, path: str, loaded_at: Column) -> None:
    """Replace every mart; running it twice leaves the same tables."""
    for name, df in bulk_marts(t, loaded_at).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
