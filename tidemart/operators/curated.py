"""Curated day-grain marts and their incremental refresh."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import mean, month_of, percent, ratio, total
from tidemart.plans.observability import stack
from tidemart.plans.overview import n_rows, orders_with_customer
from tidemart.registry import plan
from tidemart.sources.star import Star, within

SLA_HOURS = 48
RESPONSE_SLA_HOURS = 24


@plan
def mart_daily_sales(s: Star) -> DataFrame:
    """Orders, items, price and freight per order day, category and customer state."""
    # Items collapse to (order, product) before they meet the orders.
    items = s.fact_order_items.groupBy("order_id", "product_id").agg(
        n_rows().alias("items"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight")
    )
    products = s.dim_product.select(
        "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
    )
    # The state is added at order grain, before the items multiply the rows.
    orders = orders_with_customer(s, "event_date").withColumnRenamed("customer_state", "state")
    return (
        items.join(products, "product_id")
        .join(orders, "order_id")
        .groupBy("event_date", "category", "state")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("items").alias("items"),
            total("price").alias("price"),
            total("freight").alias("freight"),
        )
    )


@plan
def mart_payment_mix(s: Star) -> DataFrame:
    return s.approved.groupBy("event_date", "payment_type").agg(
        n_rows().alias("txns"),
        total("payment_value").alias("total_value"),
        mean("payment_installments").alias("avg_installments"),
    )


@plan
def mart_delivery_sla(s: Star) -> DataFrame:
    delay = F.col("delivery_delay_hours")
    return s.timed.groupBy("event_date", "seller_id").agg(
        n_rows().alias("deliveries"),
        F.count_if(delay <= 0).alias("on_time"),
        mean("delivery_delay_hours").alias("avg_delay_hours"),
        F.count_if(delay > SLA_HOURS).alias("late_beyond_sla"),
    )


@plan
def mart_order_funnel(s: Star) -> DataFrame:
    """Distinct orders that reached each stage, per day."""

    def stage(df: DataFrame, name: Column) -> DataFrame:
        return df.select("event_date", "order_id", name.alias("stage"))

    events = stack(
        [
            stage(s.fact_order_events, F.col("event_type")),
            stage(s.fact_delivery_events, F.col("event_type")),
            stage(s.fact_reviews, F.lit("order_reviewed")),
        ]
    )
    # Distinct (day, stage, order) first, then plain counts.
    once = events.distinct()
    count = lambda kind: F.count_if(F.col("stage") == kind)
    return once.groupBy("event_date").agg(
        count("order_created").alias("created"),
        count("order_approved").alias("approved"),
        count("order_shipped").alias("shipped"),
        count("order_delivered").alias("delivered"),
        count("order_reviewed").alias("reviewed"),
    )


@plan
def mart_review_quality(s: Star) -> DataFrame:
    """Scores per review day and category; a review counts once per item of its order."""
    products = s.dim_product.select(
        "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
    )
    items = (
        s.fact_order_items.groupBy("order_id", "product_id")
        .agg(n_rows().alias("k"))
        .join(products, "product_id")
        .groupBy("order_id", "category")
        .agg(F.sum("k").alias("k"))
    )
    reviews = s.fact_reviews.groupBy("order_id", "event_date").agg(
        n_rows().alias("n"),
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored"),
        F.count_if(F.col("review_score") <= 2).alias("low"),
        F.count_if(F.col("review_response_hours") <= RESPONSE_SLA_HOURS).alias("quick"),
    )
    weighted = [(F.col(c) * F.col("k")).alias(c) for c in ("n", "score", "scored", "low", "quick")]
    return (
        reviews.join(items, "order_id")
        .select("event_date", "category", *weighted)
        .groupBy("event_date", "category")
        .agg(
            F.sum("n").alias("reviews"),
            ratio(F.sum("score"), F.sum("scored")).alias("avg_score"),
            percent(F.sum("low"), F.sum("n")).alias("low_score_pct"),
            percent(F.sum("quick"), F.sum("n")).alias("answered_in_sla_pct"),
        )
    )


@plan
def mart_data_quality(s: Star) -> DataFrame:
    bad = F.col("null_violations") + F.col("duplicate_violations") + F.col("schema_violations")
    return s.fact_data_quality.groupBy("run_id", "dataset_name").agg(
        F.max("run_ts").alias("run_ts"),
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_out"),
        F.sum(bad).alias("violations"),
        F.bool_and(F.col("status") == "success").alias("passed"),
    )


@plan
def mart_category_performance(s: Star) -> DataFrame:
    """Revenue, orders and mean score per category and order month."""
    items = s.items_categorised.groupBy("order_id", "category", month_of("event_date").alias("month")).agg(
        n_rows().alias("k"), F.sum("price").alias("price")
    )
    scores = s.reviews_by_order.select("order_id", "score_sum", "scored")
    joined = items.join(scores, "order_id", "left")
    return joined.groupBy("category", "month").agg(
        total("price").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        ratio(F.sum(F.col("score_sum") * F.col("k")), F.sum(F.col("scored") * F.col("k"))).alias("avg_score"),
    )


DATED_MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "mart_daily_sales": mart_daily_sales,
    "mart_payment_mix": mart_payment_mix,
    "mart_delivery_sla": mart_delivery_sla,
    "mart_order_funnel": mart_order_funnel,
    "mart_review_quality": mart_review_quality,
}


def staging_events_clean(raw_topics: list[DataFrame]) -> DataFrame:
    """Envelopes of all topics, typed, one row per event id, without broken rows."""
    from tidemart.operators.facts import latest_by, read_order, stamp

    names = ("event_type", "schema_version", "source_system", "order_id", "customer_id", "seller_id")
    rows = stack(
        [
            raw.select("event_id", "topic", *names, stamp("event_ts").alias("event_ts"), *read_order())
            for raw in raw_topics
        ]
    )
    good = rows.where("event_id is not null and order_id is not null and event_ts is not null")
    return latest_by(good.where(F.col("schema_version").startswith("1.")), ["event_id"])


def write_mart(mart: DataFrame, path: str) -> None:
    """Store a day-grain mart by month, sorted by day inside its files."""
    (
        mart.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))
        .hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month")
        .parquet(path)
    )


#: The facts whose event_date is the day of a mart's rows; what else a mart joins is not cut to months.
DAY_OF = {
    "mart_daily_sales": ("fact_order_events",),
    "mart_payment_mix": ("fact_payments",),
    "mart_delivery_sla": ("fact_delivery_events",),
    "mart_order_funnel": ("fact_order_events", "fact_delivery_events", "fact_reviews"),
    "mart_review_quality": ("fact_reviews",),
}


def refresh_mart(star: Star, build: Callable[[Star], DataFrame], path: str, months: list[str]) -> None:
    """Replace the given months (yyyy-MM) of a stored mart as they are now, also those without rows any more.

    Only the month folders of the mart's dated fact are opened, and only the
    months' folders of the mart are replaced.  Emptied months go first, so a
    run lost on the way leaves nothing that the next one does not put right.
    """
    spark = star.spark
    cut = star.in_months(months, *DAY_OF.get(build.__name__, ()))
    fresh = f"{path.rstrip('/')}_refresh-{uuid.uuid4().hex[:12]}"
    write_mart(build(cut).where(within(months)), fresh)
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(fresh)
    filled = {r.event_month for r in rows.select("event_month").distinct().collect()}  # at most the months named
    folder = spark._jvm.org.apache.hadoop.fs.Path

    def delete(name: str) -> None:
        folder(name).getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder(name), True)

    for month in months:
        if month not in filled:
            delete(f"{path.rstrip('/')}/event_month={month}")
    write_mart(rows.drop("event_month"), path)
    delete(fresh)
