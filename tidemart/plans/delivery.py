"""Delivery service level, lifecycle times and estimate accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import mean, month_of, on_time_pct, percent, ratio, seconds_between
from tidemart.plans.overview import delivery_measures, n_rows, seller_deliveries, timed_by
from tidemart.registry import plan
from tidemart.sources.star import Star

DAY = 86400
SCATTER_ROWS = 2000


def month():
    return month_of("event_date").alias("month")


@plan
def delivery_sla_distribution(s: Star) -> DataFrame:
    delay = F.col("delivery_delay_hours")
    # The bucket order is that of its smallest delay; unknown delays come last.
    return (
        s.delivered.groupBy(B.up_to(delay, B.DELAY, B.DELAY_TOP, "No data").alias("sla_bucket"))
        .agg(n_rows().alias("deliveries"), F.min(delay).alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def delivery_by_state(s: Star) -> DataFrame:
    customers = s.dim_customer.select("customer_id", F.col("customer_state").alias("state"))
    return (
        timed_by(s, "customer_id")
        .join(customers, "customer_id")
        .groupBy("state")
        .agg(*delivery_measures())
        .where("deliveries >= 10")
        .orderBy(F.desc_nulls_first("avg_delay_hours"), "state")
    )


@plan
def delivery_monthly_trend(s: Star) -> DataFrame:
    return (
        s.timed.groupBy(month())
        .agg(mean("delivery_delay_hours").alias("avg_delay_hours"), on_time_pct().alias("on_time_pct"))
        .orderBy("month")
    )


@plan
def seller_delivery_performance(s: Star) -> DataFrame:
    return seller_deliveries(s).where("deliveries >= 5").orderBy("on_time_pct", "seller_id").limit(20)


@plan
def delivery_by_route(s: Star) -> DataFrame:
    sellers = s.dim_seller.select("seller_id", F.col("seller_state").alias("origin_state"))
    customers = s.dim_customer.select("customer_id", F.col("customer_state").alias("dest_state"))
    # Seller first: after that join the rows collapse to (origin, customer).
    by_origin = (
        timed_by(s, "seller_id", "customer_id")
        .join(sellers, "seller_id")
        .groupBy("origin_state", "customer_id")
        .agg(*[F.sum(c).alias(c) for c in ("n", "delay", "punctual")])
    )
    return (
        by_origin.join(customers, "customer_id")
        .groupBy("origin_state", "dest_state")
        .agg(*delivery_measures())
        .where("deliveries >= 10")
        .orderBy(F.desc("deliveries"), "origin_state", "dest_state")
        .limit(30)
    )


def delivered_orders(s: Star) -> DataFrame:
    """Deliveries with the timestamps of the order's creation."""
    made = s.created.select(
        "order_id", "purchase_ts", "approved_ts", F.col("estimated_delivery_ts").alias("promised_ts")
    )
    arrived = s.delivered.where("delivered_customer_ts is not null").select(
        "event_id", "order_id", "event_date", "seller_id", "shipped_ts", F.col("delivered_customer_ts").alias("arrived_ts")
    )
    return arrived.join(made, "order_id")


def mean_gap(start: str, end: str, unit: int):
    """Mean duration in units of ``unit`` seconds, from an exact sum of seconds."""
    return mean(seconds_between(start, end)) / unit


@plan
def order_lifecycle_times(s: Star) -> DataFrame:
    return (
        delivered_orders(s)
        .where("approved_ts is not null and shipped_ts is not null")
        .agg(
            mean_gap("purchase_ts", "approved_ts", 3600).alias("avg_approval_hours"),
            mean_gap("approved_ts", "shipped_ts", 3600).alias("avg_ship_hours"),
            mean_gap("shipped_ts", "arrived_ts", 3600).alias("avg_transit_hours"),
            mean_gap("purchase_ts", "arrived_ts", DAY).alias("avg_total_days"),
        )
    )


@plan
def order_lead_time_distribution(s: Star) -> DataFrame:
    # Edges are whole days, so comparing seconds with edge * 86400 is exact.
    lead = seconds_between("purchase_ts", "arrived_ts")
    steps = [(days * DAY, label) for days, label in B.LEAD]
    return (
        delivered_orders(s)
        .select(lead.alias("lead"))
        .where("lead > 0")
        .groupBy(B.up_to(F.col("lead"), steps, B.LEAD_TOP).alias("lead_bucket"))
        .agg(n_rows().alias("orders"), F.min("lead").alias("lowest"))
        .orderBy("lowest")
        .drop("lowest")
    )


def met_estimate():
    return percent(F.count_if(F.col("arrived_ts") <= F.col("promised_ts")), n_rows()).alias("met_estimate_pct")


def diff_days():
    return mean_gap("promised_ts", "arrived_ts", DAY).alias("avg_diff_days")


@plan
def estimated_vs_actual_delivery(s: Star) -> DataFrame:
    return (
        delivered_orders(s)
        .where("promised_ts is not null")
        .groupBy(month())
        .agg(diff_days(), met_estimate(), n_rows().alias("deliveries"))
        .orderBy("month")
    )


@plan
def delivery_estimation_by_seller_state(s: Star) -> DataFrame:
    sellers = s.dim_seller.select("seller_id", "seller_state")
    per_seller = (
        delivered_orders(s)
        .where("promised_ts is not null")
        .groupBy("seller_id")
        .agg(
            n_rows().alias("n"),
            F.sum(seconds_between("promised_ts", "arrived_ts")).alias("late"),
            F.count_if(F.col("arrived_ts") <= F.col("promised_ts")).alias("met"),
        )
    )
    return (
        per_seller.join(sellers, "seller_id")
        .groupBy("seller_state")
        .agg(
            F.sum("n").alias("deliveries"),
            (ratio(F.sum("late"), F.sum("n")) / DAY).alias("avg_diff_days"),
            percent(F.sum("met"), F.sum("n")).alias("met_estimate_pct"),
        )
        .where("deliveries >= 20")
        .orderBy(F.desc_nulls_first("avg_diff_days"), "seller_state")
    )


@plan
def delivery_over_under_promise(s: Star) -> DataFrame:
    """Estimate minus arrival; label text as published, although a negative
    difference means the parcel came late."""
    gap = F.col("gap")
    label = (
        F.when(gap < -7 * DAY, "Over-promised 7+ days")
        .when(gap < -3 * DAY, "Over-promised 3-7 days")
        .when(gap < 0, "Over-promised 1-3 days")
        .when(gap == 0, "Exact")
        .when(gap <= 3 * DAY, "Under-promised 1-3 days")
        .when(gap <= 7 * DAY, "Under-promised 3-7 days")
        .otherwise("Under-promised 7+ days")
    )
    return (
        delivered_orders(s)
        .where("promised_ts is not null")
        .select(seconds_between("arrived_ts", "promised_ts").alias("gap"))
        .groupBy(label.alias("promise_bucket"))
        .agg(n_rows().alias("deliveries"), F.min("gap").alias("lowest"))
        .orderBy("lowest")
        .drop("lowest")
    )


def estimation_points(s: Star) -> DataFrame:
    return (
        delivered_orders(s)
        .where("promised_ts is not null and purchase_ts is not null")
        .select(
            "event_id",
            (seconds_between("purchase_ts", "promised_ts").cast("double") / DAY).alias("estimated_days"),
            (seconds_between("purchase_ts", "arrived_ts").cast("double") / DAY).alias("actual_days"),
        )
    )


@plan
def delivery_estimation_scatter(s: Star) -> DataFrame:
    """A sample of 2000 points; seeded, so that a rerun on the same files agrees."""
    return (
        estimation_points(s).orderBy(F.rand(42)).limit(SCATTER_ROWS).select("estimated_days", "actual_days")
    )


@plan
def delivery_estimation_scatter_hashed(s: Star) -> DataFrame:
    """The same sample chosen by a hash of the event id, equal on every engine."""
    return (
        estimation_points(s)
        .orderBy(F.md5(F.col("event_id").cast("binary")), "event_id")
        .limit(SCATTER_ROWS)
        .select("estimated_days", "actual_days")
    )


@plan
def order_status_breakdown(s: Star) -> DataFrame:
    return (
        s.fact_order_events.groupBy("order_status")
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy(F.desc("orders"), "order_status")
    )


@plan
def cancellation_rate_trend(s: Star) -> DataFrame:
    # One row per (month, order) first: both distinct counts become plain counts.
    per_order = s.fact_order_events.groupBy(month(), "order_id").agg(
        F.coalesce(F.bool_or(F.col("order_status") == "canceled"), F.lit(False)).alias("was_canceled")
    )
    gone = F.count_if("was_canceled")
    return (
        per_order.groupBy("month")
        .agg(
            F.count("order_id").alias("total_orders"),
            gone.alias("cancelled"),
            percent(gone, F.count("order_id")).alias("cancel_pct"),
        )
        .orderBy("month")
    )
