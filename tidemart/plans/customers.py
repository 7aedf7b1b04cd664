"""Customer segments, cohorts and the purchase journey."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import mean, month_gap, month_of, money_sum
from tidemart.plans.overview import n_rows
from tidemart.registry import plan
from tidemart.sources.star import Star


def spend_by_customer(s: Star) -> DataFrame:
    """Distinct orders and approved spend per customer (NULL customer is a group)."""
    return s.created_paid.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("spent"),
        F.max("event_date").alias("last_day"),
    )


@plan
def customer_rfm(s: Star) -> DataFrame:
    newest = s.created.agg(F.max("event_date").alias("d"))
    spent = F.when(F.col("customer_id").isNotNull(), F.col("spent")).otherwise(0)
    scored = spend_by_customer(s).select(
        F.date_diff(newest.scalar(), "last_day").alias("recency"), F.col("orders").alias("frequency"), spent.alias("monetary")
    )
    r, f, m = F.col("recency"), F.col("frequency"), F.col("monetary")
    segment = (
        F.when((r <= 30) & (f >= 3) & (m >= 500), "Champions")
        .when((r <= 60) & (f >= 2), "Loyal")
        .when(r <= 30, "Recent")
        .when((r <= 90) & (f >= 2), "At Risk")
        .when(r > 180, "Lost")
        .otherwise("Casual")
    )
    return (
        scored.groupBy(segment.alias("segment"))
        .agg(
            n_rows().alias("customers"),
            mean("recency").alias("avg_recency"),
            mean("frequency").alias("avg_frequency"),
            mean("monetary").alias("avg_monetary"),
        )
        .orderBy(F.desc_nulls_first("avg_monetary"))
    )


@plan
def customer_repeat_vs_onetime(s: Star) -> DataFrame:
    kind = F.when(F.col("orders") == 1, "One-time").otherwise("Repeat")
    return (
        spend_by_customer(s)
        .groupBy(kind.alias("customer_type"))
        .agg(n_rows().alias("customers"), money_sum("spent").alias("total_revenue"))
    )


@plan
def customer_clv_distribution(s: Star) -> DataFrame:
    return (
        spend_by_customer(s)
        .groupBy(B.below(F.col("spent"), B.SPEND, B.SPEND_TOP).alias("clv_bucket"))
        .agg(n_rows().alias("customers"), F.min("spent").alias("lowest"))
        .orderBy("lowest")
        .drop("lowest")
    )


def first_days(s: Star) -> DataFrame:
    return s.created.groupBy("customer_id").agg(F.min("event_date").alias("first_day"))


@plan
def customer_acquisition_trend(s: Star) -> DataFrame:
    return (
        first_days(s)
        .groupBy(month_of("first_day").alias("cohort_month"))
        .agg(n_rows().alias("new_customers"))
        .orderBy("cohort_month")
    )


@plan
def customer_cohorts(s: Star) -> DataFrame:
    # One row per (customer, month) before the window: a customer's group is
    # bounded by the number of months, however many orders they placed.
    active = (
        s.created.where("customer_id is not null")
        .select("customer_id", month_of("event_date").alias("month"))
        .distinct()
        .withColumn("cohort_month", F.min("month").over(Window.partitionBy("customer_id")))
    )
    return (
        active.withColumn("month_offset", month_gap(F.col("cohort_month"), F.col("month")))
        .where("month_offset <= 12")
        .groupBy("cohort_month", "month_offset")
        .agg(n_rows().alias("active_customers"))
        .orderBy("cohort_month", "month_offset")
    )


@plan
def cohort_revenue(s: Star) -> DataFrame:
    paid = s.approved.groupBy("order_id", month_of("event_date").alias("paid_month")).agg(
        F.sum("payment_value").alias("paid")
    )
    joined = paid.join(s.created.select("order_id", "customer_id"), "order_id").join(first_days(s), "customer_id")
    offset = month_gap(F.col("first_day"), F.col("paid_month"))
    return (
        joined.select(month_of("first_day").alias("cohort_month"), offset.alias("month_offset"), "paid", "order_id")
        .where("month_offset <= 12")
        .groupBy("cohort_month", "month_offset")
        .agg(
            F.coalesce(money_sum("paid"), F.lit(0.0)).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy("cohort_month", "month_offset")
    )


@plan
def customer_time_to_second_purchase(s: Star) -> DataFrame:
    # Orders per (customer, day) first; two orders on the first day mean 0 days.
    daily = s.created.where("customer_id is not null").groupBy("customer_id", "event_date").agg(n_rows().alias("n"))
    by_day = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("event_date"))
    first = daily.select(
        "n",
        "event_date",
        F.lead("event_date").over(by_day).alias("next_day"),
        F.lead("n").over(by_day).alias("next_n"),
        F.row_number().over(by_day).alias("rn"),
    ).where("rn = 1 and (n > 1 or next_n is not null)")
    days = F.when(F.col("n") > 1, F.date_diff("event_date", "event_date")).otherwise(
        F.date_diff("next_day", "event_date")
    )
    return (
        first.select(days.alias("days"))
        .groupBy(B.up_to(F.col("days"), B.SECOND_ORDER, B.SECOND_ORDER_TOP).alias("bucket"))
        .agg(n_rows().alias("customers"), F.min("days").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def customer_purchase_frequency(s: Star) -> DataFrame:
    return (
        spend_by_customer(s)
        .groupBy(B.up_to(F.col("orders"), B.ORDER_COUNT, B.ORDER_COUNT_TOP).alias("frequency_bucket"))
        .agg(n_rows().alias("customers"), mean("spent").alias("avg_spent"), F.min("orders").alias("lowest"))
        .orderBy("lowest")
        .drop("lowest")
    )


@plan
def customer_dormancy(s: Star) -> DataFrame:
    newest = s.fact_order_events.agg(F.max("event_date").alias("d"))
    last = s.created.groupBy("customer_id").agg(F.max("event_date").alias("last_day"))
    return (
        last.select(F.date_diff(newest.scalar(), "last_day").alias("idle"))
        .groupBy(B.up_to(F.col("idle"), B.CUSTOMER_IDLE, B.CUSTOMER_IDLE_TOP).alias("status"))
        .agg(n_rows().alias("customers"), F.min("idle").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def revenue_new_vs_repeat(s: Star) -> DataFrame:
    joined = s.created_paid.join(first_days(s), "customer_id")
    kind = F.when(F.col("event_date") == F.col("first_day"), "New").otherwise("Repeat")
    return (
        joined.groupBy(month_of("event_date").alias("month"), kind.alias("customer_type"))
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.coalesce(money_sum("paid"), F.lit(0.0)).alias("revenue"),
        )
        .orderBy("month", "customer_type")
    )
