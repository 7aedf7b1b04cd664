"""Review scores and what they go along with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import mean, month_of, percent, ratio
from tidemart.plans.overview import n_rows
from tidemart.registry import plan
from tidemart.sources.star import Star

# Measures over joined rows that carry per-order review sums.
def score():
    return ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_score")


def n_reviews():
    return F.sum("reviews").alias("reviews")


@plan
def review_score_distribution(s: Star) -> DataFrame:
    return s.fact_reviews.groupBy("review_score").agg(n_rows().alias("cnt")).orderBy("review_score")


@plan
def review_monthly_trend(s: Star) -> DataFrame:
    return (
        s.fact_reviews.groupBy(month_of("event_date").alias("month"))
        .agg(mean("review_score").alias("avg_score"), n_rows().alias("review_count"))
        .orderBy("month")
    )


@plan
def review_response_time(s: Star) -> DataFrame:
    bucket = B.up_to(F.col("review_response_hours"), B.RESPONSE, B.RESPONSE_TOP, "No response")
    return s.fact_reviews.groupBy(bucket.alias("response_bucket")).agg(n_rows().alias("cnt"))


@plan
def corr_review_vs_delay(s: Star) -> DataFrame:
    arrived = s.delivered.select("order_id", "delivery_delay_hours")
    bucket = B.up_to(F.col("delivery_delay_hours"), B.DELAY, B.DELAY_TOP, "No delivery data")
    return (
        arrived.join(s.reviews_by_order, "order_id")
        .groupBy(bucket.alias("delay_bucket"))
        .agg(score(), n_reviews())
        .orderBy(F.desc_nulls_first("avg_score"), "delay_bucket")
    )


def reviewed_items(s: Star, measure: str, bucket: Column, name: str) -> DataFrame:
    items = s.fact_order_items.select("order_id", measure)
    return (
        items.join(s.reviews_by_order, "order_id")
        .groupBy(bucket.alias(name))
        .agg(score(), n_reviews(), F.min(measure).alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def corr_price_vs_review(s: Star) -> DataFrame:
    return reviewed_items(s, "price", B.below(F.col("price"), B.PRICE_SHORT, B.PRICE_SHORT_TOP), "price_bucket")


@plan
def corr_freight_vs_review(s: Star) -> DataFrame:
    bucket = B.below(F.col("freight_value"), B.FREIGHT_SHORT, B.FREIGHT_SHORT_TOP)
    return reviewed_items(s, "freight_value", bucket, "freight_bucket")


@plan
def corr_payment_method_vs_review(s: Star) -> DataFrame:
    paid = s.approved.groupBy("order_id", "payment_type").agg(n_rows().alias("payments"))
    weighted = [(F.col(c) * F.col("payments")).alias(c) for c in ("reviews", "scored", "score_sum")]
    return (
        paid.join(s.reviews_by_order, "order_id")
        .select("payment_type", *weighted)
        .groupBy("payment_type")
        .agg(score(), n_reviews())
        .orderBy(F.desc_nulls_first("avg_score"), "payment_type")
    )


@plan
def review_low_score_causes(s: Star) -> DataFrame:
    low = s.reviews_by_order.where("low_reviews > 0").select("order_id", "low_reviews", "low_sum")
    arrived = s.delivered.select("order_id", "delivery_delay_hours")
    items = s.fact_order_items.select("order_id", "price", "freight_value")
    delay = F.col("delivery_delay_hours")
    cause = (
        F.when(delay > 48, "Very Late Delivery (>48h)")
        .when(delay > 0, "Late Delivery")
        .when(F.col("freight_value") > 50, "High Freight (>R$50)")
        .when(F.col("price") < 20, "Low Price Item (<R$20)")
        .otherwise("Other")
    )
    return (
        low.join(arrived, "order_id")
        .join(items, "order_id")
        .groupBy(cause.alias("likely_cause"))
        .agg(F.sum("low_reviews").alias("low"), F.sum("low_sum").alias("points"))
        .select("likely_cause", F.col("low").alias("low_reviews"), ratio(F.col("points"), F.col("low")).alias("avg_score"))
        .orderBy(F.desc("low_reviews"), "likely_cause")
    )


@plan
def review_by_seller_performance(s: Star) -> DataFrame:
    arrived = s.timed.select("order_id", "seller_id", "delivery_delay_hours")
    punctual = F.when(F.col("delivery_delay_hours") <= 0, F.col("reviews")).otherwise(0)
    per_seller = (
        arrived.join(s.reviews_by_order, "order_id")
        .groupBy("seller_id")
        .agg(
            F.sum("reviews").alias("pairs"),
            percent(F.sum(punctual), F.sum("reviews")).alias("on_time_pct"),
            ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_review"),
        )
        .where("pairs >= 10")
    )
    p = F.col("on_time_pct")
    tier = (
        F.when(p >= 95, "Excellent (≥95%)")
        .when(p >= 80, "Good (80-95%)")
        .when(p >= 60, "Average (60-80%)")
        .otherwise("Poor (<60%)")
    )
    return (
        per_seller.groupBy(tier.alias("delivery_tier"))
        .agg(F.round(F.avg("avg_review"), 8).alias("avg_review_score"), n_rows().alias("sellers"))
        .orderBy(F.desc_nulls_first("avg_review_score"))
    )


@plan
def whatif_late_delivery_revenue_loss(s: Star) -> DataFrame:
    low = s.reviews_by_order.where("low_reviews > 0").select("order_id", "low_reviews")
    late = s.delivered.where("delivery_delay_hours > 0").groupBy("order_id").agg(n_rows().alias("late"))
    # One row per order on each side, so rows are orders and products are pairs.
    joined = low.join(late, "order_id").join(s.paid_by_order, "order_id")
    risk = F.sum(F.col("paid") * (F.col("low_reviews") * F.col("late")).cast("decimal(10,0)"))
    return joined.agg(
        n_rows().alias("late_low_review_orders"), F.coalesce(risk.cast("double"), F.lit(0.0)).alias("revenue_at_risk")
    )
