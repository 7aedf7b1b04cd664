"""Sales trends, categories, payments and installments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import mean, money_sum, month_of, percent, ratio, share, total
from tidemart.plans.overview import by_month, category_totals, monthly_revenue, n_rows
from tidemart.registry import plan
from tidemart.sources.star import Star


def n_orders():
    return F.count_distinct("order_id").alias("orders")


def month():
    return month_of("event_date").alias("month")


@plan
def daily_sales(s: Star) -> DataFrame:
    return s.approved.groupBy("event_date").agg(n_orders(), total("payment_value").alias("revenue")).orderBy("event_date")


@plan
def monthly_sales(s: Star) -> DataFrame:
    return s.approved.groupBy(month()).agg(n_orders(), total("payment_value").alias("revenue")).orderBy("month")


@plan
def category_revenue(s: Star) -> DataFrame:
    return (
        s.items_categorised.groupBy("category")
        .agg(n_orders(), total("price").alias("revenue"), total("freight_value").alias("freight"))
        .orderBy(F.desc("revenue"), "category")
        .limit(20)
    )


def reviewed_categories(s: Star) -> DataFrame:
    """Review sums weighted by items, per (category, item month).

    Every (review, item) pair of an order counts, so each order contributes its
    review sums times its number of items of the category.
    """
    items = s.items_categorised.groupBy("order_id", "category").agg(n_rows().alias("items"))
    joined = items.join(s.reviews_by_order, "order_id")
    weighted = [(F.col(c) * F.col("items")).alias(c) for c in ("reviews", "scored", "score_sum", "low_reviews")]
    return joined.select("category", *weighted)


@plan
def category_avg_review(s: Star) -> DataFrame:
    return (
        reviewed_categories(s)
        .groupBy("category")
        .agg(ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_score"), F.sum("reviews").alias("review_count"))
        .where("review_count >= 10")
        .orderBy(F.desc_nulls_first("avg_score"), "category")
        .limit(20)
    )


@plan
def review_by_category(s: Star) -> DataFrame:
    return (
        reviewed_categories(s)
        .groupBy("category")
        .agg(
            ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_score"),
            F.sum("reviews").alias("reviews"),
            F.sum("low_reviews").alias("low_score_count"),
            percent(F.sum("low_reviews"), F.sum("reviews")).alias("low_score_pct"),
        )
        .where("reviews >= 20")
        .orderBy(F.desc("low_score_pct"), "category")
        .limit(20)
    )


@plan
def payment_mix(s: Star) -> DataFrame:
    return (
        s.approved.groupBy("payment_type")
        .agg(
            n_rows().alias("txn_count"),
            total("payment_value").alias("total_value"),
            mean("payment_installments").alias("avg_installments"),
        )
        .orderBy(F.desc("total_value"), "payment_type")
    )


@plan
def payment_trend(s: Star) -> DataFrame:
    return (
        s.approved.groupBy(month(), "payment_type")
        .agg(total("payment_value").alias("total_value"))
        .orderBy("month", "payment_type")
    )


@plan
def payment_type_analysis(s: Star) -> DataFrame:
    return (
        s.approved.groupBy("payment_type")
        .agg(
            n_rows().alias("txn_count"),
            total("payment_value").alias("total_value"),
            mean("payment_installments").alias("avg_installments"),
        )
        .join(s.dim_payment_type, "payment_type")
        .select(
            "payment_type", "is_digital", "is_installment_supported", "txn_count", "total_value", "avg_installments"
        )
        .orderBy(F.desc("total_value"), "payment_type")
    )


@plan
def installment_distribution(s: Star) -> DataFrame:
    return (
        s.approved.groupBy("payment_installments")
        .agg(
            n_rows().alias("txn_count"),
            mean("payment_value").alias("avg_value"),
            money_sum("payment_value").alias("total_value"),
        )
        .orderBy(F.asc_nulls_last("payment_installments"))
    )


@plan
def installment_aov(s: Star) -> DataFrame:
    per_order = s.approved.groupBy("order_id").agg(
        F.max("payment_installments").alias("payment_installments"), F.sum("payment_value").alias("order_total")
    )
    return (
        per_order.groupBy("payment_installments")
        .agg(mean("order_total").alias("avg_order_value"), n_rows().alias("orders"))
        .orderBy(F.asc_nulls_last("payment_installments"))
    )


@plan
def installment_trend(s: Star) -> DataFrame:
    return (
        s.approved.groupBy(month())
        .agg(
            mean("payment_installments").alias("avg_installments"),
            share(F.col("payment_installments") > 1).alias("pct_installment_usage"),
        )
        .orderBy("month")
    )


@plan
def high_installment_impact(s: Star) -> DataFrame:
    group = B.up_to(F.col("payment_installments"), B.INSTALLMENTS, B.INSTALLMENTS_TOP)
    return (
        s.approved.groupBy(group.alias("installment_group"))
        .agg(
            n_orders(),
            mean("payment_value").alias("avg_payment"),
            money_sum("payment_value").alias("total_value"),
            F.min("payment_installments").alias("lowest"),
        )
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def price_vs_volume_by_category(s: Star) -> DataFrame:
    return (
        category_totals(s)
        .groupBy("category")
        .agg(
            ratio(F.sum("revenue"), F.sum("priced")).alias("avg_price"),
            F.sum("units").alias("units_sold"),
            money_sum("revenue").alias("total_revenue"),
        )
        .where("units_sold >= 20")
        .orderBy("avg_price", "category")
    )


@plan
def revenue_waterfall(s: Star) -> DataFrame:
    prev = F.lag("revenue").over(by_month())
    return (
        monthly_revenue(s)
        .select(
            "month",
            F.col("revenue").cast("double").alias("revenue"),
            prev.cast("double").alias("prev_revenue"),
            (F.col("revenue") - F.coalesce(prev, F.lit(0))).cast("double").alias("change"),
        )
        .orderBy("month")
    )


@plan
def revenue_growth_drivers(s: Star) -> DataFrame:
    monthly = s.created_paid.groupBy(month()).agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("order_id").alias("orders"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("revenue"),
    )
    prev = F.lag("revenue").over(by_month())
    return monthly.select(
        "month",
        "customers",
        "orders",
        F.col("revenue").cast("double").alias("revenue"),
        F.coalesce(ratio(F.col("orders"), F.col("customers")), F.lit(0.0)).alias("orders_per_customer"),
        F.coalesce(ratio(F.col("revenue"), F.col("orders")), F.lit(0.0)).alias("avg_order_value"),
        prev.cast("double").alias("prev_revenue"),
        (F.col("revenue") - F.coalesce(prev, F.lit(0))).cast("double").alias("revenue_change"),
    ).orderBy("month")
