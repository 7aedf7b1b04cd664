"""Seller ranking, concentration, specialisation, churn and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import month_of, percent, ratio, total
from tidemart.plans.overview import n_rows
from tidemart.registry import plan
from tidemart.sources.star import Star

TOP_SELLERS = 50


@plan
def top_sellers_by_revenue(s: Star) -> DataFrame:
    per_seller = s.fact_order_items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"), total("price").alias("revenue")
    )
    sellers = s.dim_seller.select("seller_id", "seller_city", "seller_state")
    return (
        per_seller.join(sellers, "seller_id")
        .select("seller_id", "seller_city", "seller_state", "orders", "revenue")
        .orderBy(F.desc("revenue"), "seller_id")
        .limit(20)
    )


@plan
def seller_concentration(s: Star) -> DataFrame:
    """Pareto list of the 50 largest sellers.

    Sellers with equal revenue share one cumulative value.  The running sum
    needs only the 50 largest distinct revenues, never all sellers in one task.
    """
    sellers = s.fact_order_items.groupBy("seller_id").agg(
        F.coalesce(F.sum("price"), F.lit(0)).cast("decimal(28,2)").alias("revenue")
    )
    whole = sellers.agg(F.sum("revenue").alias("all_revenue"), n_rows().alias("all_sellers"))
    steps = (
        sellers.groupBy("revenue")
        .agg(F.sum("revenue").alias("step"))
        .orderBy(F.desc("revenue"))
        .limit(TOP_SELLERS)
        .withColumn("cumulative", F.sum("step").over(Window.orderBy(F.desc("revenue"))))
        .select("revenue", "cumulative")
    )
    top = (
        sellers.orderBy(F.desc("revenue"), "seller_id")
        .limit(TOP_SELLERS)
        .withColumn("seller_rank", F.row_number().over(Window.orderBy(F.desc("revenue"), "seller_id")).cast("bigint"))
    )
    return (
        top.join(F.broadcast(steps), "revenue")
        .select(
            "seller_rank",
            "seller_id",
            F.col("revenue").cast("double").alias("revenue"),
            percent(F.col("cumulative"), whole.select("all_revenue").scalar()).alias("cumulative_pct"),
            percent(F.col("seller_rank"), whole.select("all_sellers").scalar()).alias("seller_pct"),
        )
        .orderBy("seller_rank")
    )


@plan
def seller_category_specialization(s: Star) -> DataFrame:
    """The leading category of each seller with at least 1000 in sales.

    Sellers whose leading category is unknown are left out, ties go to the
    first category by name.
    """
    products = s.dim_product.select("product_id", F.col("product_category_name").alias("category"))
    by_product = s.fact_order_items.groupBy("seller_id", "product_id").agg(F.sum("price").alias("revenue"))
    by_category = (
        by_product.join(products, "product_id").groupBy("seller_id", "category").agg(F.sum("revenue").alias("revenue"))
    )
    # The leading category is a minimum over (-revenue, name): an aggregate that
    # combines early, where a ranking window would sort each seller's rows.
    order = F.struct((-F.col("revenue")).alias("neg"), F.col("category").isNull().alias("unnamed"), "category")
    return (
        by_category.groupBy("seller_id")
        .agg(F.sum("revenue").alias("total"), F.min(order).alias("best"))
        .where("total >= 1000 and best.category is not null")
        .join(s.dim_seller.select("seller_id", "seller_state"), "seller_id")
        .select(
            "seller_id",
            "seller_state",
            F.col("best.category").alias("primary_category"),
            (-F.col("best.neg")).cast("double").alias("cat_revenue"),
            F.col("total").cast("double").alias("total_revenue"),
            percent(-F.col("best.neg"), F.col("total")).alias("specialization_pct"),
        )
        .orderBy(F.desc_nulls_first("specialization_pct"), "seller_id")
        .limit(30)
    )


@plan
def seller_rating_vs_delivery(s: Star) -> DataFrame:
    arrived = s.timed.select("order_id", "seller_id", "delivery_delay_hours")
    sellers = s.dim_seller.select("seller_id", "seller_state")
    pairs = arrived.join(s.reviews_by_order, "order_id")
    per_seller = pairs.groupBy("seller_id").agg(
        ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_rating"),
        ratio(F.sum(F.col("delivery_delay_hours") * F.col("reviews").cast("decimal(10,0)")), F.sum("reviews")).alias(
            "avg_delay_hours"
        ),
        F.count_distinct("order_id").alias("deliveries"),
    )
    return (
        per_seller.where("deliveries >= 10")
        .join(sellers, "seller_id")
        .select("seller_id", "seller_state", "avg_rating", "avg_delay_hours", "deliveries")
        .orderBy(F.desc_nulls_first("avg_rating"), "seller_id")
        .limit(50)
    )


@plan
def seller_onboarding_trend(s: Star) -> DataFrame:
    first = s.fact_order_items.groupBy("seller_id").agg(F.min("event_date").alias("first_sale"))
    return (
        first.groupBy(month_of("first_sale").alias("onboard_month"))
        .agg(n_rows().alias("new_sellers"))
        .orderBy("onboard_month")
    )


@plan
def seller_inactive(s: Star) -> DataFrame:
    last = s.fact_order_items.groupBy("seller_id").agg(F.max("event_date").alias("last_sale"))
    newest = last.agg(F.max("last_sale").alias("d"))
    return (
        last.select(F.date_diff(newest.scalar(), "last_sale").alias("idle"))
        .groupBy(B.up_to(F.col("idle"), B.SELLER_IDLE, B.SELLER_IDLE_TOP).alias("status"))
        .agg(n_rows().alias("sellers"), F.min("idle").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


def last_month_change(s: Star) -> DataFrame:
    """Each seller's last active month against the active month before it."""
    months = s.fact_order_items.groupBy("seller_id", month_of("event_date").alias("month")).agg(
        F.sum("price").alias("revenue")
    )
    newest_first = Window.partitionBy("seller_id").orderBy(F.desc_nulls_first("month"))
    prev = F.col("prev")
    return (
        months.withColumn("prev", F.lead("revenue").over(newest_first))
        .withColumn("rn", F.row_number().over(newest_first))
        .where("rn = 1 and prev is not null")
        .select(
            "seller_id",
            "month",
            F.col("revenue").cast("double").alias("current_revenue"),
            prev.cast("double").alias("prev_revenue"),
            F.when(prev > 0, percent(F.col("revenue") - prev, prev)).alias("growth_pct"),
        )
    )


@plan
def seller_revenue_growth(s: Star) -> DataFrame:
    return last_month_change(s).orderBy(F.desc_nulls_first("growth_pct"), "seller_id").limit(20)


@plan
def seller_revenue_decline(s: Star) -> DataFrame:
    return last_month_change(s).orderBy(F.asc_nulls_last("growth_pct"), "seller_id").limit(20)
