"""Headline figures and the overview lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import mean, month_of, on_time_pct, percent, ratio, total
from tidemart.registry import plan
from tidemart.sources.star import Star


def n_rows():
    return F.count(F.lit(1))


@plan
def kpi_total_orders(s: Star) -> DataFrame:
    return s.created.agg(F.count_distinct("order_id").alias("total_orders"))


@plan
def kpi_total_revenue(s: Star) -> DataFrame:
    return s.approved.agg(total("payment_value").alias("total_revenue"))


@plan
def kpi_avg_order_value(s: Star) -> DataFrame:
    return s.paid_by_order.agg(F.coalesce(mean("paid"), F.lit(0.0)).alias("avg_order_value"))


@plan
def kpi_total_customers(s: Star) -> DataFrame:
    return s.dim_customer.agg(n_rows().alias("total_customers"))


@plan
def kpi_avg_review_score(s: Star) -> DataFrame:
    return s.fact_reviews.agg(F.coalesce(mean("review_score"), F.lit(0.0)).alias("avg_review_score"))


@plan
def kpi_delivery_on_time_pct(s: Star) -> DataFrame:
    return s.timed.agg(F.coalesce(on_time_pct(), F.lit(0.0)).alias("on_time_pct"))


@plan
def kpi_total_sellers(s: Star) -> DataFrame:
    return s.dim_seller.agg(n_rows().alias("total_sellers"))


@plan
def kpi_avg_delivery_delay(s: Star) -> DataFrame:
    return s.timed.agg(F.coalesce(mean("delivery_delay_hours"), F.lit(0.0)).alias("avg_delay_hours"))


@plan
def kpi_total_products_sold(s: Star) -> DataFrame:
    return s.fact_order_items.agg(n_rows().alias("products_sold"))


def monthly_revenue(s: Star) -> DataFrame:
    return s.approved.groupBy(month_of("event_date").alias("month")).agg(F.sum("payment_value").alias("revenue"))


# One row per month reaches this window, so a single partition is enough.
def by_month():
    return Window.orderBy("month")


@plan
def kpi_revenue_mom(s: Star) -> DataFrame:
    months = monthly_revenue(s).withColumn("prev", F.lag("revenue").over(by_month())).withColumn(
        "has_prev", F.row_number().over(by_month()) > 1
    )
    last = months.orderBy(F.desc("month")).limit(1).where("has_prev")
    return last.select(
        F.coalesce(percent(F.col("revenue") - F.col("prev"), F.col("prev")), F.lit(0.0)).alias("mom_growth_pct"),
        F.col("revenue").cast("double").alias("current_month_revenue"),
        F.col("prev").cast("double").alias("previous_month_revenue"),
    )


@plan
def top5_categories_overview(s: Star) -> DataFrame:
    # Revenue is first summed per product, so a best seller is one row in the join.
    return (
        category_totals(s)
        .groupBy("category")
        .agg(total("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(5)
    )


def category_totals(s: Star) -> DataFrame:
    """Units, revenue and freight per product, with the product's category."""
    per_product = s.fact_order_items.groupBy("product_id").agg(
        n_rows().alias("units"),
        F.sum("price").alias("revenue"),
        F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight"),
    )
    products = s.dim_product.select(
        "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
    )
    return per_product.join(products, "product_id")


@plan
def top5_states_overview(s: Star) -> DataFrame:
    return (
        orders_with_customer(s)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy(F.desc("orders"), "state")
        .limit(5)
    )


def orders_with_customer(s: Star, *extra: str) -> DataFrame:
    """Created orders with the customer's place."""
    orders = s.created.select("order_id", "customer_id", *extra)
    return orders.join(s.dim_customer.select("customer_id", "customer_city", "customer_state"), "customer_id")


def timed_by(s: Star, *keys: str) -> DataFrame:
    """Deliveries, delay sum and on-time count per key, before any dimension join."""
    return s.timed.groupBy(*keys).agg(
        n_rows().alias("n"),
        F.sum("delivery_delay_hours").alias("delay"),
        F.count_if(F.col("delivery_delay_hours") <= 0).alias("punctual"),
    )


def delivery_measures():
    return [
        F.sum("n").alias("deliveries"),
        ratio(F.sum("delay"), F.sum("n")).alias("avg_delay_hours"),
        percent(F.sum("punctual"), F.sum("n")).alias("on_time_pct"),
    ]


def seller_deliveries(s: Star) -> DataFrame:
    sellers = s.dim_seller.select("seller_id", "seller_state")
    return (
        timed_by(s, "seller_id").join(sellers, "seller_id").groupBy("seller_id", "seller_state").agg(*delivery_measures())
    )


@plan
def bottom5_sellers_ontime(s: Star) -> DataFrame:
    return (
        seller_deliveries(s)
        .where("deliveries >= 10")
        .select("seller_id", "seller_state", "deliveries", "on_time_pct")
        .orderBy("on_time_pct", "seller_id")
        .limit(5)
    )


@plan
def last_etl_run(s: Star) -> DataFrame:
    return (
        s.fact_data_quality.groupBy("run_id")
        .agg(
            F.max("run_ts").alias("last_run_ts"),
            F.sum("rows_in").alias("total_rows_in"),
            F.sum("rows_out").alias("total_rows_out"),
            F.bool_and(F.col("status") == "success").alias("all_success"),
        )
        .orderBy(F.desc("last_run_ts"), "run_id")
        .limit(1)
    )


@plan
def review_score_last6m(s: Star) -> DataFrame:
    return (
        s.fact_reviews.groupBy(month_of("event_date").alias("month"))
        .agg(mean("review_score").alias("avg_score"))
        .orderBy(F.desc_nulls_first("month"))
        .limit(6)
    )


@plan
def delivery_sla_last6m(s: Star) -> DataFrame:
    return (
        s.timed.groupBy(month_of("event_date").alias("month"))
        .agg(on_time_pct().alias("on_time_pct"))
        .orderBy(F.desc_nulls_first("month"))
        .limit(6)
    )


@plan
def orders_last30d(s: Star) -> DataFrame:
    newest = s.fact_order_events.agg(F.max("event_date").alias("d"))
    return (
        s.created.where(F.col("event_date") >= F.date_sub(newest.scalar(), 30))
        .groupBy("event_date")
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy("event_date")
    )


@plan
def order_event_funnel(s: Star) -> DataFrame:
    return (
        s.fact_order_events.groupBy("event_type").agg(n_rows().alias("cnt")).orderBy(F.desc("cnt"), "event_type")
    )
