"""Products, places, baskets and freight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions.columns import mean, money_sum, month_of, percent, ratio, round4, total
from tidemart.plans.overview import n_rows, category_totals, orders_with_customer
from tidemart.registry import plan
from tidemart.sources.star import Star


def month():
    return month_of("event_date").alias("month")


def product_sales(s: Star) -> DataFrame:
    return category_totals(s).select(
        "product_id",
        "category",
        F.col("units").alias("units_sold"),
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
    )


@plan
def product_top_by_revenue(s: Star) -> DataFrame:
    return product_sales(s).orderBy(F.desc("revenue"), "product_id").limit(20)


@plan
def product_bottom_by_revenue(s: Star) -> DataFrame:
    return product_sales(s).where("units_sold >= 5").orderBy("revenue", "product_id").limit(20)


def category_months(s: Star) -> DataFrame:
    """Revenue, priced rows and volume per category and month."""
    per_product = s.fact_order_items.groupBy("product_id", month()).agg(
        F.sum("price").alias("revenue"), F.count("price").alias("priced"), n_rows().alias("volume")
    )
    products = s.dim_product.select(
        "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
    )
    return (
        per_product.join(products, "product_id")
        .groupBy("category", "month")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "priced", "volume")])
    )


@plan
def product_category_heatmap(s: Star) -> DataFrame:
    return (
        category_months(s)
        .select("category", "month", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"))
        .orderBy("month", "category")
    )


@plan
def product_price_distribution(s: Star) -> DataFrame:
    return (
        s.fact_order_items.groupBy(B.below(F.col("price"), B.SPEND, B.SPEND_TOP).alias("price_bucket"))
        .agg(n_rows().alias("items"), F.min("price").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


def basket_by_order(s: Star) -> DataFrame:
    return s.fact_order_items.groupBy("order_id").agg(
        F.min("event_date").alias("event_date"),
        n_rows().alias("items"),
        F.sum("price").alias("spent"),
        F.sum("freight_value").alias("freight"),
        F.sum(F.col("price") + F.col("freight_value")).alias("spent_with_freight"),
    )


@plan
def items_per_order_distribution(s: Star) -> DataFrame:
    return (
        basket_by_order(s)
        .groupBy(F.col("items").alias("items_in_order"))
        .agg(n_rows().alias("order_count"))
        .orderBy("items_in_order")
    )


@plan
def basket_size_trend(s: Star) -> DataFrame:
    return (
        basket_by_order(s)
        .groupBy(month())
        .agg(mean("items").alias("avg_basket_size"), mean("spent").alias("avg_basket_value"))
        .orderBy("month")
    )


@plan
def multi_item_orders_pct(s: Star) -> DataFrame:
    kind = F.when(F.col("items") > 1, "Multi-item").otherwise("Single-item")
    return basket_by_order(s).groupBy(kind.alias("order_type")).agg(n_rows().alias("orders"), mean("spent").alias("avg_value"))


@plan
def top_category_combinations(s: Star) -> DataFrame:
    """Categories bought together, counted in item pairs.

    Items are first counted per (order, category): an order then joins with
    itself at category grain and a pair counts n1 * n2.
    """
    counted = s.items_categorised.groupBy("order_id", "category").agg(n_rows().alias("n"))
    left = counted.select("order_id", F.col("category").alias("category_1"), F.col("n").alias("n1"))
    right = counted.select("order_id", F.col("category").alias("category_2"), F.col("n").alias("n2"))
    return (
        left.join(right, "order_id")
        .where("category_1 < category_2")
        .groupBy("category_1", "category_2")
        .agg(F.sum(F.col("n1") * F.col("n2")).alias("co_occurrence"))
        .where("co_occurrence >= 10")
        .orderBy(F.desc("co_occurrence"), "category_1", "category_2")
        .limit(20)
    )


@plan
def freight_cost_distribution(s: Star) -> DataFrame:
    return (
        s.fact_order_items.groupBy(B.below(F.col("freight_value"), B.FREIGHT, B.FREIGHT_TOP).alias("freight_bucket"))
        .agg(n_rows().alias("items"), F.min("freight_value").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def freight_pct_of_order(s: Star) -> DataFrame:
    pct = percent(F.col("freight"), F.col("spent_with_freight"))
    return (
        basket_by_order(s)
        .select(pct.alias("pct"))
        .groupBy(B.below(F.col("pct"), B.FREIGHT_PCT, B.FREIGHT_PCT_TOP).alias("freight_pct_bucket"))
        .agg(n_rows().alias("orders"), F.min("pct").alias("lowest"))
        .orderBy(F.asc_nulls_last("lowest"))
        .drop("lowest")
    )


@plan
def freight_by_state(s: Star) -> DataFrame:
    per_order = s.fact_order_items.groupBy("order_id").agg(
        n_rows().alias("items"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("freight_n"),
        F.sum("price").alias("price"),
        F.count("price").alias("price_n"),
        F.sum(F.col("price") + F.col("freight_value")).alias("both"),
    )
    return (
        per_order.join(orders_with_customer(s), "order_id")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.sum("items").alias("items"),
            ratio(F.sum("freight"), F.sum("freight_n")).alias("avg_freight"),
            money_sum("freight").alias("total_freight"),
            ratio(F.sum("price"), F.sum("price_n")).alias("avg_price"),
            percent(F.sum("freight"), F.sum("both")).alias("freight_pct"),
        )
        .where("items >= 10")
        .orderBy(F.desc_nulls_first("avg_freight"), "state")
    )


# ---- places -----------------------------------------------------------------


@plan
def orders_by_state(s: Star) -> DataFrame:
    return (
        orders_with_customer(s)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"))
        .orderBy(F.desc("orders"), "state")
    )


def paid_with_customer(s: Star) -> DataFrame:
    customers = s.dim_customer.select("customer_id", "customer_city", "customer_state")
    return s.created_paid.select("order_id", "customer_id", "event_date", "paid").join(customers, "customer_id")


@plan
def revenue_by_state(s: Star) -> DataFrame:
    return (
        paid_with_customer(s)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.count_distinct("order_id").alias("orders"),
            total("paid").alias("revenue"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .orderBy(F.desc("revenue"), "state")
    )


@plan
def top_cities_by_orders(s: Star) -> DataFrame:
    return (
        paid_with_customer(s)
        .groupBy(F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))
        .agg(F.count_distinct("order_id").alias("orders"), total("paid").alias("revenue"))
        .orderBy(F.desc("orders"), "city", "state")
        .limit(20)
    )


@plan
def regional_growth_trend(s: Star) -> DataFrame:
    return (
        orders_with_customer(s, "event_date")
        .groupBy(F.col("customer_state").alias("state"), month())
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy("month", "state")
    )


@plan
def category_price_sensitivity(s: Star) -> DataFrame:
    """Pearson correlation of monthly mean price and volume per category.

    Covariance over the product of deviations, NULL for a constant series.
    """
    months = category_months(s).select(
        "category", ratio(F.col("revenue"), F.col("priced")).alias("p"), F.col("volume").cast("double").alias("v")
    )
    corr = F.try_divide(F.covar_pop("p", "v"), F.stddev_pop("p") * F.stddev_pop("v"))
    return (
        months.groupBy("category")
        .agg(
            F.round(corr, 10).alias("c"),
            F.round(F.avg("p"), 6).alias("mean_price"),
            mean("v").alias("mean_volume"),
            n_rows().alias("months"),
        )
        .where("months >= 6")
        .orderBy(F.asc_nulls_last("c"), "category")
        .limit(20)
        .select("category", round4(F.col("c")).alias("price_volume_corr"), "mean_price", "mean_volume", "months")
    )
