"""Anomaly scores, descriptive statistics and the what-if baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import mean, month_of, money_sum, on_time_pct, percent, ratio, round4
from tidemart.functions.quantiles import exact_quantiles, quantiles_by_metric, value_counts
from tidemart.plans.overview import n_rows
from tidemart.plans.products import category_months
from tidemart.registry import plan
from tidemart.sources.star import Star


def z_scores(series: DataFrame, value: str, mean_name: str, std_name: str | None, money: bool = False) -> DataFrame:
    """Adds the series' mean, deviation and each row's distance in deviations.

    The series has one row per day or month; its moments are scalar subqueries.
    """
    v = F.col(value).cast("double")
    moments = series.agg(mean(value).alias("m"), F.stddev_samp(v).alias("sd"))
    m, sd = moments.select("m").scalar(), moments.select("sd").scalar()
    scored = [round4(F.try_divide(v - m, sd)).alias("z_score")]
    if std_name:
        scored.insert(0, round4(sd).alias(std_name))
    key = next(c for c in series.columns if c != value)
    return series.select(key, v.alias(value) if money else value, m.alias(mean_name), *scored)


@plan
def anomaly_daily_orders(s: Star) -> DataFrame:
    daily = s.created.groupBy("event_date").agg(F.count_distinct("order_id").alias("orders"))
    return z_scores(daily, "orders", "mean_orders", "std_orders").orderBy("event_date")


@plan
def anomaly_daily_revenue(s: Star) -> DataFrame:
    daily = s.approved.groupBy("event_date").agg(F.sum("payment_value").alias("revenue"))
    return z_scores(daily, "revenue", "mean_rev", "std_rev", money=True).orderBy("event_date")


@plan
def anomaly_delivery_delay(s: Star) -> DataFrame:
    monthly = s.timed.groupBy(month_of("event_date").alias("month")).agg(mean("delivery_delay_hours").alias("avg_delay"))
    scores = z_scores(monthly, "avg_delay", "mean_delay", None)
    return scores.withColumn("mean_delay", F.round("mean_delay", 6)).orderBy("month")


@plan
def anomaly_category_surge(s: Star) -> DataFrame:
    months = category_months(s).select("category", "month", "revenue")
    moments = (
        months.groupBy("category")
        .agg(mean("revenue").alias("mean_rev"), F.stddev_samp(F.col("revenue").cast("double")).alias("sd"))
        .where("sd > 0")
    )
    revenue = F.col("revenue").cast("double")
    z = (revenue - F.col("mean_rev")) / F.col("sd")
    return (
        months.join(moments, "category")
        .select("category", "month", revenue.alias("revenue"), "mean_rev", F.round(z, 8).alias("z"))
        .where(F.abs("z") > 2)
        .orderBy(F.desc(F.abs("z")), "category", "month")
        .limit(30)
        .select("category", "month", "revenue", "mean_rev", round4(F.col("z")).alias("z_score"))
    )


# ---- descriptive statistics ---------------------------------------------------


def describe(df: DataFrame, column: str, label: str) -> DataFrame:
    """Count, moments and exact quartiles of one column, as one row."""
    v = F.col(column)
    quartiles = exact_quantiles(df, v, (0.25, 0.5, 0.75))
    basics = df.agg(
        n_rows().alias("n"),
        mean(column).alias("mean"),
        round4(F.stddev_samp(v.cast("double"))).alias("stddev"),
        F.min(v).cast("double").alias("min_val"),
        F.max(v).cast("double").alias("max_val"),
    )
    return basics.withColumn("q", quartiles.select(F.struct("q0", "q1", "q2")).scalar()).select(
        F.lit(label).alias("metric"),
        "n",
        "mean",
        round4(F.col("q.q1")).alias("median"),
        "stddev",
        "min_val",
        round4(F.col("q.q0")).alias("q1"),
        round4(F.col("q.q2")).alias("q3"),
        "max_val",
    )


@plan
def stats_price(s: Star) -> DataFrame:
    return describe(s.fact_order_items, "price", "Price")


@plan
def stats_freight(s: Star) -> DataFrame:
    return describe(s.fact_order_items, "freight_value", "Freight")


@plan
def stats_delivery_delay(s: Star) -> DataFrame:
    return describe(s.timed, "delivery_delay_hours", "Delivery Delay (h)")


@plan
def stats_review(s: Star) -> DataFrame:
    return describe(s.fact_reviews, "review_score", "Review Score")


@plan
def stats_payment_value(s: Star) -> DataFrame:
    return describe(s.approved, "payment_value", "Payment Value")


def measured(s: Star) -> tuple[DataFrame, DataFrame]:
    """The described metrics' names, and how often each value of each occurs.

    Each table is read once for all its metrics, and their values are counted before the one shuffle.
    """
    sources = (
        (s.fact_order_items, {"Price": "price", "Freight": "freight_value"}),
        (s.timed, {"Delivery Delay (h)": "delivery_delay_hours"}),
        (s.fact_reviews, {"Review Score": "review_score"}),
        (s.approved, {"Payment Value": "payment_value"}),
    )

    def long(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("decimal(18,2)").alias("v")) for m, c in columns.items()]
        return df.select(F.inline(F.array(*pairs)))

    values = reduce(DataFrame.unionByName, [long(*source) for source in sources])
    names = F.array(*[F.lit(m) for _, columns in sources for m in columns])
    return values.sparkSession.range(1).select(F.explode(names).alias("metric")), value_counts(values)


def describe_counts(metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """The columns of :func:`describe`, one row per metric, from counted values."""
    v, n = F.col("v"), F.col("n")
    known = F.sum(F.when(v.isNotNull(), n))
    sums = counts.groupBy("metric").agg(
        F.sum("n").alias("n"),
        ratio(F.sum(v * n.cast("decimal(20,0)")), known).alias("mean"),
        F.min(v).cast("double").alias("min_val"),
        F.max(v).cast("double").alias("max_val"),
    )
    # These have a row per metric: safe to broadcast at any size of the tables.
    squares = F.sum(n * F.pow(v.cast("double") - F.col("mean"), 2))
    spread = (
        counts.join(F.broadcast(sums.select("metric", "mean")), "metric")
        .groupBy("metric")
        .agg(F.sqrt(F.try_divide(squares, (known - 1).cast("double"))).alias("stddev"))
    )
    parts = (sums, spread, quantiles_by_metric(counts, (0.25, 0.5, 0.75)))
    joined = reduce(lambda left, part: left.join(F.broadcast(part), "metric", "left"), parts, metrics)
    return joined.select(
        "metric",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        "mean",
        round4(F.col("q1")).alias("median"),
        round4(F.col("stddev")).alias("stddev"),
        "min_val",
        round4(F.col("q0")).alias("q1"),
        round4(F.col("q2")).alias("q3"),
        "max_val",
    )


@plan
def descriptive_stats_all(s: Star) -> DataFrame:
    return describe_counts(*measured(s))


def five_numbers(metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """Least value, quartiles and greatest value of each metric."""
    found = quantiles_by_metric(counts, (0.0, 0.25, 0.5, 0.75, 1.0))
    named = [F.col("q0").alias("min"), *[round4(F.col(f"q{i}")).alias(x) for i, x in ((1, "q1"), (2, "median"), (3, "q3"))]]
    return metrics.join(F.broadcast(found), "metric", "left").select("metric", *named, F.col("q4").alias("max"))


def fences(stats: DataFrame) -> list[Column]:
    """Edges 1.5 x IQR beyond the quartiles."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return [(F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi")]


def outliers(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows of ``df`` whose column lies outside its fences."""
    v = F.col(column).cast("double")
    edges = describe(df, column, label)
    edges = edges.select(F.struct(*fences(edges))).scalar()
    return df.withColumn("edges", edges).where((v < F.col("edges.lo")) | (v > F.col("edges.hi"))).drop("edges")


@plan
def iqr_outliers(s: Star) -> DataFrame:
    """Rows below and above the fences, per metric."""
    metrics, counts = measured(s)
    stats = describe_counts(metrics, counts)
    edges = F.broadcast(stats.select("metric", "n", *fences(stats)))  # a row per metric
    v = F.col("v").cast("double")
    beyond = lambda cond: F.sum(F.when(cond, F.col("times")).otherwise(0))
    outside = (
        counts.withColumnRenamed("n", "times")
        .join(edges, "metric")
        .groupBy("metric")
        .agg(beyond(v < F.col("lo")).alias("below"), beyond(v > F.col("hi")).alias("above"))
    )
    none = F.lit(0).cast("bigint")
    return edges.join(F.broadcast(outside), "metric", "left").select(
        "metric", "n", F.coalesce("below", none).alias("below"), F.coalesce("above", none).alias("above")
    )


# ---- what-if -------------------------------------------------------------------


@plan
def whatif_baseline(s: Star) -> DataFrame:
    orders = s.created_paid.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.coalesce(money_sum("paid"), F.lit(0.0)).alias("total_revenue"),
        ratio(F.sum("paid"), F.sum("payments")).alias("avg_order_value"),
    )
    per_customer = (
        s.created.where("customer_id is not null").groupBy("customer_id").agg(F.count_distinct("order_id").alias("orders"))
    )
    one = lambda df, value: df.agg(value.alias("x")).scalar()
    return orders.select(
        "*",
        one(s.fact_reviews, mean("review_score")).alias("avg_review"),
        one(s.timed, on_time_pct()).alias("on_time_pct"),
        one(s.fact_order_items, mean("freight_value")).alias("avg_freight"),
        one(per_customer, percent(F.count_if(F.col("orders") > 1), n_rows())).alias("repeat_rate_pct"),
    )
