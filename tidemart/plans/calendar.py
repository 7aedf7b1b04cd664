"""Calendar reports: joins with the day dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import ratio, total
from tidemart.registry import plan
from tidemart.sources.star import Star


def n_orders():
    return F.count_distinct("order_id").alias("orders")


def revenue():
    return total("paid").alias("revenue")


def paid_days(s: Star) -> DataFrame:
    """Created orders with their payments and the attributes of the order day."""
    orders = s.created_paid.select("order_id", F.col("event_date").alias("full_date"), "paid", "payments")
    return orders.join(s.dim_date, "full_date")


def day_type():
    return F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type")


@plan
def weekday_vs_weekend(s: Star) -> DataFrame:
    return paid_days(s).groupBy(day_type()).agg(n_orders(), revenue()).orderBy("day_type")


@plan
def orders_by_day_of_week(s: Star) -> DataFrame:
    orders = s.created.select("order_id", F.col("event_date").alias("full_date"))
    return orders.join(s.dim_date, "full_date").groupBy("day_name", "day_of_week").agg(n_orders()).orderBy("day_of_week")


@plan
def quarterly_performance(s: Star) -> DataFrame:
    return paid_days(s).groupBy("year", "quarter").agg(n_orders(), revenue()).orderBy("year", "quarter")


@plan
def orders_by_month_name(s: Star) -> DataFrame:
    return (
        paid_days(s)
        .groupBy(F.col("month").alias("month_num"), "month_name")
        .agg(n_orders(), revenue())
        .orderBy("month_num")
    )


@plan
def orders_by_quarter_yoy(s: Star) -> DataFrame:
    period = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    return quarterly_performance(s).select("year", "quarter", period.alias("period"), "orders", "revenue")


@plan
def weekday_hourly_pattern(s: Star) -> DataFrame:
    """Orders and mean payment per weekday (no hour enters, whatever the name says)."""
    return (
        paid_days(s)
        .groupBy("day_name", "day_of_week", day_type())
        .agg(n_orders(), ratio(F.sum("paid"), F.sum("payments")).alias("avg_order_value"))
        .orderBy("day_of_week")
    )
