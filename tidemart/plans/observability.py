"""Freshness, volume, completeness and quality-run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import mean, seconds_between
from tidemart.plans.overview import n_rows
from tidemart.registry import plan
from tidemart.sources.star import DIMS, FACTS, Star

# The reports compare against a fixed moment instead of the wall clock, so that
# a rerun on the same tables gives the same rows.
AS_OF = "2001-12-05 00:00:00"
HOURS_SHOWN = 168


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@plan
def data_quality_runs(s: Star) -> DataFrame:
    return s.fact_data_quality.orderBy(F.desc("run_ts"), "run_id", "dataset_name").limit(50)


@plan
def data_quality_summary(s: Star) -> DataFrame:
    sums = ("rows_in", "rows_out", "null_violations", "duplicate_violations", "schema_violations")
    return (
        s.fact_data_quality.groupBy("dataset_name")
        .agg(
            n_rows().alias("total_runs"),
            F.count_if(F.col("status") == "success").alias("success_runs"),
            F.count_if(F.col("status") == "failed").alias("failed_runs"),
            *[F.sum(c).alias(f"total_{c}") for c in sums],
        )
        .orderBy("dataset_name")
    )


def freshness(s: Star, as_of: Column) -> DataFrame:
    """Newest ingestion, lag and rows of each fact at ``as_of``."""

    def one(name: str, stamp: Column) -> DataFrame:
        return s.table(name).agg(
            F.lit(name).alias("table_name"), F.max(stamp).alias("last_ingestion"), n_rows().alias("total_rows")
        )

    stamped = ("fact_order_events", "fact_payments", "fact_delivery_events", "fact_reviews")
    frames = [one(t, F.col("ingestion_ts")) for t in stamped]
    # Order items carry no ingestion time; their newest day stands in.
    frames.append(one("fact_order_items", F.col("event_date").cast("timestamp_ntz")))
    lag = seconds_between(F.col("last_ingestion"), as_of).cast("double")
    return stack(frames).select("table_name", "last_ingestion", lag.alias("lag_seconds"), "total_rows")


def fixed_moment() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


@plan
def ingestion_freshness(s: Star) -> DataFrame:
    return freshness(s, fixed_moment())


@plan
def table_row_counts(s: Star) -> DataFrame:
    return stack([s.table(t).agg(F.lit(t).alias("table_name"), n_rows().alias("row_count")) for t in DIMS + FACTS])


@plan
def event_volume_by_day(s: Star) -> DataFrame:
    return (
        s.fact_order_events.groupBy("event_date", "event_type")
        .agg(n_rows().alias("event_count"))
        .orderBy("event_date", "event_type")
    )


@plan
def ingestion_rate_hourly(s: Star) -> DataFrame:
    hour = F.date_trunc("hour", "ingestion_ts").cast("timestamp_ntz")
    return (
        s.fact_order_events.groupBy(hour.alias("hour"))
        .agg(n_rows().alias("events_ingested"))
        .orderBy(F.desc_nulls_first("hour"))
        .limit(HOURS_SHOWN)
    )


@plan
def event_type_domain_summary(s: Star) -> DataFrame:
    counts = s.fact_order_events.groupBy("event_type").agg(n_rows().alias("n"))
    return (
        s.dim_event_type.join(counts, "event_type", "left")
        .select("domain", "event_type", "is_terminal_state", F.coalesce("n", F.lit(0)).alias("event_count"))
        .orderBy("domain", "is_terminal_state", F.desc("event_count"), "event_type")
    )


@plan
def pipeline_throughput(s: Star) -> DataFrame:
    return (
        s.fact_order_events.where("ingestion_ts is not null")
        .groupBy(F.col("ingestion_ts").cast("date").alias("day"))
        .agg(
            n_rows().alias("events_ingested"),
            F.min("event_ts").alias("earliest_event"),
            F.max("event_ts").alias("latest_event"),
            mean(seconds_between("event_ts", "ingestion_ts")).alias("avg_lag_seconds"),
        )
        .orderBy("day")
    )


@plan
def data_completeness(s: Star) -> DataFrame:
    missing = lambda c: F.count_if(F.col(c).isNull())

    def one(name: str, status: str, has_seller: bool = True) -> DataFrame:
        return s.table(name).agg(
            F.lit(name).alias("table_name"),
            n_rows().alias("total_rows"),
            missing("customer_id").alias("null_customer"),
            (missing("seller_id") if has_seller else F.lit(0).cast("bigint")).alias("null_seller"),
            missing(status).alias("null_status"),
        )

    return stack(
        [
            one("fact_order_events", "order_status"),
            one("fact_payments", "payment_status", has_seller=False),
            one("fact_delivery_events", "carrier_status"),
        ]
    )


EVENT_FACTS = ("fact_order_events", "fact_payments", "fact_delivery_events", "fact_reviews")


@plan
def duplicate_check(s: Star) -> DataFrame:
    """Rows beyond the first per event id.

    Copies are counted per id first, so one id with very many copies is one row
    after the map side.
    """

    def one(name: str) -> DataFrame:
        copies = s.table(name).groupBy("event_id").agg(n_rows().alias("n"))
        all_rows, ids = F.coalesce(F.sum("n"), F.lit(0)), F.count("event_id")
        return copies.agg(
            F.lit(name).alias("table_name"),
            all_rows.alias("total"),
            ids.alias("distinct_events"),
            (all_rows - ids).alias("duplicates"),
        )

    return stack([one(t) for t in EVENT_FACTS])
