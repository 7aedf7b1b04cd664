"""Reports built on top of other plans: pivots, flags, alerts and scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import percent, round4
from tidemart.plans import customers, delivery, observability, overview, products, sales, statistics
from tidemart.registry import plan
from tidemart.sources.star import Star

# ---- fixed values: thresholds and scenario defaults --------------------------
WARN_LAG_SECONDS = 120
CRITICAL_LAG_SECONDS = 300
REVIEW_THRESHOLD = 3.5
ON_TIME_TARGET = 85
SCENARIO = {"sla_pts": 10, "freight_pct": 15, "repeat_pts": 5, "aov_pct": 10}
REVENUE_PER_SLA_POINT = 0.005
REPEAT_REVENUE_SHARE = 0.3
MAX_COHORT_OFFSET = 12
CRITICAL, WARNING = "CRITICAL", "WARNING"
STALE, FAILED, UNHAPPY, LATE = "Stale Data", "Quality Failure", "Low Satisfaction", "Delivery SLA"
STALE_TEXT = "%s last ingested %.1fh ago"
FAILED_TEXT = "%s: %d failed runs"
UNHAPPY_TEXT = f"Average review score: %.2f (below {REVIEW_THRESHOLD} threshold)"
LATE_TEXT = f"On-time delivery: %.1f%% (below {ON_TIME_TARGET}%% target)"
# -----------------------------------------------------------------------------


@plan
def heatmap_pivot_top15(s: Star) -> DataFrame:
    """Category by calendar month revenue of the 15 largest categories, long form.

    Months without sales of a kept category are filled with 0 by the month list,
    as a pivot over the months present would do.
    """
    cells = products.product_category_heatmap(s)
    top = (
        cells.groupBy("category")
        .agg(round4(F.sum("revenue")).alias("size"))
        .orderBy(F.desc("size"), "category")
        .limit(15)
        .select("category")
    )
    # 15 categories times the months of the calendar: the month list is one
    # array value attached to each kept category.
    months = cells.agg(F.array_sort(F.collect_set("month")).alias("m"))
    grid = top.withColumn("month", F.explode(months.scalar()))
    return (
        grid.join(cells, ["category", "month"], "left")
        .select("category", "month", F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
        .orderBy("category", "month")
    )


def heatmap_pivot(s: Star) -> DataFrame:
    """Wide form of :func:`heatmap_pivot_top15`, one column per month."""
    return heatmap_pivot_top15(s).groupBy("category").pivot("month").agg(F.sum("revenue")).fillna(0)


@plan
def regional_growth_top5(s: Star) -> DataFrame:
    cells = products.regional_growth_trend(s)
    top = cells.groupBy("state").agg(F.sum("orders").alias("size")).orderBy(F.desc("size"), "state").limit(5)
    return cells.join(F.broadcast(top), "state", "left_semi").orderBy("month", "state")  # five rows


@plan
def cohort_revenue_top8(s: Star) -> DataFrame:
    cells = customers.cohort_revenue(s)
    top = (
        cells.groupBy("cohort_month")
        .agg(round4(F.sum("revenue")).alias("size"))
        .orderBy(F.desc("size"), "cohort_month")
        .limit(8)
    )
    return cells.join(F.broadcast(top), "cohort_month", "left_semi").orderBy("cohort_month", "month_offset")  # eight rows


@plan
def cohort_retention_matrix(s: Star) -> DataFrame:
    """Percent of each cohort active per month after its first order."""
    offsets = list(range(MAX_COHORT_OFFSET + 1))
    wide = (
        customers.customer_cohorts(s).groupBy("cohort_month").pivot("month_offset", offsets).agg(F.sum("active_customers"))
    )
    cells = [percent(F.coalesce(F.col(f"`{i}`"), F.lit(0)), F.col("`0`")).alias(f"m{i}") for i in offsets]
    return wide.select("cohort_month", *cells).orderBy("cohort_month")


def flagged(series: DataFrame) -> DataFrame:
    return series.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > 2, F.lit(False)))


@plan
def anomaly_flag_and_bands(s: Star) -> DataFrame:
    """Daily orders with the band of two deviations around the mean."""
    mid, sd = F.col("mean_orders"), F.col("std_orders")
    return (
        flagged(statistics.anomaly_daily_orders(s))
        .withColumn("upper_band", mid + 2 * sd)
        .withColumn("lower_band", mid - 2 * sd)
    )


@plan
def daily_revenue_flagged(s: Star) -> DataFrame:
    return flagged(statistics.anomaly_daily_revenue(s))


@plan
def delivery_delay_flagged(s: Star) -> DataFrame:
    return flagged(statistics.anomaly_delivery_delay(s))


@plan
def lifecycle_stage_unpivot(s: Star) -> DataFrame:
    wide = delivery.order_lifecycle_times(s).select(
        F.col("avg_approval_hours").alias("Approval"),
        F.col("avg_ship_hours").alias("Shipping"),
        F.col("avg_transit_hours").alias("Transit"),
    )
    return wide.unpivot([], ["Approval", "Shipping", "Transit"], "stage", "hours").where("hours is not null")


def freshness_label(lag: Column) -> Column:
    return (
        F.when(lag.isNull(), "No data")
        .when(lag <= WARN_LAG_SECONDS, "Fresh")
        .when(lag <= CRITICAL_LAG_SECONDS, "Warning")
        .otherwise("Stale")
    )


def lag_words(lag: Column) -> Column:
    whole = lambda c: F.round(c).cast("bigint").cast("string")
    return (
        F.when(lag.isNull() | (lag == 0), "N/A")
        .when(lag > 3600, F.concat(F.format_string("%.1f", lag / 3600), F.lit("h")))
        .when(lag > 60, F.concat(whole(lag / 60), F.lit("m")))
        .otherwise(F.concat(whole(lag), F.lit("s")))
    )


@plan
def freshness_status(s: Star) -> DataFrame:
    lag = F.col("lag_seconds")
    return observability.ingestion_freshness(s).select(
        "table_name", "last_ingestion", lag_words(lag).alias("lag_display"), "total_rows", freshness_label(lag).alias("status")
    )


@plan
def freshness_counts(s: Star) -> DataFrame:
    status = freshness_label(F.col("lag_seconds")).alias("status")
    return observability.ingestion_freshness(s).groupBy(status).agg(F.count(F.lit(1)).alias("tables"))


@plan
def active_alerts(s: Star) -> DataFrame:
    """One row per stale table, failed dataset and missed target."""

    def alert(df: DataFrame, severity: str, kind: str, detail: Column) -> DataFrame:
        return df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("type"), detail.alias("detail"))

    lag, failed = F.col("lag_seconds"), F.col("failed_runs")
    score, punctual = F.col("avg_review_score"), F.col("on_time_pct")
    stale = alert(
        observability.ingestion_freshness(s).where(lag > CRITICAL_LAG_SECONDS),
        CRITICAL,
        STALE,
        F.format_string(STALE_TEXT, "table_name", lag / 3600),
    )
    quality = alert(
        observability.data_quality_summary(s).where(failed > 0),
        WARNING,
        FAILED,
        F.format_string(FAILED_TEXT, "dataset_name", failed),
    )
    reviews = alert(
        overview.kpi_avg_review_score(s).where(score < REVIEW_THRESHOLD),
        WARNING,
        UNHAPPY,
        F.format_string(UNHAPPY_TEXT, score),
    )
    late = alert(
        overview.kpi_delivery_on_time_pct(s).where(punctual < ON_TIME_TARGET),
        WARNING,
        LATE,
        F.format_string(LATE_TEXT, punctual),
    )
    return observability.stack([stale, quality, reviews, late])


@plan
def box_plot_summary(s: Star) -> DataFrame:
    """Five-number summary with the 1.5 x IQR fences of each metric."""
    stats = statistics.five_numbers(*statistics.measured(s))
    lower, upper = statistics.fences(stats)
    return stats.select("*", round4(lower).alias("lower_fence"), round4(upper).alias("upper_fence"))


@plan
def whatif_projection(s: Star) -> DataFrame:
    """Projected effect of the default scenario on the baseline."""
    return project_scenario(statistics.whatif_baseline(s), **SCENARIO)


def project_scenario(
    baseline: DataFrame, sla_pts: float, freight_pct: float, repeat_pts: float, aov_pct: float
) -> DataFrame:
    revenue = F.coalesce("total_revenue", F.lit(0.0))
    orders = F.coalesce(F.col("total_orders").cast("double"), F.lit(0.0))
    gains = baseline.select(
        F.least(F.lit(100.0), F.coalesce("on_time_pct", F.lit(0.0)) + sla_pts).alias("new_on_time_pct"),
        (revenue * (sla_pts * REVENUE_PER_SLA_POINT)).alias("sla_revenue"),
        (F.coalesce("avg_freight", F.lit(0.0)) * (freight_pct / 100) * orders).alias("freight_savings"),
        (revenue * (repeat_pts / 100) * REPEAT_REVENUE_SHARE).alias("repeat_revenue"),
        (revenue * (aov_pct / 100)).alias("aov_revenue"),
        revenue.alias("revenue"),
    )
    impact = F.col("sla_revenue") + F.col("freight_savings") + F.col("repeat_revenue") + F.col("aov_revenue")
    parts = ("new_on_time_pct", "sla_revenue", "freight_savings", "repeat_revenue", "aov_revenue")
    return gains.select(
        *parts,
        impact.alias("total_impact"),
        F.when(F.col("revenue") > 0, 100 * impact / F.col("revenue")).alias("impact_pct"),
    )


@plan
def violation_unpivot(s: Star) -> DataFrame:
    """Violations per dataset in long form; kinds that never occurred are left out."""
    kinds = [f"total_{k}_violations" for k in ("null", "duplicate", "schema")]
    long = observability.data_quality_summary(s).unpivot(["dataset_name"], kinds, "violation", "violations")
    per_kind = F.sum("violations").over(Window.partitionBy("violation"))  # one row per dataset and kind
    return long.withColumn("seen", per_kind).where("seen > 0").drop("seen")


@plan
def duplicate_total(s: Star) -> DataFrame:
    return observability.duplicate_check(s).agg(
        F.sum("duplicates").alias("duplicates"), (F.sum("duplicates") == 0).alias("passed")
    )


@plan
def label_columns_sellers(s: Star) -> DataFrame:
    label = F.concat(F.substring("seller_id", 1, 8), F.lit("... ("), "seller_state", F.lit(")"))
    return overview.bottom5_sellers_ontime(s).withColumn("label", label)


@plan
def new_pair_top15(s: Star) -> DataFrame:
    """The first 15 category pairs with a display label."""
    return (
        products.top_category_combinations(s)
        .orderBy(F.desc("co_occurrence"), "category_1", "category_2")
        .limit(15)
        .withColumn("pair", F.concat_ws(" + ", "category_1", "category_2"))
    )


@plan
def label_columns_quarters(s: Star) -> DataFrame:
    from tidemart.plans.calendar import quarterly_performance

    period = F.concat(F.col("year").cast("string"), F.lit(" Q"), F.col("quarter").cast("string"))
    return quarterly_performance(s).withColumn("period", period)


@plan
def waterfall_drop_first(s: Star) -> DataFrame:
    return sales.revenue_waterfall(s).dropna(subset=["prev_revenue"])
