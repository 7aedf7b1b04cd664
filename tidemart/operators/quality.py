"""Data-quality checks: counts per rule, each in one pass over its table.

Every check counts rows; a check that needs a key groups by the key first, so a
value shared by very many rows is a single row after the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.plans.observability import fixed_moment, stack
from tidemart.plans.overview import n_rows
from tidemart.registry import plan
from tidemart.schemas import KEYS, TOPIC_EVENT_TYPES
from tidemart.sources.star import Star

# ---- fixed values: the declared rules ------------------------------------------------
CRITICAL = {
    "fact_order_events": ("event_id", "order_id", "event_type", "event_ts", "event_date"),
    "fact_payments": ("event_id", "order_id", "payment_type", "payment_value", "payment_installments"),
    "fact_delivery_events": ("event_id", "order_id", "event_type", "event_ts", "seller_id"),
    "fact_reviews": ("event_id", "review_id", "order_id", "review_score", "review_answer_ts"),
    "fact_order_items": ("order_id", "order_item_id", "product_id", "seller_id"),
}
AMOUNTS = {"fact_payments": ("payment_value",), "fact_order_items": ("price", "freight_value")}
REFERENCES = (
    ("fact_order_events", "customer_id", "dim_customer"),
    ("fact_order_events", "seller_id", "dim_seller"),
    ("fact_payments", "customer_id", "dim_customer"),
    ("fact_delivery_events", "customer_id", "dim_customer"),
    ("fact_delivery_events", "seller_id", "dim_seller"),
    ("fact_reviews", "customer_id", "dim_customer"),
    ("fact_reviews", "seller_id", "dim_seller"),
    ("fact_order_items", "product_id", "dim_product"),
    ("fact_order_items", "seller_id", "dim_seller"),
)
ORDERINGS = (
    ("fact_order_events", "approved_before_purchase", "approved_ts < purchase_ts"),
    ("fact_delivery_events", "delivered_before_shipped", "delivered_customer_ts < shipped_ts"),
    ("fact_reviews", "answered_before_created", "review_answer_ts < review_created_ts"),
)
# ----------------------------------------------------------------------------------------


def count_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """(table_name, rule, violations, rows) from a single pass."""
    counted = df.agg(n_rows().alias("_rows"), *[F.count_if(c).alias(name) for name, c in rules.items()])
    return counted.unpivot(["_rows"], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations", F.col("_rows").alias("total_rows")
    )


@plan
def missing_critical_fields(s: Star) -> DataFrame:
    return stack(
        [count_rules(s.table(t), t, {c: F.col(c).isNull() for c in columns}) for t, columns in CRITICAL.items()]
    )


def key_duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    copies = df.groupBy(*keys).agg(n_rows().alias("n"))
    return copies.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        n_rows().alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


@plan
def duplicate_keys(s: Star) -> DataFrame:
    return stack([key_duplicates(s.table(t), t, keys) for t, keys in KEYS.items()])


@plan
def invalid_amounts(s: Star) -> DataFrame:
    """Negative money; a missing price is allowed."""
    return stack(
        [count_rules(s.table(t), t, {c: F.col(c) < 0 for c in columns}) for t, columns in AMOUNTS.items()]
    )


def valid_amount(*columns: str) -> Column:
    """Rows to keep: every amount is absent or not negative."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c) >= 0, F.lit(True)) for c in columns])


def quarantine(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that satisfy ``keep`` and the rest (NULL counts as rest)."""
    sure = F.coalesce(keep, F.lit(False))
    return df.where(sure), df.where(~sure)


@plan
def review_score_range(s: Star) -> DataFrame:
    score = F.col("review_score")
    return count_rules(s.fact_reviews, "fact_reviews", {"review_score": ~score.between(1, 5)})


def unknown_event_types(df: DataFrame, table: str, allowed: DataFrame) -> DataFrame:
    counts = df.groupBy("event_type").agg(n_rows().alias("total_rows"))
    return counts.join(allowed, "event_type", "left_anti").select(F.lit(table).alias("table_name"), "event_type", "total_rows")


@plan
def event_type_vocabulary(s: Star) -> DataFrame:
    """Event types the governance dimension does not list."""
    allowed = s.dim_event_type.select("event_type")
    return stack(
        [unknown_event_types(s.table(t), t, allowed) for t in ("fact_order_events", "fact_delivery_events")]
    )


@plan
def event_type_enum(s: Star) -> DataFrame:
    """Event types outside the topic's own enum, over both event facts."""

    def one(table: str, topic: str) -> DataFrame:
        return count_rules(s.table(table), table, {"event_type": ~F.col("event_type").isin(*TOPIC_EVENT_TYPES[topic])})

    return stack([one("fact_order_events", "order_events"), one("fact_delivery_events", "delivery_events")])


@plan
def timestamp_anomalies(s: Star) -> DataFrame:
    """Missing or future event times and stages out of order."""
    frames = []
    for table, rule, broken in ORDERINGS:
        rules = {
            "missing_event_ts": F.col("event_ts").isNull(),
            "future_event_ts": F.col("event_ts") > fixed_moment(),
            rule: F.expr(broken),
        }
        frames.append(count_rules(s.table(table), table, rules))
    return stack(frames)


@plan
def referential_integrity(s: Star) -> DataFrame:
    """Rows whose foreign key has no dimension row; a NULL key is not an orphan."""

    def one(fact: str, key: str, dim: str) -> DataFrame:
        keys = s.table(fact).where(F.col(key).isNotNull()).groupBy(key).agg(n_rows().alias("n"))
        orphans = keys.join(s.table(dim).select(key), key, "left_anti")
        return orphans.agg(
            F.lit(fact).alias("table_name"),
            F.lit(key).alias("key_name"),
            F.lit(dim).alias("dimension"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            n_rows().alias("orphan_keys"),
        )

    return stack([one(*r) for r in REFERENCES])


QUALITY_RULES = {
    "fact_order_events": ("event_id is null or order_id is null or event_ts is null", "approved_ts < purchase_ts"),
    "fact_payments": ("event_id is null or order_id is null or payment_value is null", "payment_value < 0"),
    "fact_delivery_events": ("event_id is null or order_id is null or event_ts is null", "delivered_customer_ts < shipped_ts"),
    "fact_reviews": ("event_id is null or review_id is null or review_score is null", "review_score not between 1 and 5"),
    "fact_order_items": ("order_id is null or product_id is null or seller_id is null", "price < 0 or freight_value < 0"),
}


def quality_record(df: DataFrame, table: str, missing: Column, invalid: Column, run_id: str, run_ts: Column) -> DataFrame:
    """One fact_data_quality row: rows, null, duplicate and rule violations of a table."""
    keys = KEYS[table]
    per_key = df.groupBy(*keys).agg(
        n_rows().alias("n"),
        F.count_if(missing).alias("nulls"),
        F.count_if(invalid).alias("broken"),
        F.count_if(~F.coalesce(missing, F.lit(False)) & ~F.coalesce(invalid, F.lit(False))).alias("clean"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = per_key.agg(
        total("n").alias("rows_in"),
        F.count_if(F.col("clean") > 0).alias("rows_out"),
        total("nulls").alias("null_violations"),
        total(F.col("n") - 1).alias("duplicate_violations"),
        total("broken").alias("schema_violations"),
    )
    bad = F.col("null_violations") + F.col("duplicate_violations") + F.col("schema_violations")
    return out.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("dataset_name"),
        run_ts.alias("run_ts"),
        "*",
        F.when(bad > 0, "failed").otherwise("success").alias("status"),
    )


@plan
def quality_run(s: Star) -> DataFrame:
    return stack(
        [
            quality_record(s.table(t), t, F.expr(missing), F.expr(invalid), "check", fixed_moment())
            for t, (missing, invalid) in QUALITY_RULES.items()
        ]
    )
