"""Statements for the quality checks and the curated marts."""

from __future__ import annotations

from oracle.analytics import mean, money, month, pct

CRITICAL = {
    "fact_order_events": "event_id order_id event_type event_ts event_date",
    "fact_payments": "event_id order_id payment_type payment_value payment_installments",
    "fact_delivery_events": "event_id order_id event_type event_ts seller_id",
    "fact_reviews": "event_id review_id order_id review_score review_answer_ts",
    "fact_order_items": "order_id order_item_id product_id seller_id",
}


def rule(table: str, name: str, cond: str) -> str:
    return f"""select '{table}' as table_name, '{name}' as rule, count(*) filter ({cond}) as violations, count(*) as total_rows from {table}"""


def union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


KEYS = {
    "dim_customer": "customer_id",
    "dim_seller": "seller_id",
    "dim_product": "product_id",
    "fact_order_events": "event_id",
    "fact_payments": "event_id",
    "fact_delivery_events": "event_id",
    "fact_reviews": "event_id",
    "fact_order_items": "(order_id, order_item_id)",
}
MOMENT = "timestamp '2001-12-05 00:00:00'"
STAGES = (
    ("fact_order_events", "approved_before_purchase", "approved_ts < purchase_ts"),
    ("fact_delivery_events", "delivered_before_shipped", "delivered_customer_ts < shipped_ts"),
    ("fact_reviews", "answered_before_created", "review_answer_ts < review_created_ts"),
)
LINKS = (
    "fact_order_events customer_id dim_customer",
    "fact_order_events seller_id dim_seller",
    "fact_payments customer_id dim_customer",
    "fact_delivery_events customer_id dim_customer",
    "fact_delivery_events seller_id dim_seller",
    "fact_reviews customer_id dim_customer",
    "fact_reviews seller_id dim_seller",
    "fact_order_items product_id dim_product",
    "fact_order_items seller_id dim_seller",
)


def run_row(table: str, key: str, missing: str, invalid: str) -> str:
    return f"""select 'check' as run_id, '{table}' as dataset_name, {MOMENT} as run_ts, count(*) as rows_in,
  count(distinct {key}) filter (not coalesce({missing}, false) and not coalesce({invalid}, false)) as rows_out,
  count(*) filter ({missing}) as null_violations, count(*) - count(distinct {key}) as duplicate_violations,
  count(*) filter ({invalid}) as schema_violations,
  if(count(*) filter ({missing}) + count(*) - count(distinct {key}) + count(*) filter ({invalid}) > 0, 'failed', 'success') as status
from {table}"""


SQL: dict[str, str] = {
    "missing_critical_fields": union(
        [rule(t, c, f"{c} is null") for t, columns in CRITICAL.items() for c in columns.split()]
    ),
    "duplicate_keys": union(
        [
            f"""select '{t}' as table_name, count(*) as total_rows, count(distinct {k}) as distinct_keys,
  count(*) - count(distinct {k}) as duplicates from {t}"""
            for t, k in KEYS.items()
        ]
    ),
    "invalid_amounts": union(
        [
            rule("fact_payments", "payment_value", "payment_value < 0"),
            rule("fact_order_items", "price", "price < 0"),
            rule("fact_order_items", "freight_value", "freight_value < 0"),
        ]
    ),
    "review_score_range": rule("fact_reviews", "review_score", "review_score not between 1 and 5"),
    "event_type_vocabulary": union(
        [
            f"""select '{t}' as table_name, event_type, count(*) as total_rows from {t}
where event_type not in (select event_type from dim_event_type) group by event_type"""
            for t in ("fact_order_events", "fact_delivery_events")
        ]
    ),
    "event_type_enum": union(
        [
            rule("fact_order_events", "event_type", "event_type not in ('order_created', 'order_approved', 'order_canceled')"),
            rule("fact_delivery_events", "event_type", "event_type not in ('order_shipped', 'order_delivered')"),
        ]
    ),
    "timestamp_anomalies": union(
        [
            rule(t, n, c)
            for t, name, cond in STAGES
            for n, c in (("missing_event_ts", "event_ts is null"), ("future_event_ts", f"event_ts > {MOMENT}"), (name, cond))
        ]
    ),
    "referential_integrity": union(
        [
            f"""select '{f}' as table_name, '{k}' as key_name, '{d}' as dimension, count(*) as orphan_rows,
  count(distinct {k}) as orphan_keys from {f} where {k} is not null and {k} not in (select {k} from {d})"""
            for f, k, d in (link.split() for link in LINKS)
        ]
    ),
    "quality_run": union(
        [
            run_row("fact_order_events", "event_id", "(event_id is null or order_id is null or event_ts is null)", "(approved_ts < purchase_ts)"),
            run_row("fact_payments", "event_id", "(event_id is null or order_id is null or payment_value is null)", "(payment_value < 0)"),
            run_row("fact_delivery_events", "event_id", "(event_id is null or order_id is null or event_ts is null)", "(delivered_customer_ts < shipped_ts)"),
            run_row("fact_reviews", "event_id", "(event_id is null or review_id is null or review_score is null)", "(review_score not between 1 and 5)"),
            run_row("fact_order_items", "(order_id, order_item_id)", "(order_id is null or product_id is null or seller_id is null)", "(price < 0 or freight_value < 0)"),
        ]
    ),
    # ---- curated marts ----------------------------------------------------------------------
    "mart_daily_sales": f"""
select made.event_date, category, customer_state as state, count(distinct sold.order_id) as orders, count(*) as items,
  {money('price')} as price, {money('freight_value')} as freight
from sold join made on made.order_id = sold.order_id join dim_customer using (customer_id) group by all""",
    "mart_payment_mix": f"""
select event_date, payment_type, count(*) as txns, {money('payment_value')} as total_value,
  {mean('payment_installments')} as avg_installments
from paid group by event_date, payment_type""",
    "mart_delivery_sla": f"""
select event_date, seller_id, count(*) as deliveries, count(*) filter (delivery_delay_hours <= 0) as on_time,
  {mean('delivery_delay_hours')} as avg_delay_hours, count(*) filter (delivery_delay_hours > 48) as late_beyond_sla
from timed group by event_date, seller_id""",
    "mart_order_funnel": """
, steps as (
  select event_date, event_type as kind, order_id from fact_order_events
  union all select event_date, event_type, order_id from fact_delivery_events
  union all select event_date, 'order_reviewed', order_id from fact_reviews)
select event_date, count(distinct order_id) filter (kind = 'order_created') as created,
  count(distinct order_id) filter (kind = 'order_approved') as approved,
  count(distinct order_id) filter (kind = 'order_shipped') as shipped,
  count(distinct order_id) filter (kind = 'order_delivered') as delivered,
  count(distinct order_id) filter (kind = 'order_reviewed') as reviewed
from steps group by event_date""",
    "mart_review_quality": f"""
select r.event_date, category, count(*) as reviews, {mean('review_score')} as avg_score,
  {pct('count(*) filter (review_score <= 2)', 'count(*)')} as low_score_pct,
  {pct('count(*) filter (review_response_hours <= 24)', 'count(*)')} as answered_in_sla_pct
from fact_reviews r join sold on sold.order_id = r.order_id group by r.event_date, category""",
    "mart_data_quality": """
select run_id, dataset_name, max(run_ts) as run_ts, sum(rows_in)::bigint as rows_in, sum(rows_out)::bigint as rows_out,
  sum(null_violations + duplicate_violations + schema_violations)::bigint as violations, bool_and(status = 'success') as passed
from fact_data_quality group by run_id, dataset_name""",
    "mart_category_performance": f"""
, sales as (
  select category, {month()} as month, {money('price')} as revenue, count(distinct order_id) as orders
  from sold group by category, {month()}),
scores as (
  select category, {month('sold.event_date')} as month, {mean('review_score')} as avg_score
  from sold join fact_reviews r on r.order_id = sold.order_id group by category, {month('sold.event_date')})
select category, month, revenue, orders, avg_score from sales left join scores using (category, month)""",
}
SQL["mart_refresh"] = SQL["mart_payment_mix"]
for _mart in ("daily_sales", "payment_mix", "delivery_sla", "order_funnel", "review_quality"):
    SQL[f"mart_{_mart}_refresh"] = SQL[f"mart_{_mart}"]
