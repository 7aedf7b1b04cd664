"""Statements for the event path: what the jobs must leave behind."""

from __future__ import annotations

from oracle.analytics import SQL as ANALYTICS
from oracle.values import BRANDS, CITIES, STATES

AS_OF = "timestamp '2001-12-05 00:00:00'"


def iso(ts: str) -> str:
    return f"replace({ts}::varchar, ' ', 'T')"


def ident(topic: str, kind: str, seq: str, ts: str) -> str:
    return f"sha256(concat_ws('|', '{topic}', '{kind}', order_id, {seq}, {ts}::varchar))"


def pick(values: list[str], key: str, salt: str) -> str:
    spelled = ", ".join(f"'{v}'" for v in values)
    return f"[{spelled}][1 + ('0x' || left(md5('{salt}|' || {key}), 8))::bigint % {len(values)}]"


EXTRA: dict[str, str] = {
    # The transactional tables.
    "t_orders": """
  select k, order_id, customer_id, case when k % 20 = 0 then 'canceled' when o_orderstatus = 'O' then 'created'
    when o_orderstatus = 'F' then 'delivered' else 'processing' end as order_status,
    purchase_ts, approved_ts, shipped_ts, deliv_ts, est_ts, delay_h from ord""",
    "t_rollup": """
  select order_id, count(*) as item_count, sum(price)::decimal(18,2) as order_value,
    arg_min(seller_id, order_item_id) as seller_id
  from fact_order_items group by order_id""",
    "t_full": "\n  select o.*, item_count, order_value, seller_id from t_orders o left join t_rollup using (order_id)",
    "t_products": """
  select 'P' || p_partkey as product_id, case when p_partkey % 50 <> 0 then p_type || '_' || p_brand end as cat, * from part""",
    # The events, one frame per kind.
    "e_created": f"""
  select purchase_ts as event_ts, 'order_created' as event_type, 'order_events' as topic, order_id, customer_id, seller_id, '' as seq,
    {ident('order_events', 'order_created', "''", 'purchase_ts')} as event_id, order_status, purchase_ts, approved_ts, est_ts,
    coalesce(order_value, 0) as order_value, coalesce(item_count, 0) as item_count
  from t_full""",
    "e_approved": f"""
  select approved_ts as event_ts, 'order_approved' as event_type, 'order_events' as topic, order_id, customer_id, seller_id, '' as seq,
    {ident('order_events', 'order_approved', "''", 'approved_ts')} as event_id, 'approved' as order_status, purchase_ts, approved_ts,
    coalesce(order_value, 0) as order_value, coalesce(item_count, 0) as item_count
  from t_full where approved_ts is not null""",
    "e_paid": f"""
  select coalesce(approved_ts, purchase_ts) as event_ts, 'payment_approved' as event_type, 'payment_events' as topic, order_id,
    o.customer_id, seller_id, payment_sequential::varchar as seq,
    {ident('payment_events', 'payment_approved', 'payment_sequential', 'coalesce(approved_ts, purchase_ts)')} as event_id,
    payment_sequential, payment_type, payment_installments, payment_value, 'approved' as payment_status
  from fact_payments p join t_full o using (order_id)""",
    "e_shipped": f"""
  select shipped_ts as event_ts, 'order_shipped' as event_type, 'delivery_events' as topic, order_id, customer_id, seller_id, '' as seq,
    {ident('delivery_events', 'order_shipped', "''", 'shipped_ts')} as event_id, 'shipped' as carrier_status, shipped_ts, deliv_ts,
    null::decimal(10,2) as delay
  from t_full where shipped_ts is not null""",
    "e_delivered": f"""
  select deliv_ts as event_ts, 'order_delivered' as event_type, 'delivery_events' as topic, order_id, customer_id, seller_id, '' as seq,
    {ident('delivery_events', 'order_delivered', "''", 'deliv_ts')} as event_id, 'delivered' as carrier_status, shipped_ts, deliv_ts,
    delay_h::decimal(10,2) as delay
  from t_full where deliv_ts is not null""",
    "e_reviewed": f"""
  select review_created_ts as event_ts, 'review_created' as event_type, 'review_events' as topic, order_id, o.customer_id,
    o.seller_id, review_id as seq, {ident('review_events', 'review_created', 'review_id', 'review_created_ts')} as event_id,
    review_id, review_score, review_created_ts, review_answer_ts, review_comment_title
  from fact_reviews r join t_full o using (order_id)""",
    "e_items": f"""
  select shipping_limit_date as event_ts, 'inventory_item_added' as event_type, 'inventory_events' as topic, order_id, o.customer_id,
    i.seller_id, order_item_id::varchar as seq,
    {ident('inventory_events', 'inventory_item_added', 'order_item_id', 'shipping_limit_date')} as event_id,
    order_item_id, product_id, price, freight_value
  from fact_order_items i join t_orders o using (order_id)""",
    "e_all": "\n  "
    + "\n  union all ".join(
        f"select event_ts, event_type, topic, order_id, customer_id, seller_id, seq, event_id from {e}"
        for e in ("e_created", "e_approved", "e_paid", "e_shipped", "e_delivered", "e_reviewed", "e_items")
    ),
    # The click messages, every 50th malformed.
    "clicks": """
  select *, case when event_id % 50 = 0 then (event_id // 50) % 7 end as flaw from events""",
    "verdicts": """
  select event_id as "offset", case flaw when 0 then 'null_message' when 1 then 'decode_error' when 2 then 'invalid_json'
    when 3 then 'envelope_not_object' when 4 then 'missing_required_fields: order_id,payload' when 5 then 'payload_not_object'
    when 6 then 'event_ts_not_iso8601' end as error_reason, event_type, ts
  from clicks""",
    # The warehouse the events load into.
    "w_events": f"""
  select event_id, order_id, event_type, customer_id, seller_id, order_status, purchase_ts, approved_ts,
    est_ts as estimated_delivery_ts, event_ts, event_ts::date as event_date, 'marketplace' as source_system,
    '1.0' as schema_version, {AS_OF} as ingestion_ts from e_created
  union all
  select event_id, order_id, event_type, customer_id, seller_id, order_status, purchase_ts, approved_ts, null, event_ts,
    event_ts::date, 'marketplace', '1.0', {AS_OF} from e_approved""",
    "w_payments": f"""
  select event_id, order_id, customer_id, payment_sequential, payment_type, payment_installments,
    payment_value::double as payment_value, payment_status, event_ts, event_ts::date as event_date,
    'marketplace' as source_system, '1.0' as schema_version, {AS_OF} as ingestion_ts from e_paid""",
    "w_deliveries": f"""
  select event_id, order_id, event_type, carrier_status, shipped_ts, deliv_ts as delivered_customer_ts,
    delay::double as delivery_delay_hours, seller_id, customer_id, event_ts, event_ts::date as event_date,
    'marketplace' as source_system, '1.0' as schema_version, {AS_OF} as ingestion_ts
  from (select * from e_shipped union all select * from e_delivered)""",
    "w_reviews": f"""
  select event_id, order_id, review_id, review_score, review_created_ts, review_answer_ts,
    round(date_diff('second', review_created_ts, review_answer_ts) / 3600.0, 2)::double as review_response_hours,
    review_comment_title, customer_id, seller_id, event_ts, event_ts::date as event_date, 'marketplace' as source_system,
    '1.0' as schema_version, {AS_OF} as ingestion_ts
  from e_reviewed""",
    "w_items": """
  select order_id, order_item_id, product_id, seller_id, event_ts as shipping_limit_date, price::double as price,
    freight_value::double as freight_value, event_ts::date as event_date from e_items""",
    "w_customers": f"""
  select customer_id, customer_unique_id, {pick(CITIES, 'customer_unique_id', 'city')} as customer_city,
    {pick(STATES, 'customer_unique_id', 'state')} as customer_state, null::varchar as customer_zip_prefix
  from dim_customer""",
    "w_products": """
  select product_id, case when length(cat) % 7 <> 0 then lower(cat) end as product_category_name from t_products""",
}

HEAD = "event_ts, event_type, topic, order_id, customer_id, seller_id, seq"
SQL: dict[str, str] = {
    "order_item_rollup": "select order_id, item_count, order_value::double as order_value, seller_id from t_rollup",
    "order_created_events": f"""
select {HEAD}, order_status, purchase_ts::varchar as purchase_ts, approved_ts::varchar as approved_ts,
  est_ts::varchar as estimated_delivery_ts, order_value::double as order_value, item_count::int as item_count from e_created""",
    "order_approved_events": f"""
select {HEAD}, order_status, purchase_ts::varchar as purchase_ts, approved_ts::varchar as approved_ts,
  order_value::double as order_value, item_count::int as item_count from e_approved""",
    "payment_approved_events": f"""
select {HEAD}, payment_sequential, payment_type, payment_installments, payment_value::double as payment_value, payment_status from e_paid""",
    "review_created_events": f"""
select {HEAD}, review_id, review_score, review_created_ts::varchar as review_created_ts,
  review_answer_ts::varchar as review_answer_ts, review_comment_title from e_reviewed""",
    "inventory_item_added_events": f"""
select {HEAD}, order_item_id, product_id, price::double as price, freight_value::double as freight_value,
  event_ts::varchar as shipping_limit_ts from e_items""",
    "event_timeline": f"select {HEAD} from e_all",
    "build_envelope": f"""
select topic, order_id as key, event_id, event_type, '1.0' as schema_version, {iso('event_ts')} as event_ts,
  {iso(AS_OF)} as ingestion_hint_ts, 'marketplace' as source_system,
  case topic when 'payment_events' then 'order_payments' when 'review_events' then 'order_reviews'
    when 'inventory_events' then 'order_items' else 'orders' end as source_table,
  sha256('trace|' || event_id) as trace_id, order_id, customer_id, seller_id
from e_all""",
    "customer_details_snapshot": f"""
select customer_id, customer_unique_id, {pick(STATES, 'customer_unique_id', 'state')} as state,
  {pick(CITIES, 'customer_unique_id', 'city')} as city, {AS_OF}::varchar as _generated_ts, '1.0' as _contract_version
from dim_customer""",
    "product_details_snapshot": f"""
select product_id, case when length(cat) % 7 <> 0 then lower(cat) end as product_category,
  {pick(BRANDS, 'product_id', 'brand')} as brand, {AS_OF}::varchar as _generated_ts, '1.0' as _contract_version
from t_products""",
    "bulk_dim_customer": """
select customer_id, customer_unique_id, customer_city, customer_state,
  left((1000000 + substr(customer_id, 2)::bigint * 7)::varchar, 5) as customer_zip_prefix from dim_customer""",
    "bulk_dim_seller": """
select seller_id, seller_city, seller_state, left((2000000 + substr(seller_id, 2)::bigint * 7)::varchar, 5) as seller_zip_prefix
from dim_seller""",
    "bulk_dim_product": """
select product_id, cat as product_category_name, length(p_name)::int as product_name_lenght,
  null::int as product_description_lenght, (p_partkey % 6)::int as product_photos_qty,
  case when p_partkey % 13 <> 0 then p_size * 10 end::int as product_weight_g, p_size as product_length_cm,
  p_size as product_height_cm, p_size as product_width_cm
from t_products""",
    "dim_date_build": "select * from dim_date",
    "micro_batch_read": """
select 'click_events' as topic, count(*) as events from verdicts where error_reason is null""",
    "enrich_with_source_metadata": """
select 'payment_events' as _kafka_topic, order_id as _kafka_key, '2001-12-05T00:00:00Z' as _kafka_ingest_ts,
  '2001-12-05T00:00:00Z' as _raw_file_ts, '1.0' as _contract_version, 2 * count(*) as lines
from e_paid group by order_id""",
    "group_sort_by_partition_offset": """
select count(*) as lines, 0::bigint as out_of_order from verdicts where error_reason is null""",
    "checkpoint_read": """
select topic, date_trunc('month', max(event_ts))::date as last_dt, 0::int as last_hour from e_all group by topic""",
    "raw_value_checks": """
, lines as (select order_value from e_created union all select order_value from e_approved)
select 2 * count(*) as lines, 0::bigint as negative_order_value, 0::bigint as unreadable_event_ts,
  0::bigint as other_major_version, 2 * count(*) filter (order_value = 0) as zero_order_value
from lines""",
    "append_facts_simple": "select event_id, payment_type, payment_value::double as payment_value from fact_payments",
    "validate_envelope": 'select "offset", error_reason from verdicts',
    "iso8601_check": "select event_id, event_id % 9 < 6 as valid from events",
    "partitioned_raw_sink": """
select 'E' || "offset" as event_id, 'web' as unknown_field_kept, "offset", '1.0' as contract, 'click_events' as topic, ts::date as dt,
  hour(ts)::int as hour
from verdicts where error_reason is null""",
    "dead_letter_route": """
select error_reason, "offset", 'click_events' as topic, date '2001-12-05' as dt, 0::int as hour
from verdicts where error_reason is not null""",
    "at_least_once_commit": """
select run, count(*) as lines from verdicts cross join (values ('first'), ('restarted')) as r(run)
where error_reason is null group by run""",
    "raw_lake_audit": """
select topic, 2 * count(*) as "rows", 0::bigint as rows_without_metadata from e_all group by topic""",
    "streaming_dedupe": "select topic, event_id, order_id, event_type from e_all",
    "message_schema_drift": """
select 'channel' as unknown_fields, 'ingestion_hint_ts,source_table,trace_id,customer_id,seller_id' as missing_fields,
  false as major_changed, count(*) as messages
from verdicts where error_reason is null""",
    "raw_json_scan": """
select topic, date_trunc('month', event_ts)::date as dt, 0::int as hour, 2 * count(*) as lines from e_all group by all""",
    "source_file_partition_extract": "select topic, 2 * count(*) as lines, 2 * count(*) as agreeing from e_all group by topic",
    "ingest_ts_resolve": """
select event_id, date_trunc('second', ts) + to_hours(case when event_id % 2 = 0 then 0 when event_id % 3 = 0 then 1 else 2 end) as ingest_ts
from events where event_id % 2 = 0 or event_id % 3 = 0 or event_id % 5 = 0""",
    "newer_partition_filter": """
select date_trunc('month', event_ts)::date as dt, 0::int as hour, 2 * count(*) as lines
from e_all where topic = 'order_events' and event_ts >= timestamp '1998-04-01' group by all""",
    "same_partition_unseen_files": """
select topic, date '1998-03-01' as dt, 0::int as hour, 2 * count(*) as lines
from e_all where topic = 'order_events' and date_trunc('month', event_ts) = timestamp '1998-03-01' group by topic""",
    "ingest_window_filter": "select event_id, ts from events where ts >= (select max(ts) from events) - to_hours(24)",
    "checkpoint_advance": """
select date_trunc('month', max(event_ts))::date as last_dt, 0::int as last_hour from e_all where topic = 'order_events'""",
    "dim_customer_build": "select * from w_customers",
    "dim_seller_build": """
select distinct seller_id, null::varchar as seller_city, null::varchar as seller_state, null::varchar as seller_zip_prefix from e_items""",
    "dim_product_build": "select product_id, product_category_name, null::int as product_weight_g from w_products",
    "fact_order_events_build": "select * from w_events",
    "fact_payments_build": "select * from w_payments",
    "fact_delivery_events_build": "select * from w_deliveries",
    "fact_reviews_build": "select * from w_reviews",
    "fact_order_items_build": "select * from w_items",
    "upsert_fact_order_events": "select * from w_events",
    "upsert_fact_payments": "select * from w_payments",
    "upsert_fact_delivery_events": "select * from w_deliveries",
    "upsert_fact_reviews": "select * from w_reviews",
    "upsert_fact_order_items": "select * from w_items",
    "upsert_dim_customer": f"select *, {AS_OF} as created_at from w_customers",
    "upsert_dim_seller": f"""
select distinct seller_id, null::varchar as seller_city, null::varchar as seller_state, null::varchar as seller_zip_prefix,
  {AS_OF} as created_at from e_items""",
    "upsert_dim_product": "select product_id, product_category_name, "
    + ", ".join(
        f"null::int as {c}"
        for c in (
            "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
            "product_height_cm", "product_width_cm",
        )
    )
    + f", {AS_OF} as created_at from w_products",
    "dimension_type1_update": """
select 'C' || c_custkey as customer_id,
  case when c_custkey % 3 = 0 and c_custkey % 5 = 0 then 'new city' when c_custkey % 4 = 0 then 'old city' end as customer_city,
  case when c_custkey % 3 = 0 then 'new' else 'old' end as customer_state,
  case when c_custkey % 2 = 0 then timestamp '2001-01-01' else timestamp '2001-01-02' end as created_at,
  case when c_custkey % 6 = 0 then timestamp '2001-01-02' end as updated_at
from customer where c_custkey % 2 = 0 or c_custkey % 3 = 0""",
    "idempotent_new_rows": "select event_id, order_id from fact_payments where payment_sequential = 2",
    "seller_backfill": """
select i.order_id, i.order_item_id, case when l.k % 3 <> 0 then i.seller_id else prim.seller_id end as seller_id
from fact_order_items i join ord l using (order_id) join prim on prim.l_orderkey = l.k""",
    "run_metrics": """
, sizes as (
  select case topic when 'order_events' then 'fact_order_events' when 'payment_events' then 'fact_payments'
    when 'delivery_events' then 'fact_delivery_events' when 'review_events' then 'fact_reviews' else 'fact_order_items' end as d,
    count(*) as n from e_all group by topic)
select d as dataset_name, 'success' as status, 2 * n as rows_in, n as rows_out, 0::bigint as null_violations,
  n as duplicate_violations, 0::bigint as schema_violations
from sizes""",
    "staging_events_clean": """
select event_id, topic, event_type, '1.0' as schema_version, 'marketplace' as source_system, order_id, customer_id, seller_id, event_ts
from e_all""",
    "loaded_star_revenue": """
select coalesce(product_category_name, 'Unknown') as category, count(distinct order_id) as orders,
  sum(i.price::decimal(18,2))::double as revenue, sum(i.freight_value::decimal(18,2))::double as freight
from w_items i join w_products using (product_id) group by category order by revenue desc, category limit 20""",
}
for _kind, _frame in (("order_shipped_events", "e_shipped"), ("order_delivered_events", "e_delivered")):
    SQL[_kind] = f"""
select {HEAD}, carrier_status, shipped_ts::varchar as shipped_ts, deliv_ts::varchar as delivered_customer_ts,
  delay::double as delivery_delay_hours from {_frame}"""


def bulk(kind: str, seq: str, ts: str) -> str:
    return f"""sha256(concat_ws('|', 'bulk', '{kind}', order_id, {seq})) as event_id, {ts} as event_ts, {ts}::date as event_date,
  'bulk' as source_system, '1.0' as schema_version, {AS_OF} as ingestion_ts"""


SQL["bulk_fact_order_events"] = f"""
select order_id, 'order_created' as event_type, customer_id, null::varchar as seller_id, order_status, purchase_ts,
  null::timestamp as approved_ts, null::timestamp as estimated_delivery_ts, {bulk('order_created', "''", 'purchase_ts')} from t_orders
union all
select order_id, 'order_approved', customer_id, null, 'approved', purchase_ts, approved_ts, null,
  {bulk('order_approved', "''", 'approved_ts')} from t_orders where approved_ts is not null"""
SQL["bulk_fact_payments"] = f"""
select order_id, payment_sequential, payment_type, coalesce(payment_installments, 1) as payment_installments,
  payment_value::double as payment_value, 'approved' as payment_status, o.customer_id,
  {bulk('payment', 'payment_sequential', 'coalesce(approved_ts, purchase_ts)')}
from fact_payments p join t_orders o using (order_id)"""
SQL["bulk_fact_delivery_events"] = f"""
select order_id, 'order_shipped' as event_type, 'shipped' as carrier_status, shipped_ts, null::timestamp as delivered_customer_ts,
  null::double as delivery_delay_hours, null::varchar as seller_id, customer_id, {bulk('order_shipped', "''", 'shipped_ts')}
from t_orders where shipped_ts is not null
union all
select order_id, 'order_delivered', 'delivered', shipped_ts, deliv_ts, delay_h::double, null, customer_id,
  {bulk('order_delivered', "''", 'deliv_ts')} from t_orders where deliv_ts is not null"""
SQL["bulk_fact_reviews"] = f"""
select review_id, order_id, greatest(1, least(5, review_score)) as review_score, review_created_ts, review_answer_ts,
  review_response_hours::double as review_response_hours, review_comment_title, customer_id, null::varchar as seller_id,
  {bulk('review', 'review_id', 'review_created_ts')}
from fact_reviews"""
SQL["bulk_fact_order_items"] = """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date, price::double as price,
  freight_value::double as freight_value, event_date from fact_order_items"""
SQL["full_reload"] = "\nunion all ".join(
    f"select '{n}' as table_name, count(*) as row_count from {src}"
    for n, src in (
        ("dim_date", "dim_date"),
        ("dim_customer", "dim_customer"),
        ("dim_seller", "dim_seller"),
        ("dim_product", "dim_product"),
        ("fact_order_events", "fact_order_events"),
        ("fact_payments", "fact_payments"),
        ("fact_delivery_events", "fact_delivery_events"),
        ("fact_reviews", "fact_reviews"),
        ("fact_order_items", "fact_order_items"),
    )
)


def filled(name: str, source: str, columns: str) -> str:
    cells = " + ".join(f"count({c})" for c in columns.split())
    return f"select '{name}' as table_name, count(*) as row_count, {cells} as filled_cells from {source}"


SQL["load_source_tables"] = "\nunion all ".join(
    filled(*t)
    for t in (
        ("orders", "t_orders", "order_id customer_id order_status purchase_ts approved_ts shipped_ts deliv_ts est_ts"),
        ("items", "fact_order_items", "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
        ("payments", "fact_payments", "order_id payment_sequential payment_type payment_installments payment_value"),
        ("reviews", "fact_reviews", "review_id order_id review_score review_comment_title review_created_ts review_answer_ts"),
        ("customers", "dim_customer", "customer_id customer_id customer_unique_id customer_city customer_state"),
        ("sellers", "dim_seller", "seller_id seller_id seller_city seller_state"),
        ("products", "t_products", "product_id cat p_name p_partkey p_size p_size p_size p_size"),
        ("translation", "(select distinct cat from t_products where length(cat) % 7 <> 0)", "cat cat"),
    )
)
# A load of events with values it must refuse; orders divisible by three come twice.
NUMBER = "substr(order_id, 2)::bigint"
SENT = f"""
, judged as (
  select 'order_events' as topic, 1 as place, {NUMBER} as k, customer_id, seller_id, null::varchar as product_id,
    case when k % 10 = 9 then 'missing_event_id' end as reason
  from (select order_id, customer_id, seller_id from e_created union all select order_id, customer_id, seller_id from e_approved)
  union all
  select 'payment_events', 2, {NUMBER} as k, customer_id, null, null,
    case when k % 10 = 1 and payment_value > 0 then 'negative_payment_value' when k % 10 = 2 then 'missing_payment_value' end from e_paid
  union all
  select 'delivery_events', 3, {NUMBER} as k, customer_id, seller_id, null, case when k % 10 = 8 then 'missing_order_id' end
  from (select * from e_shipped union all select * from e_delivered)
  union all
  select 'review_events', 4, {NUMBER} as k, customer_id, seller_id, null,
    case when k % 10 = 3 then 'review_score_out_of_range' when k % 10 = 4 then 'missing_review_score' end from e_reviewed
  union all
  select 'inventory_events', 5, {NUMBER} as k, null, seller_id, product_id,
    case when k % 10 = 5 and price > 0 then 'negative_price' when k % 10 = 6 and freight_value > 0 then 'negative_freight_value'
      when k % 10 = 7 then 'missing_product_id' end from e_items),
sent as (select * from judged union all select * from judged where k % 3 = 0)"""
SQL["load_quarantine"] = f"""{SENT}
select topic, reason as outcome, count(*) as "rows" from sent where reason is not null group by all
union all select topic, 'merged', count(*) from judged where reason is null group by topic
union all select topic, 'copy', count(*) from judged where reason is null and k % 3 = 0 group by topic"""
SQL["run_summary"] = f"""{SENT},
brought as (
  select 'c' || customer_id as id, min(place) as place from judged where reason is null and customer_id is not null group by 1
  union all select 's' || seller_id, min(place) from judged where reason is null and seller_id is not null group by 1
  union all select distinct 'p' || product_id, 5 from judged where reason is null and product_id is not null),
dims as (select place, count(*) as dim_written from brought group by place),
first as (
  select 1 as run, topic, place, count(*) as raw_count, count(*) filter (reason is not null) as set_aside,
    count(*) filter (reason is not null) > 0 as bad from sent group by topic, place),
merged as (select topic, count(*) as fact_written from judged where reason is null group by topic),
topics as (
  select run, topic, 1::bigint as processors_run, raw_count, coalesce(dim_written, 0) as dim_written, fact_written,
    raw_count - set_aside - fact_written as duplicates_skipped, set_aside, 0::bigint as no_new_data_processors,
    case when bad then 'failed' else 'success' end as status
  from first join merged using (topic) left join dims using (place)
  union all
  select 2, topic, 1, 0, 0, 0, 0, 0, 1, 'no_new_data' from first)
select * from topics
union all
select run, 'all', sum(processors_run)::bigint, sum(raw_count)::bigint, sum(dim_written)::bigint, sum(fact_written)::bigint,
  sum(duplicates_skipped)::bigint, sum(set_aside)::bigint, sum(no_new_data_processors)::bigint, null from topics group by run"""
SQL["upsert_late_older_event"] = f"""
select event_id, order_id, case when {NUMBER} % 3 = 0 then 'third' when {NUMBER} % 2 = 0 then 'second' else 'first' end as payment_status
from e_paid"""
SQL["validate_payload_types"] = f"""
, wrong(topic, remainder, field) as (values
  ('order_events', 1, 'payload.item_count'), ('order_events', 2, 'payload.order_value'), ('order_events', 3, 'payload.purchase_ts'),
  ('order_events', 4, 'trace_id'), ('payment_events', 1, 'payload.payment_value'), ('payment_events', 2, 'payload.payment_installments'),
  ('payment_events', 3, 'payload.payment_value'), ('payment_events', 4, 'payload.payment_type'),
  ('delivery_events', 1, 'payload.carrier_status'), ('delivery_events', 2, 'payload.shipped_ts'),
  ('review_events', 1, 'payload.review_score'), ('review_events', 2, 'payload.review_score'), ('review_events', 3, 'customer_id'),
  ('inventory_events', 1, 'payload.order_item_id'), ('inventory_events', 2, 'payload.price'))
select e.topic, event_id, 'wrong_type: ' || field as error_reason
from e_all e left join wrong w on w.topic = e.topic and w.remainder = {NUMBER} % 7"""
SQL["batch_runs"] = """
select topic, case topic when 'inventory_events' then order_id || '|' || seq else event_id end as key, event_ts::date as event_date from e_all"""
SQL["payload_schema_drift"] = f"""
, m as (select topic, event_type, {NUMBER} % 7 as r, order_id from e_all),
retyped(topic, r, field, kind) as (values
  ('order_events', 1, 'item_count', 'STRING'), ('order_events', 2, 'order_value', 'BOOLEAN'), ('order_events', 3, 'purchase_ts', 'BIGINT'),
  ('payment_events', 1, 'payment_value', 'STRING'), ('payment_events', 2, 'payment_installments', 'DECIMAL(2,1)'),
  ('payment_events', 4, 'payment_type', 'ARRAY<BIGINT>'), ('delivery_events', 1, 'carrier_status', 'BOOLEAN'),
  ('delivery_events', 2, 'shipped_ts', 'BIGINT'), ('review_events', 1, 'review_score', 'OBJECT<n: BIGINT>'),
  ('inventory_events', 1, 'order_item_id', 'STRING'), ('inventory_events', 2, 'price', 'STRING'))
select topic, field, 'retyped to ' || kind as drift, count(*) as messages from m join retyped using (topic, r) group by all
union all select topic, 'coupon', 'unknown', count(*) from m where r = 5 group by topic
union all select topic, 'review_key', 'unknown', count(*) from m where r = 6 and topic = 'review_events' group by topic
union all select topic, 'review_id', 'absent', count(*) from m where r = 6 and topic = 'review_events' group by topic
union all select topic, 'estimated_delivery_ts', 'absent', count(*) from m where event_type = 'order_approved' group by topic
"""
assert not set(SQL) & set(ANALYTICS)
