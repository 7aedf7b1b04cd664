"""The star schema as DuckDB common table expressions over the given tables."""

from __future__ import annotations

import re


def hours(ts: str, n: str) -> str:
    return f"({ts} + to_hours(cast({n} as int)))"


def secs(ts: str, n: str) -> str:
    return f"({ts} + to_seconds(cast({n} as int)))"


WD = "cast(isodow(d) - 1 as int)"
BUY = "(o_orderkey * 37) % 24"
PROMISE = f"{BUY} + 24 * (10 + o_orderkey % 15)"
LATE = "(o_orderkey * 131) % 241 - 168"
TAIL = "'fixture' as source_system, '1.0' as schema_version"

TABLES: dict[str, str] = {
    "items_raw": """
  select * from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "ord": f"""
  select o_orderkey as k, 'O' || o_orderkey as order_id, 'C' || o_custkey as customer_id, o_totalprice, o_orderstatus,
    {hours('o_orderdate', BUY)} as purchase_ts,
    case when o_orderkey % 20 <> 0 then {hours('o_orderdate', BUY + ' + 1 + o_orderkey % 47')} end as approved_ts,
    {hours('o_orderdate', PROMISE)} as est_ts,
    case when o_orderkey % 20 <> 0 then {hours('o_orderdate', BUY + ' + 48 + o_orderkey % 30')} end as shipped_ts,
    case when o_orderkey % 10 not in (0, 1) then {hours('o_orderdate', PROMISE + ' + ' + LATE)} end as deliv_ts,
    {LATE} as delay_h
  from orders""",
    "prim": """
  select l_orderkey, 'S' || l_suppkey as seller_id from items_raw
  qualify row_number() over (partition by l_orderkey order by l_linenumber) = 1""",
    "dim_customer": """
  select 'C' || c_custkey as customer_id, 'U' || (c_custkey % 1000) as customer_unique_id,
    c_mktsegment as customer_city, 'ST' || c_nationkey as customer_state, cast(null as varchar) as customer_zip_prefix
  from customer""",
    "dim_seller": """
  select 'S' || s_suppkey as seller_id, 'CITY' || (s_suppkey % 7) as seller_city, 'ST' || s_nationkey as seller_state,
    cast(null as varchar) as seller_zip_prefix
  from supplier""",
    "dim_product": """
  select 'P' || p_partkey as product_id,
    case when p_partkey % 50 <> 0 then p_type || '_' || p_brand end as product_category_name,
    p_size as product_length_cm
  from part""",
    "dim_payment_type": """
  select * from (values ('credit_card', true, true), ('debit_card', true, false), ('voucher', true, false),
    ('boleto', false, false)) as t(payment_type, is_digital, is_installment_supported)""",
    "dim_event_type": """
  select * from (values ('order_created', 'order', false), ('order_approved', 'order', false),
    ('order_canceled', 'order', true), ('order_delivered', 'delivery', true), ('payment_approved', 'payment', false),
    ('payment_failed', 'payment', true), ('review_submitted', 'review', true)) as t(event_type, domain, is_terminal_state)""",
    "dim_date": f"""
  select cast(year(d) * 10000 + month(d) * 100 + day(d) as int) as date_key, d as full_date, {WD} as day_of_week,
    dayname(d) as day_name, cast(day(d) as int) as day_of_month, cast(strftime(d, '%W') as int) as week_of_year,
    cast(month(d) as int) as month, monthname(d) as month_name, cast(quarter(d) as int) as quarter,
    cast(year(d) as int) as year, {WD} >= 5 as is_weekend, day(d) = 1 as is_month_start, last_day(d) = d as is_month_end
  from (select distinct unnest([purchase_ts, approved_ts, deliv_ts, est_ts])::date as d from ord) where d is not null""",
    "fact_order_events": f"""
  select event_id, order_id, event_type, event_ts, event_ts::date as event_date, customer_id, seller_id, order_status,
    purchase_ts, approved_ts, estimated_delivery_ts, {TAIL}, {secs('event_ts', '5 + k % 120')} as ingestion_ts
  from (
    select 'oc-' || order_id as event_id, order_id, 'order_created' as event_type, purchase_ts as event_ts, customer_id,
      seller_id, case when k % 20 = 0 then 'canceled' when o_orderstatus = 'O' then 'created'
        when o_orderstatus = 'F' then 'delivered' else 'processing' end as order_status,
      purchase_ts, approved_ts, est_ts as estimated_delivery_ts, k
    from ord left join prim on l_orderkey = k
    union all
    select 'oa-' || order_id, order_id, 'order_approved', approved_ts, customer_id, seller_id, 'approved', purchase_ts,
      approved_ts, null, k
    from ord left join prim on l_orderkey = k where approved_ts is not null)""",
    "fact_payments": f"""
  select 'pp-' || order_id || '-' || s as event_id, order_id, cast(s as int) as payment_sequential,
    case (k + s) % 4 when 0 then 'credit_card' when 1 then 'boleto' when 2 then 'voucher' else 'debit_card' end as payment_type,
    cast(case when k % 97 = 0 then null when (k + s) % 4 = 0 then 1 + k % 12 else 1 end as int) as payment_installments,
    cast(cast(floor(o_totalprice / 10) as bigint) * 0.01
      * (case when k % 5 <> 0 then 1.0 when s = 1 then 0.8 else 0.2 end) as decimal(18,2)) as payment_value,
    case when k % 23 = 0 then 'failed' else 'approved' end as payment_status,
    coalesce(approved_ts, purchase_ts) as event_ts, coalesce(approved_ts, purchase_ts)::date as event_date, customer_id,
    {TAIL}, {secs('coalesce(approved_ts, purchase_ts)', '5 + k % 120')} as ingestion_ts
  from ord cross join (values (1), (2)) as q(s) where s = 1 or k % 5 = 0""",
    "fact_delivery_events": f"""
  select event_id, order_id, event_type, carrier_status, shipped_ts, delivered_customer_ts, delivery_delay_hours, event_ts,
    event_ts::date as event_date, seller_id, customer_id, {TAIL}, {secs('event_ts', '5 + k % 120')} as ingestion_ts
  from (
    select 'ds-' || order_id as event_id, order_id, 'order_shipped' as event_type, 'shipped' as carrier_status, shipped_ts,
      deliv_ts as delivered_customer_ts, cast(null as decimal(10,2)) as delivery_delay_hours, shipped_ts as event_ts,
      seller_id, customer_id, k
    from ord left join prim on l_orderkey = k where shipped_ts is not null
    union all
    select 'dd-' || order_id, order_id, 'order_delivered', 'delivered', shipped_ts, deliv_ts,
      case when k % 101 <> 0 then cast(delay_h as decimal(10,2)) end, deliv_ts, seller_id, customer_id, k
    from ord left join prim on l_orderkey = k where deliv_ts is not null)""",
    "fact_reviews": f"""
  select 'rv-' || order_id as event_id, 'R' || k as review_id, order_id,
    cast(1 + (k * 13 + case when delay_h > 0 then 2 else 0 end) % 5 as int) as review_score,
    {hours('deliv_ts', 'k % 72')} as review_created_ts,
    case when k % 7 <> 0 then {hours('deliv_ts', 'k % 72 + k % 96')} end as review_answer_ts,
    case when k % 7 <> 0 then cast(k % 96 as decimal(10,2)) end as review_response_hours,
    case when k % 3 = 0 then 'title ' || (k % 11) end as review_comment_title,
    {hours('deliv_ts', 'k % 72')} as event_ts, {hours('deliv_ts', 'k % 72')}::date as event_date, customer_id, seller_id,
    {TAIL}, {secs('deliv_ts', '3600 * (k % 72) + 5 + k % 120')} as ingestion_ts
  from ord left join prim on l_orderkey = k where deliv_ts is not null and k % 4 <> 0""",
    "fact_order_items": f"""
  select 'O' || l_orderkey as order_id, l_linenumber as order_item_id, 'P' || l_partkey as product_id,
    'S' || l_suppkey as seller_id, {hours('purchase_ts', '72')} as shipping_limit_date,
    cast(cast(floor(l_extendedprice) as bigint) * 0.01 as decimal(18,2)) as price,
    cast(cast(floor(l_quantity * (100 + 2000 * l_tax)) as bigint) * 0.01 as decimal(18,2)) as freight_value,
    purchase_ts::date as event_date
  from items_raw join ord on k = l_orderkey""",
    "fact_data_quality": f"""
  select 'run-' || r as run_id, dataset_name, {secs("timestamp '2001-12-01 00:00:00'", '86400 * r')} as run_ts,
    n as rows_in, n - bad as rows_out, bad as null_violations, 0::bigint as duplicate_violations,
    0::bigint as schema_violations, case when bad > 0 and r = 2 then 'failed' else 'success' end as status
  from (
    select 'fact_order_events' as dataset_name, count(*) as n, count(*) - count(seller_id) as bad from fact_order_events
    union all select 'fact_payments', count(*), count(*) - count(payment_installments) from fact_payments
    union all select 'fact_order_items', count(*), count(*) - count(price) from fact_order_items)
  cross join (values (1), (2), (3)) as runs(r)""",
    # ---- row subsets shared by the statements -----------------------------------
    "made": "\n  select * from fact_order_events where event_type = 'order_created'",
    "paid": "\n  select * from fact_payments where payment_status = 'approved'",
    "arrived": "\n  select * from fact_delivery_events where event_type = 'order_delivered'",
    "timed": "\n  select * from arrived where delivery_delay_hours is not null",
    "made_paid": "\n  select made.*, payment_value from made left join paid using (order_id)",
    "sold": """
  select i.*, coalesce(product_category_name, 'Unknown') as category, product_category_name
  from fact_order_items i join dim_product using (product_id)""",
    "newest_made": "\n  select max(event_date) as d from made",
    "trips": """
  select a.event_id, a.order_id, a.event_date, a.seller_id, a.shipped_ts, a.delivered_customer_ts as got_ts, m.purchase_ts,
    m.approved_ts, m.estimated_delivery_ts as due_ts
  from arrived a join made m using (order_id) where a.delivered_customer_ts is not null""",
}


SUBSETS = ("made", "paid", "arrived", "timed", "made_paid", "sold", "newest_made", "trips")


def over_stored(body: str) -> str:
    """``body`` over a star schema that exists as tables."""
    return with_tables(body, known={name: TABLES[name] for name in SUBSETS})


def with_tables(body: str, extra: dict[str, str] | None = None, known: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the tables it names, in dependency order."""
    known = {**TABLES, **(extra or {})} if known is None else known
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(known[name])

    visit(body)
    ctes = [f"{name} as ({known[name]})" for name in known if name in needed]
    body = body.strip()
    if ctes:
        return "with " + ",\n".join(ctes) + "\n" + body
    return "with " + body[1:] if body.startswith(",") else body
