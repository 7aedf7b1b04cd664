"""A small random star schema with everything the fixture tables lack.

Several creations, deliveries, reviews and payments per order, a hot order,
customer and product, NULL keys and measures, and many ties.
"""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

START = datetime(2000, 11, 20)


def build(path: Path, seed: int = 7, orders: int = 320) -> None:
    r = random.Random(seed)
    maybe = lambda v, p=0.06: None if r.random() < p else v
    customers = [f"C{i}" for i in range(45)]
    sellers = [f"S{i}" for i in range(9)]
    products = [f"P{i}" for i in range(30)]
    hot = lambda values: values[0] if r.random() < 0.34 else r.choice(values)
    money = lambda top: Decimal(r.choice([0, 10, 50, 99, 100, 1000, r.randrange(100 * top)])) / 100
    at = lambda: START + timedelta(minutes=r.randrange(60 * 24 * 420))

    created, payments, deliveries, reviews, items = [], [], [], [], []

    def tail(ts):
        return {"event_ts": ts, "event_date": ts.date(), "source_system": "t", "schema_version": "1.0",
                "ingestion_ts": ts + timedelta(seconds=r.randrange(600))}

    for n in range(orders):
        order = f"O{n}"
        bought = at()
        copies = 25 if n == 0 else r.choice([1, 1, 1, 2])
        for c in range(copies):
            approved = maybe(bought + timedelta(hours=r.randrange(50)), 0.1)
            created.append({"event_id": f"c{n}-{c}", "order_id": order, "event_type": "order_created",
                            "customer_id": maybe(hot(customers)), "seller_id": maybe(r.choice(sellers)),
                            "order_status": r.choice(["created", "canceled", "delivered", None]), "purchase_ts": maybe(bought, 0.03),
                            "approved_ts": approved, "estimated_delivery_ts": maybe(bought + timedelta(days=r.randrange(4, 25))),
                            **tail(bought)})
            if approved:
                created.append({**created[-1], "event_id": f"a{n}-{c}", "event_type": "order_approved",
                                "order_status": "approved", **tail(approved)})
        for k in range(20 if n == 1 else r.randrange(4)):
            ts = bought + timedelta(hours=r.randrange(1200))
            payments.append({"event_id": f"p{n}-{k}", "order_id": order, "payment_sequential": k,
                             "payment_type": r.choice(["credit_card", "boleto", "voucher", "cash"]),
                             "payment_installments": maybe(r.choice([1, 1, 2, 3, 4, 7, 11])), "payment_value": money(900),
                             "payment_status": r.choice(["approved", "approved", "failed"]), "customer_id": maybe(r.choice(customers)),
                             **tail(ts)})
        for k in range(12 if n == 2 else r.randrange(3)):
            arrived = bought + timedelta(hours=r.randrange(-30, 900))
            deliveries.append({"event_id": f"d{n}-{k}", "order_id": order,
                               "event_type": r.choice(["order_delivered", "order_delivered", "order_shipped"]),
                               "carrier_status": "x", "shipped_ts": maybe(bought + timedelta(hours=40)),
                               "delivered_customer_ts": maybe(arrived),
                               "delivery_delay_hours": maybe(Decimal(r.choice([-48, -24, 0, 24, 48, r.randrange(-90, 90)]))),
                               "seller_id": maybe(hot(sellers)), "customer_id": maybe(hot(customers)), **tail(arrived)})
        for k in range(10 if n == 2 else r.randrange(3)):
            made = bought + timedelta(days=r.randrange(1, 60))
            reviews.append({"event_id": f"r{n}-{k}", "review_id": f"R{n}-{k}", "order_id": order, "review_score": r.randrange(1, 6),
                            "review_created_ts": made, "review_answer_ts": maybe(made),
                            "review_response_hours": maybe(Decimal(r.choice([0, 24, 48, 72, 100]))), "review_comment_title": None,
                            "customer_id": maybe(r.choice(customers)), "seller_id": maybe(r.choice(sellers)), **tail(made)})
        for k in range(40 if n == 2 else r.randrange(6)):
            items.append({"order_id": order, "order_item_id": k, "product_id": hot(products), "seller_id": maybe(hot(sellers)),
                          "shipping_limit_date": bought, "price": maybe(money(700)), "freight_value": maybe(money(120)),
                          "event_date": bought.date()})

    ts, d, s, i = pa.timestamp("us"), pa.date32(), pa.string(), pa.int32()
    dec, dec10, b, big = pa.decimal128(18, 2), pa.decimal128(10, 2), pa.bool_(), pa.int64()
    event_tail = [("event_ts", ts), ("event_date", d), ("source_system", s), ("schema_version", s), ("ingestion_ts", ts)]
    schemas = {
        "fact_order_events": [("event_id", s), ("order_id", s), ("event_type", s), ("customer_id", s), ("seller_id", s),
                              ("order_status", s), ("purchase_ts", ts), ("approved_ts", ts), ("estimated_delivery_ts", ts)] + event_tail,
        "fact_payments": [("event_id", s), ("order_id", s), ("payment_sequential", i), ("payment_type", s), ("payment_installments", i),
                          ("payment_value", dec), ("payment_status", s), ("customer_id", s)] + event_tail,
        "fact_delivery_events": [("event_id", s), ("order_id", s), ("event_type", s), ("carrier_status", s), ("shipped_ts", ts),
                                 ("delivered_customer_ts", ts), ("delivery_delay_hours", dec10), ("seller_id", s), ("customer_id", s)] + event_tail,
        "fact_reviews": [("event_id", s), ("review_id", s), ("order_id", s), ("review_score", i), ("review_created_ts", ts),
                         ("review_answer_ts", ts), ("review_response_hours", dec10), ("review_comment_title", s), ("customer_id", s),
                         ("seller_id", s)] + event_tail,
        "fact_order_items": [("order_id", s), ("order_item_id", i), ("product_id", s), ("seller_id", s), ("shipping_limit_date", ts),
                             ("price", dec), ("freight_value", dec), ("event_date", d)],
        "fact_data_quality": [("run_id", s), ("dataset_name", s), ("run_ts", ts), ("rows_in", big), ("rows_out", big),
                              ("null_violations", big), ("duplicate_violations", big), ("schema_violations", big), ("status", s)],
        "dim_customer": [("customer_id", s), ("customer_unique_id", s), ("customer_city", s), ("customer_state", s), ("customer_zip_prefix", s)],
        "dim_seller": [("seller_id", s), ("seller_city", s), ("seller_state", s), ("seller_zip_prefix", s)],
        "dim_product": [("product_id", s), ("product_category_name", s), ("product_length_cm", i)],
        "dim_payment_type": [("payment_type", s), ("is_digital", b), ("is_installment_supported", b)],
        "dim_event_type": [("event_type", s), ("domain", s), ("is_terminal_state", b)],
        "dim_date": [("date_key", i), ("full_date", d), ("day_of_week", i), ("day_name", s), ("day_of_month", i), ("week_of_year", i),
                     ("month", i), ("month_name", s), ("quarter", i), ("year", i), ("is_weekend", b), ("is_month_start", b), ("is_month_end", b)],
    }
    days = [date(2000, 11, 1) + timedelta(days=n) for n in range(600)]
    rows = {
        "fact_order_events": created,
        "fact_payments": payments,
        "fact_delivery_events": deliveries,
        "fact_reviews": reviews,
        "fact_order_items": items,
        "fact_data_quality": [
            {"run_id": f"run-{n}", "dataset_name": t, "run_ts": START + timedelta(days=n), "rows_in": n, "rows_out": n,
             "null_violations": r.randrange(2), "duplicate_violations": 0, "schema_violations": r.randrange(3),
             "status": r.choice(["success", "failed"])}
            for n in range(4) for t in ("fact_payments", "fact_reviews")
        ],
        # Two customers and one seller have no dimension row.
        "dim_customer": [{"customer_id": c, "customer_unique_id": c, "customer_city": f"city{n % 5}",
                          "customer_state": None if n % 11 == 3 else f"ST{n % 4}", "customer_zip_prefix": None}
                         for n, c in enumerate(customers[:-2])],
        "dim_seller": [{"seller_id": c, "seller_city": "x", "seller_state": f"ST{n % 3}", "seller_zip_prefix": None}
                       for n, c in enumerate(sellers[:-1])],
        "dim_product": [{"product_id": p, "product_category_name": None if n % 9 == 0 else f"cat{n % 6}", "product_length_cm": n}
                        for n, p in enumerate(products)],
        "dim_payment_type": [{"payment_type": p, "is_digital": True, "is_installment_supported": p == "credit_card"}
                             for p in ("credit_card", "boleto", "voucher")],
        "dim_event_type": [{"event_type": e, "domain": "order", "is_terminal_state": e == "order_canceled"}
                           for e in ("order_created", "order_approved", "order_canceled")],
        "dim_date": [{"date_key": x.year * 10000 + x.month * 100 + x.day, "full_date": x, "day_of_week": x.weekday(),
                      "day_name": x.strftime("%A"), "day_of_month": x.day, "week_of_year": int(x.strftime("%W")), "month": x.month,
                      "month_name": x.strftime("%B"), "quarter": (x.month + 2) // 3, "year": x.year, "is_weekend": x.weekday() > 4,
                      "is_month_start": x.day == 1, "is_month_end": (x + timedelta(days=1)).day == 1} for x in days],
    }
    for name, fields in schemas.items():
        table = pa.Table.from_pylist(rows[name], schema=pa.schema(fields))
        (path / name).mkdir(parents=True, exist_ok=True)
        pq.write_table(table, path / name / "part.parquet")
