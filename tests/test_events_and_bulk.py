from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators import bulk, snapshots, timeline
from tidemart.schemas import RELATIONAL
from tidemart.sources.relational import read_csv_tables

T = datetime.fromisoformat
NOW = "2020-06-01 00:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    rows = {
        "orders": [
            ("o1", "c1", "delivered", T("2020-01-01T10:00"), T("2020-01-01T11:00"), T("2020-01-03"), T("2020-01-09T12:00"), T("2020-01-10")),
            ("o2", "c2", None, T("2020-01-02"), None, None, None, None),
            ("o3", "c1", "created", None, None, None, T("2020-02-01"), None),
        ],
        "items": [
            ("o1", 2, "p1", "s2", T("2020-01-05"), Decimal("10.00"), Decimal("1.50")),
            ("o1", 1, "p2", "s1", T("2020-01-05"), Decimal("5.25"), None),
            ("o9", 1, "p3", "s1", None, None, None),
        ],
        "payments": [
            ("o1", 1, "boleto", 1, Decimal("15.25")),
            ("o2", 1, "voucher", None, Decimal("3.00")),
            ("o3", 1, "voucher", 1, Decimal("3.00")),
            ("o8", 1, "voucher", 1, Decimal("3.00")),
        ],
        "reviews": [
            ("r1", "o1", 9, "fine", T("2020-01-10"), T("2020-01-10T06:30")),
            ("r2", "o2", None, None, T("2020-01-11"), None),
            ("r3", "o2", 0, None, None, None),
        ],
        "customers": [("c1", "u1", "0123456", "x", "SP"), ("c1", "u0", "0999999", "a", "RJ"), ("c2", "u1", None, None, None)],
        "sellers": [("s1", "1234567", "x", "SP")],
        "products": [("p1", "cama", "12", "x", "1", "12.0", None, "3", "4"), ("p2", None, None, None, None, None, None, None, None)],
        "translation": [("cama", "bed")],
    }
    return {name: spark.createDataFrame(r, RELATIONAL[name]) for name, r in rows.items()}


def only(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_rollup_takes_the_first_item_by_number(tables):
    row = only(timeline.order_item_rollup(tables["items"]), "order_id")["o1"]
    assert (row.item_count, row.order_value, row.seller_id) == (2, Decimal("15.25"), "s1")


def test_created(tables):
    got = only(timeline.order_created_events(tables), "order_id")
    assert set(got) == {"o1", "o2"}
    assert got["o2"].payload.order_status == "created"
    assert (got["o2"].payload.order_value, got["o2"].payload.item_count, got["o2"].seller_id) == (Decimal("0.00"), 0, None)


def test_payments_fall_back_to_the_purchase(tables):
    got = only(timeline.payment_approved_events(tables), "order_id")
    assert set(got) == {"o1", "o2"}  # o3 has no time, o8 no order
    assert got["o2"].event_ts == T("2020-01-02T00:00")


def test_deliveries(tables):
    got = only(timeline.order_delivered_events(tables), "order_id")
    assert got["o1"].payload.delivery_delay_hours == Decimal("-12.00")
    assert got["o3"].payload.delivery_delay_hours is None
    assert set(only(timeline.order_shipped_events(tables), "order_id")) == {"o1"}


def test_items_keep_their_own_seller(tables):
    got = only(timeline.inventory_item_added_events(tables), "seq")
    assert {k: r.seller_id for k, r in got.items()} == {"1": "s1", "2": "s2"}


def test_reviews(tables):
    assert set(only(timeline.review_created_events(tables), "seq")) == {"r1", "r2"}


def test_envelope_repeats_its_ids(spark, tables):
    now = F.lit(NOW).cast("timestamp_ntz")
    one = sorted(r.value for r in timeline.all_envelopes(tables, now).collect())
    two = sorted(r.value for r in timeline.all_envelopes(tables, now).collect())
    assert one == two
    parsed = timeline.all_envelopes(tables, now).select(
        "topic", F.get_json_object("value", "$.event_id").alias("id"), F.get_json_object("value", "$.source_table").alias("t"), "key"
    )
    assert parsed.select("id").distinct().count() == parsed.count() == len(one)
    assert {(r.topic, r.t) for r in parsed.collect()} >= {("payment_events", "order_payments"), ("inventory_events", "order_items")}


def test_snapshots_depend_on_the_key_only(spark, tables, tmp_path):
    now = F.lit(NOW).cast("timestamp_ntz")
    details = snapshots.customer_details(tables["customers"], now)
    by_unique = {}
    for r in details.collect():
        by_unique.setdefault(r.customer_unique_id, set()).add((r.state, r.city))
    assert all(len(v) == 1 for v in by_unique.values())
    products = snapshots.product_details(tables["products"], tables["translation"], now)
    assert {r.product_id: r.product_category for r in products.collect()} == {"p1": "bed", "p2": None}
    for _ in range(2):
        snapshots.write_snapshot(products, str(tmp_path), "product_details", "2020-06-01")
    assert snapshots.read_latest(spark, str(tmp_path), "product_details").count() == 2
    assert spark.read.json(f"{tmp_path}/product_details/dt=2020-06-01/product_details.jsonl").count() == 2


def test_bulk(tables):
    now = F.lit(NOW).cast("timestamp_ntz")
    reviews = only(bulk.bulk_fact_reviews(tables, now), "review_id")
    assert {k: r.review_score for k, r in reviews.items()} == {"r1": 5, "r2": 3}
    assert reviews["r1"].review_response_hours == Decimal("6.50")
    payments = only(bulk.bulk_fact_payments(tables, now), "order_id")
    assert payments["o2"].payment_installments == 1 and set(payments) == {"o1", "o2"}
    shipped = only(bulk.bulk_fact_delivery_events(tables, now), "order_id", "event_type")
    assert shipped["o1", "order_shipped"].delivered_customer_ts is None
    events = only(bulk.bulk_fact_order_events(tables, now), "order_id", "event_type")
    assert events["o1", "order_created"].approved_ts is None and events["o1", "order_approved"].approved_ts is not None
    customers = only(bulk.bulk_dim_customer(tables), "customer_id")
    assert len(customers) == 2 and customers["c1"].customer_zip_prefix in ("01234", "09999")
    products = only(bulk.bulk_dim_product(tables), "product_id")
    assert (products["p1"].product_weight_g, products["p1"].product_description_lenght) == (12, None)
    items = only(bulk.bulk_fact_order_items(tables), "order_id", "order_item_id")
    assert items["o9", 1].event_date is None


def test_calendar(spark, tables):
    days = only(bulk.dim_date_build(tables), "date_key")
    assert set(days) == {20200101, 20200102, 20200109, 20200110, 20200201}
    dense = only(bulk.dense_calendar(spark, "2020-02-27", "2020-03-01"), "date_key")
    assert [k for k, r in sorted(dense.items()) if r.is_month_end] == [20200229]
    assert dense[20200301].is_month_start and dense[20200229].day_name == "Saturday" and dense[20200229].is_weekend


def test_csv(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        '"o1","c1",created,2017-10-02 10:56:33,,bad,2017-10-10 21:25:13,2017-10-18 00:00:00\n'
    )
    (tmp_path / "reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_creation_date,review_answer_timestamp\n"
        'r1,o1,4,"two ""quoted""\nlines, one title",2018-01-18 00:00:00,\n'
    )
    got = read_csv_tables(spark, {"orders": f"{tmp_path}/orders.csv", "reviews": f"{tmp_path}/reviews.csv"})
    row = got["orders"].first()
    assert row.order_purchase_timestamp == T("2017-10-02T10:56:33") and row.order_approved_at is None
    assert row.order_delivered_carrier_date is None
    review = got["reviews"].first()
    assert review.review_comment_title == 'two "quoted"\nlines, one title' and review.review_score == 4
