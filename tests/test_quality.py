from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemart.operators import curated, quality
from tidemart.sources.star import Star

DAY = date(2000, 1, 1)
AT = datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def star(spark):
    frames = {
        "fact_payments": spark.createDataFrame(
            [("p1", "o1", "x", Decimal(-1), None, "c1"), ("p1", "o1", "x", Decimal(2), 1, "c9"), ("p2", "o1", None, None, 1, None)],
            "event_id string, order_id string, payment_type string, payment_value decimal(18,2), payment_installments int, customer_id string",
        ),
        "fact_order_items": spark.createDataFrame(
            [("o1", 1, "p1", "s1", None, Decimal(1)), ("o1", 2, "p9", None, Decimal(3), Decimal(-2))],
            "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), freight_value decimal(18,2)",
        ),
        "fact_reviews": spark.createDataFrame(
            [("r1", "R", "o1", 0, AT, AT, AT, "c1", None), ("r2", "R", "o1", 6, AT, AT, AT, "c1", "s1"), ("r3", "R", "o1", 5, AT, None, None, "c1", "s7")],
            "event_id string, review_id string, order_id string, review_score int, event_ts timestamp_ntz, review_created_ts timestamp_ntz, "
            "review_answer_ts timestamp_ntz, customer_id string, seller_id string",
        ),
        "fact_order_events": spark.createDataFrame(
            [
                ("e1", "o1", "order_created", AT, DAY, AT, datetime(1999, 1, 1), "c1", "s1"),
                ("e2", "o1", "teleported", datetime(2090, 1, 1), DAY, AT, None, "c1", "s1"),
                ("e3", "o1", "order_created", None, None, AT, None, None, None),
            ],
            "event_id string, order_id string, event_type string, event_ts timestamp_ntz, event_date date, purchase_ts timestamp_ntz, "
            "approved_ts timestamp_ntz, customer_id string, seller_id string",
        ),
        "fact_delivery_events": spark.createDataFrame(
            [("d1", "o1", "order_delivered", AT, datetime(2000, 2, 1), AT, "c1", "s1")],
            "event_id string, order_id string, event_type string, event_ts timestamp_ntz, shipped_ts timestamp_ntz, "
            "delivered_customer_ts timestamp_ntz, customer_id string, seller_id string",
        ),
        "dim_customer": spark.createDataFrame([("c1",)], "customer_id string"),
        "dim_seller": spark.createDataFrame([("s1",)], "seller_id string"),
        "dim_product": spark.createDataFrame([("p1",)], "product_id string"),
        "dim_event_type": spark.createDataFrame([("order_created",), ("order_delivered",)], "event_type string"),
    }
    return Star(spark, frames.__getitem__)


def rules(df):
    return {(r.table_name, r.rule): r.violations for r in df.collect()}


def test_missing(star):
    got = rules(quality.missing_critical_fields(star))
    assert got["fact_payments", "payment_value"] == 1 and got["fact_order_events", "event_ts"] == 1
    assert got["fact_order_items", "seller_id"] == 1 and got["fact_payments", "event_id"] == 0


def test_duplicates(star):
    got = {r.table_name: (r.total_rows, r.duplicates) for r in quality.duplicate_keys(star).collect()}
    assert got["fact_payments"] == (3, 1) and got["fact_order_items"] == (2, 0)


def test_amounts_allow_a_missing_price(star):
    got = rules(quality.invalid_amounts(star))
    assert got == {("fact_payments", "payment_value"): 1, ("fact_order_items", "price"): 0, ("fact_order_items", "freight_value"): 1}
    good, bad = quality.quarantine(star.fact_order_items, quality.valid_amount("price", "freight_value"))
    assert (good.count(), bad.count()) == (1, 1)


def test_scores(star):
    assert quality.review_score_range(star).first().violations == 2


def test_event_types(star):
    assert [(r.event_type, r.total_rows) for r in quality.event_type_vocabulary(star).collect()] == [("teleported", 1)]
    assert rules(quality.event_type_enum(star))["fact_order_events", "event_type"] == 1


def test_times(star):
    got = rules(quality.timestamp_anomalies(star))
    assert got["fact_order_events", "future_event_ts"] == 1 and got["fact_order_events", "missing_event_ts"] == 1
    assert got["fact_order_events", "approved_before_purchase"] == 1
    assert got["fact_delivery_events", "delivered_before_shipped"] == 1


def test_orphans(star):
    got = {(r.table_name, r.key_name): r.orphan_rows for r in quality.referential_integrity(star).collect()}
    assert got["fact_payments", "customer_id"] == 1 and got["fact_order_items", "product_id"] == 1
    assert got["fact_reviews", "seller_id"] == 1 and got["fact_order_events", "seller_id"] == 0


def test_run_record(star):
    got = {r.dataset_name: r for r in quality.quality_run(star).collect()}
    p = got["fact_payments"]
    assert (p.rows_in, p.rows_out, p.null_violations, p.duplicate_violations, p.schema_violations) == (3, 1, 1, 1, 1)
    assert p.status == "failed"


def test_mart_refresh_touches_only_its_months(spark, tmp_path):
    def star_of(value):
        rows = [(f"p{m}", "o", "boleto", 1, Decimal(value), "approved", date(2020, m, 3)) for m in (1, 2)]
        df = spark.createDataFrame(
            rows,
            "event_id string, order_id string, payment_type string, payment_installments int, payment_value decimal(18,2), "
            "payment_status string, event_date date",
        )
        return Star(spark, {"fact_payments": df}.__getitem__)

    path = str(tmp_path / "mart")
    curated.write_mart(curated.mart_payment_mix(star_of(1)), path)
    curated.refresh_mart(star_of(5), curated.mart_payment_mix, path, ["2020-02"])
    got = {r.event_month: r.total_value for r in spark.read.parquet(path).collect()}
    assert got == {"2020-01": 1.0, "2020-02": 5.0}


def test_mart_refresh_empties_a_month(spark, tmp_path):
    def star_of(*months):
        rows = [(f"p{m}", "o", "boleto", 1, Decimal(1), "approved", date(2020, m, 3)) for m in months]
        df = spark.createDataFrame(
            rows,
            "event_id string, order_id string, payment_type string, payment_installments int, payment_value decimal(18,2), "
            "payment_status string, event_date date",
        )
        return Star(spark, {"fact_payments": df}.__getitem__)

    path = str(tmp_path / "mart")
    curated.write_mart(curated.mart_payment_mix(star_of(1, 2, 3)), path)
    curated.refresh_mart(star_of(1, 3), curated.mart_payment_mix, path, ["2020-02", "2020-03"])
    assert sorted(r.event_month for r in spark.read.parquet(path).collect()) == ["2020-01", "2020-03"]
