"""The shape of the plans: what must and must not be in them."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tidemart import jobs
from tidemart.registry import PLANS
from tidemart.sources import star as star_tables
from tidemart.sources.star import Star, write_bucketed_star, write_star
from tools.plans import plan_text, summary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return entry.star_of(spark, SF)


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    write_star(star, path)
    return Star.stored(spark, path)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_python_and_no_cross_product(spark, star, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shape = summary(PLANS[name](star))
        text = plan_text(PLANS[name](star))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert shape["python"] == 0
    assert "CartesianProduct" not in text
    if name != "event_type_vocabulary":  # its projected event types are constants, matched with seven rows
        assert shape["nested_loop"] == 0


def test_unused_seller_join_is_removed(star):
    text = plan_text(PLANS["order_event_funnel"](star))
    assert "lineitem" not in text
    assert "lineitem" in plan_text(PLANS["data_completeness"](star))


def test_scans_read_only_what_they_need(stored):
    text = plan_text(PLANS["payment_mix"](stored))
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {
        "payment_type", "payment_installments", "payment_value", "payment_status", "event_month"
    } - ({"event_month"} if "event_month" not in columns else set())
    assert "(payment_status#" in text and "= approved" in text


def test_stored_schema_gives_the_same_answers(star, stored):
    for name in ("category_revenue", "customer_rfm", "delivery_by_route", "stats_price"):
        assert sorted(map(str, PLANS[name](star).collect())) == sorted(map(str, PLANS[name](stored).collect()))


def test_kept_tables_are_projected_once(spark, star, tmp_path):
    spark.conf.set(entry.KEEP, str(tmp_path))
    try:
        query = entry.queries()["category_revenue"]
        first = sorted(map(str, query(spark, SF).collect()))
        assert "lineitem" not in plan_text(query(spark, SF))
        assert first == sorted(map(str, query(spark, SF).collect()))
        assert first == sorted(map(str, PLANS["category_revenue"](star).collect()))
        written = {p.name for p in next(tmp_path.iterdir()).iterdir()}
        assert written == {"fact_order_items", "dim_product"}  # only what was asked for
    finally:
        spark.conf.unset(entry.KEEP)


def test_bucketed_facts_join_without_a_shuffle(spark, star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bucketed"))
    write_bucketed_star(star, "tidemart_test", path, 8)
    bucketed = Star.bucketed(spark, "tidemart_test")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("review_low_score_causes", "whatif_late_delivery_revenue_loss", "customer_rfm", "kpi_avg_order_value"):
            assert "hashpartitioning(order_id" not in plan_text(PLANS[name](bucketed))
            assert "hashpartitioning(order_id" in plan_text(PLANS[name](star))
            same = lambda s: sorted(map(str, PLANS[name](s).collect()))
            assert same(bucketed) == same(star)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop database tidemart_test cascade")


def test_month_directories_are_pruned(stored):
    month = stored.spark.read.parquet(f"{stored.path}/fact_payments").where("event_month >= '1998-01'")
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", plan_text(month))


def test_windows_over_everything_see_only_summaries(star):
    """A window without a partition reads one row per month, slot or step."""
    for name in ("seller_concentration", "revenue_waterfall", "stats_price"):
        text = plan_text(PLANS[name](star))
        for part in re.split(r"\bWindow \[", text)[1:]:
            if "SinglePartition" in part.split("Exchange")[1][:40]:
                below = part[part.index("Exchange") :]
                assert re.search(r"HashAggregate|TakeOrderedAndProject|GlobalLimit", below)


def test_copies_collapse_before_the_shuffle(spark, star):
    """The operators that see many rows of one key combine on the map side."""
    from tidemart.operators.facts import latest_by

    newest = latest_by(star.fact_payments.select("order_id", "payment_type", "event_ts"), ["order_id"], ("event_ts",))
    for df, partial in (
        (newest, "partial_max_by"),
        (PLANS["duplicate_check"](star), "partial_count(1)"),
        (PLANS["seller_category_specialization"](star), "partial_min(struct"),
        (star.paid_by_order, "partial_sum"),
    ):
        text = plan_text(df)
        at = text.index(partial)
        assert "Exchange hashpartitioning" in text[:at]  # printed top down: the exchange is above


def test_a_mart_refresh_opens_only_its_months(stored):
    """Each dated fact of a mart is cut by its month folders; facts that bring no day are read whole."""
    from tidemart.operators import curated

    for name, facts in curated.DAY_OF.items():
        text = plan_text(getattr(curated, name)(stored.in_months(["2020-02", "2020-03"], *facts)))
        scans = re.findall(r"FileScan parquet .*?/(fact_\w+)\], PartitionFilters: \[(.*?)\], PushedFilters", text)
        assert facts and {fact for fact, filters in scans if "event_month" in filters} == set(facts), name
        assert all("event_month" in filters for fact, filters in scans if fact in facts)


def test_a_mart_refresh_stores_only_its_tables_and_once(spark, monkeypatch):
    stored, plain = [], star_tables.store_table
    monkeypatch.setattr(star_tables, "store_table", lambda name, *rest: stored.append(name) or plain(name, *rest))
    monkeypatch.setattr(jobs.Pipeline, "_known", {})
    for _ in range(2):
        assert jobs.JOBS["mart_payment_mix_refresh"](spark, SF).count()
    assert stored == ["fact_payments"]


@pytest.mark.parametrize("name", ["descriptive_stats_all", "iqr_outliers", "box_plot_summary"])
def test_metrics_share_one_scan_of_each_table(stored, name):
    df = PLANS[name](stored)
    assert len(df.collect()) == 5
    final = plan_text(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 4  # items, delivery, reviews, payments
    assert "SinglePartition" not in final
