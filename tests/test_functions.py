from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.functions import buckets as B
from tidemart.functions import columns as C
from tidemart.functions.quantiles import exact_quantiles

DOWN, UP = Decimal("-0.01"), Decimal("0.01")


@pytest.mark.parametrize(
    "steps,top,test",
    [
        (B.SPEND, B.SPEND_TOP, B.below),
        (B.FREIGHT, B.FREIGHT_TOP, B.below),
        (B.PRICE_SHORT, B.PRICE_SHORT_TOP, B.below),
        (B.FREIGHT_SHORT, B.FREIGHT_SHORT_TOP, B.below),
        (B.DELAY, B.DELAY_TOP, B.up_to),
        (B.RESPONSE, B.RESPONSE_TOP, B.up_to),
    ],
)
def test_bucket_edges(spark, steps, top, test):
    values = [Decimal(edge) + d for edge, _ in steps for d in (DOWN, Decimal(0), UP)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    got = dict(df.select("v", test(F.col("v"), steps, top)).collect())
    for v in values:
        if v is None:
            assert got[v] == top
            continue
        fits = (lambda e: v < e) if test is B.below else (lambda e: v <= e)
        assert got[v] == next((label for e, label in steps if fits(e)), top)


def test_null_label(spark):
    df = spark.createDataFrame([(None,), (Decimal(1),)], "v decimal(10,2)")
    got = dict(df.select("v", B.up_to(F.col("v"), B.DELAY, B.DELAY_TOP, "No data")).collect())
    assert got == {None: "No data", Decimal("1.00"): "1 day late"}


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [3.0] * 50,
        [-5.5, -0.01, 0.0, 0.01, 7.25, 1e6],
        [round(random.Random(3).lognormvariate(3, 2), 2) for _ in range(4000)],
        [round(random.Random(4).gauss(0, 90), 2) for _ in range(4000)] + [12.5] * 3000,
    ],
)
def test_quantiles_match_numpy(spark, values):
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, F.col("v"), probs).first()
    assert list(got) == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert list(exact_quantiles(df, F.col("v"), (0.5,)).first()) == [None]


def test_quantiles_of_one_crowded_slot(spark):
    """All values within one slot, some equal: steps tell them apart."""
    rng = random.Random(6)
    values = [1.0 + rng.random() * 1e-3 for _ in range(5000)] + [1.0005] * 700
    probs = (0.0, 0.01, 0.5, 0.5001, 0.999, 1.0)
    got = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), F.col("v"), probs).first()
    assert list(got) == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_counted_metrics_match_described_columns(spark):
    """Metrics of many rows, one row, NULL alone and no row at all, against one pass per column."""
    from tidemart.functions.quantiles import value_counts
    from tidemart.plans.statistics import describe, describe_counts

    rng = random.Random(2)
    rows = [("many", Decimal(rng.randint(-5000, 90000)).scaleb(-2)) for _ in range(900)]
    rows += [("many", None)] * 7 + [("one", Decimal("3.25")), ("unknown", None), ("zero", Decimal(0)), ("zero", Decimal(0))]
    df = spark.createDataFrame(rows, "metric string, v decimal(18,2)")
    names = ["many", "one", "unknown", "zero", "absent"]
    metrics = spark.createDataFrame([(m,) for m in names], "metric string")
    got = {r.metric: r for r in describe_counts(metrics, value_counts(df)).collect()}
    assert sorted(got) == sorted(names)
    for m in names:
        assert got[m] == describe(df.where(F.col("metric") == m), "v", m).first()


def test_week_of_year_starts_on_monday(spark):
    days = [date(2023, 1, 1), date(2023, 1, 2), date(2024, 1, 1), date(2024, 12, 31), date(2021, 1, 3), date(2021, 1, 4)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for d, week in df.select("d", C.monday_week_of_year("d")).collect():
        assert week == int(d.strftime("%W"))


def test_seconds_keep_microseconds_in_any_zone(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-03-10 01:30:00.000001' a, timestamp_ntz'2024-03-10 03:30:00.250000' b"
    )  # a clock change lies between the two in America/New_York
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(C.seconds_between("a", "b")).first()[0] == Decimal("7200.249999")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_means_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "v decimal(18,2)")
    row = df.agg(C.mean("v").alias("m"), C.total("v").alias("t"), C.share(F.col("v") > 0).alias("s")).first()
    assert (row.m, row.t, row.s) == (None, 0.0, None)


def test_outlier_rows_lie_beyond_the_fences(spark):
    from tidemart.plans.statistics import describe, outliers

    df = spark.createDataFrame([(Decimal(v),) for v in [10, 11, 12, 13, 14, 200, -90]], "v decimal(18,2)")
    assert sorted(r.v for r in outliers(df, "v", "x").collect()) == [Decimal("-90.00"), Decimal("200.00")]
    assert describe(df, "v", "x").first().median == 12.0


def test_correlation_of_a_constant_series_is_null(spark):
    from tidemart.plans.products import category_price_sensitivity
    from tidemart.sources.star import Star

    items = [(f"o{m}-{k}", 1, "p", Decimal(5), date(2020, m, 1)) for m in range(1, 8) for k in range(2)]
    frames = {
        "fact_order_items": spark.createDataFrame(
            items, "order_id string, order_item_id int, product_id string, price decimal(18,2), event_date date"
        ),
        "dim_product": spark.createDataFrame([("p", None)], "product_id string, product_category_name string"),
    }
    row = category_price_sensitivity(Star(spark, frames.__getitem__)).first()
    assert (row.category, row.price_volume_corr, row.mean_price, row.months) == ("Unknown", None, 5.0, 7)
