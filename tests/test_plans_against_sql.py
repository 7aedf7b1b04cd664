"""Every star query against its SQL, over a messy random star schema."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__  # noqa: F401  (registers the plans)
from oracle import analytics, quality
from oracle.star import over_stored
from tests import messy_star
from tidemart.registry import PLANS
from tidemart.sources.star import DIMS, FACTS, Star
from tools.check import ordered

SQL = {**analytics.SQL, **quality.SQL}


@pytest.fixture(scope="module")
def engines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("messy")
    messy_star.build(path)
    star = Star(spark, lambda name: spark.read.parquet(f"{path}/{name}"))
    con = duckdb.connect()
    for name in DIMS + FACTS:
        con.execute(f"create view {name} as select * from read_parquet('{path}/{name}/*.parquet')")
    return star, con


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


@pytest.mark.parametrize("name", sorted(set(PLANS) & set(SQL)))
def test_same_rows(engines, name):
    star, con = engines
    df = PLANS[name](star)
    got, columns = ordered([tuple(r) for r in df.collect()], df.columns)
    rel = con.sql(over_stored(SQL[name]))
    want, want_columns = ordered(rel.fetchall(), rel.columns)
    assert columns == want_columns
    assert len(got) == len(want)
    assert [(g, w) for g, w in zip(got, want) if not all(close(a, b) for a, b in zip(g, w))] == []


def test_wide_heat_map_agrees_with_the_long_form(engines):
    from tidemart.plans.dashboard import heatmap_pivot, heatmap_pivot_top15

    star, _ = engines
    long = {(r.category, str(r.month)): r.revenue for r in heatmap_pivot_top15(star).collect()}
    wide = heatmap_pivot(star)
    cells = {(r["category"], c): r[c] for r in wide.collect() for c in wide.columns if c != "category"}
    assert cells == long


@pytest.mark.parametrize(
    "bucketed,column,whole",
    [
        ("delivery_sla_distribution", "deliveries", "select count(*) from arrived"),
        ("product_price_distribution", "items", "select count(*) from fact_order_items"),
        ("customer_clv_distribution", "customers", "select count(distinct coalesce(customer_id, '')) from made"),
        ("review_response_time", "cnt", "select count(*) from fact_reviews"),
    ],
)
def test_buckets_add_up(engines, bucketed, column, whole):
    star, con = engines
    assert sum(r[column] for r in PLANS[bucketed](star).collect()) == con.sql(over_stored(whole)).fetchall()[0][0]
