"""What a load and its batch runs read and keep."""

from __future__ import annotations

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tests.test_streaming import WRITTEN, land, message, publish
from tidemart.operators.bulk import bulk_fact_order_items
from tidemart.operators.merge import KeyedTable
from tidemart.sources import lake
from tidemart.sources.relational import derived_tables
from tidemart.streaming.batch_runs import BatchRuns
from tidemart.streaming.ingest import Load


def test_a_batch_is_not_kept_whole(spark, tmp_path, monkeypatch):
    publish(spark, tmp_path / "log", [message(n) for n in range(20)])
    land(spark, tmp_path / "log", tmp_path / "zone", spread=0)
    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    load = Load(spark, f"{tmp_path}/zone/raw", f"{tmp_path}/w", as_of=F.lit(WRITTEN).cast("timestamp_ntz"), buckets=2)
    load.run(("payment_events",))
    assert kept and all("payload" not in columns and "trace_id" not in columns for columns in kept)
    assert load.table("fact_payments").read().count() == 20


def test_batch_runs_count_a_file_once(spark, tmp_path, monkeypatch):
    publish(spark, tmp_path / "log", [message(n, event_ts=f"2024-02-{1 + n // 2:02}T05:00:00Z") for n in range(12)])
    land(spark, tmp_path / "log", tmp_path / "zone", spread=1)
    load = Load(spark, f"{tmp_path}/zone/raw", f"{tmp_path}/w", as_of=F.lit(WRITTEN).cast("timestamp_ntz"), buckets=2)
    runs, read = BatchRuns(load, f"{tmp_path}/progress", rows=4), []
    monkeypatch.setattr(BatchRuns, "_read", lambda self, topic, files, plain=BatchRuns._read: read.append(len(files)) or plain(self, topic, files))
    done = runs.until_done(("payment_events",))
    assert [r[0]["raw_count"] for r in done] == [4, 4, 4, 0]
    assert read == [6, 2, 2, 2]  # all files counted once, then each read by its run
    assert runs.counted("payment_events").count() == 6


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "k bigint, v string", buckets=1, rows_per_file=100)
    rows = lambda n, v: spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    for n, v in ((1000, "a"), (2000, "b")):
        table.merge(rows(n, v))
        files = table.held().groupBy(F.col("_metadata.file_path")).count().collect()
        assert max(r["count"] for r in files) <= 200  # ten or twenty hash pieces of about a hundred rows
        assert sorted(tuple(r) for r in table.read().collect()) == [(k, v) for k in range(n)]


def test_bulk_items_are_sent_to_their_order_once(spark, tmp_path):
    """Items are joined with their orders twice, on one key: the second join sends the orders alone."""
    day = "timestamp_ntz'2000-01-01'"
    tables = {
        "orders": f"select id as o_orderkey, id as o_custkey, 1.0D as o_totalprice, 'O' as o_orderstatus, {day} as o_orderdate from range(9)",
        "lineitem": "select id % 10 as l_orderkey, cast(id as int) as l_linenumber, id as l_partkey, id as l_suppkey, 1.0D as l_quantity, "
        "10.0D as l_extendedprice, 0.0D as l_discount, 0.0D as l_tax from range(30)",
        "customer": "select id as c_custkey, 'a' as c_mktsegment, id as c_nationkey from range(3)",
        "supplier": "select id as s_suppkey, id as s_nationkey from range(3)",
        "part": "select id as p_partkey, 'a' as p_name, 'b' as p_type, 'c' as p_brand, 1 as p_size from range(3)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, value in zip(names, ("-1", "-1", "false"), strict=True):
            spark.conf.set(n, value)
        items = bulk_fact_order_items(derived_tables(spark, str(tmp_path)))
        plan = items._jdf.queryExecution().executedPlan().toString()
        # one to find copies, one to the order, and two of the orders
        assert plan.count("Exchange hashpartitioning") == 4
        assert items.count() == 27  # order 9 is missing
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
