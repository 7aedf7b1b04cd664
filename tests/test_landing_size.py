"""What the landing of large logs keeps and writes."""

from __future__ import annotations

import json
import os

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tests.test_streaming import land, message, publish
from tidemart import jobs
from tidemart.jobs import JOBS, Pipeline
from tidemart.schemas import ENVELOPE


def test_rows_are_landed_where_they_were_read(spark, tmp_path, monkeypatch):
    log = tmp_path / "log"
    publish(spark, log, [message(n) if n % 4 else message(n, payload=3) for n in range(40)])
    land(spark, log, tmp_path / "dealt", spread=2)
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df) or df)
    land(spark, log, tmp_path / "placed", spread=0)
    assert not kept  # a log of any size is held nowhere beside its files
    for part in ("raw", "raw_dead_letter"):
        read = lambda name: sorted(tuple(r) for r in spark.read.text(f"{tmp_path}/{name}/{part}").select("value", "topic", "dt", "hour").collect())
        assert read("placed") == read("dealt") and read("placed")
    names = [f.name for f in (tmp_path / "placed" / "raw").rglob("part-*")]
    assert names and all(n.endswith(".gz") for n in names)
    places = spark.read.text(f"{tmp_path}/placed/raw").select("_metadata.file_path", F.monotonically_increasing_id().alias("n"), "value").collect()
    at: dict[str, list] = {}
    for r in sorted(places, key=lambda r: r.n):
        line = json.loads(r.value)
        at.setdefault(r.file_path, []).append((line["_kafka_partition"], line["_kafka_offset"]))
    assert all(found == sorted(found) for found in at.values())


def test_a_log_without_dead_letters_and_one_of_them_alone(spark, tmp_path):
    publish(spark, tmp_path / "good", [message(n) for n in range(5)])
    publish(spark, tmp_path / "bad", [message(n, payload=3) for n in range(5)])
    for name, wanted in (("good", (5, 0)), ("bad", (0, 5))):
        land(spark, tmp_path / name, tmp_path / f"{name}-zone", spread=0)
        count = lambda part: sum(1 for f in (tmp_path / f"{name}-zone" / part).rglob("part-*") for _ in spark.read.text(str(f)).collect())
        assert (count("raw"), count("raw_dead_letter")) == wanted


def test_a_query_lands_the_topics_it_reads(spark):
    p = Pipeline(spark, "/root/testdata/sf0.001")
    lines = p.raw("review_events")
    assert lines.count() == 2 * lines.select("event_id").distinct().count() > 0
    assert p._landed == {"review_events"}


def test_a_used_up_log_goes_and_copies_take_the_room_of_one(spark, monkeypatch):
    monkeypatch.setattr(jobs, "LOG_BYTES_PER_BATCH", 1)  # a batch for each file
    p = Pipeline(spark, "/root/testdata/sf0.001")
    log = f"{p.base}/messages/twice"
    p.tables["orders"].selectExpr(
        "cast(order_id as binary) as key", "cast('{}' as binary) as value", "'order_events' as topic", "0 as partition",
        "monotonically_increasing_id() as offset", "cast('2024-01-01' as timestamp) as timestamp",
    ).repartition(3).write.parquet(log)
    expected = 2 * spark.read.parquet(log).count()
    zone = p.land(log, "twice", "twice", deliveries=2, used_up=True, grain="month", spread=0)
    dead = spark.read.json(f"{zone}/raw_dead_letter")
    assert dead.count() == expected > 0  # no file went before it was landed
    assert not os.path.exists(log)
    lines = p.raw("review_events")
    files = lines.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("_metadata.file_path").alias("files"))
    assert {(r.n, r.files) for r in files.select("n", "files").distinct().collect()} == {(2, 1)}
    assert not os.path.exists(f"{p.base}/messages/orders/review_events")


def test_each_delivery_is_read_from_the_log(spark, monkeypatch):
    monkeypatch.setattr(jobs, "LOG_BYTES_PER_TASK", 1)  # a task for each part of a delivery
    p = Pipeline(spark, "/root/testdata/sf0.001")
    seen = []
    original = jobs.landing.start_landing
    monkeypatch.setattr(jobs.landing, "start_landing", lambda *a, **k: seen.append(original(*a, **k)) or seen[-1])
    lines = p.raw("review_events")
    logged = sum(progress.numInputRows for progress in seen[0].recentProgress)
    events = lines.select("event_id").distinct().count()
    files = lines.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("_metadata.file_path").alias("files"))
    assert {(r.n, r.files) for r in files.select("n", "files").distinct().collect()} == {(2, 2)}
    assert logged >= 2 * events > 0
    assert not os.path.exists(f"{p.base}/messages/orders/review_events")


def test_a_log_is_dealt_to_the_cores_and_a_large_one_in_rounds(spark, monkeypatch):
    p, cores = Pipeline(spark, "/root/testdata/sf0.001"), spark.sparkContext.defaultParallelism
    p.spark.range(1000).write.parquet(f"{p.base}/some")
    path, fs = p._file(f"{p.base}/some")
    size = fs.getContentSummary(path).getLength()
    for small, full, tasks in ((size, 2 * size, 3), (1, size, cores), (1, -(-2 * size // (3 * cores)), 3 * cores)):
        monkeypatch.setattr(jobs, "LOG_BYTES_PER_TASK", small)
        monkeypatch.setattr(jobs, "LOG_BYTES_PER_FULL_TASK", full)
        assert p.log_tasks(f"{p.base}/some", deliveries=2) == tasks


def test_envelopes_are_read_back_without_their_payload(spark, tmp_path):
    tables = {
        "orders": "id o_orderkey, id % 3 o_custkey, 'F' o_orderstatus, 10.5D o_totalprice, timestamp_ntz'1995-01-01' o_orderdate",
        "lineitem": "id l_orderkey, id l_partkey, id l_suppkey, 1 l_linenumber, 2D l_quantity, 9.5D l_extendedprice, 0D l_discount, 0D l_tax",
        "customer": "id c_custkey, 'BUILDING' c_mktsegment, 1 c_nationkey",
        "supplier": "id s_suppkey, 1 s_nationkey",
        "part": "id p_partkey, 'b' p_brand, 't' p_type, 'n' p_name, 1 p_size",
    }
    for name, columns in tables.items():
        spark.range(1, 6).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    read = JOBS["build_envelope"](spark, str(tmp_path))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(StructField(event_id" in plan and "StructField(payload,StringType,true)" not in plan
    assert read.columns == ["topic", "key", *(f.split()[0] for f in ENVELOPE.split(", "))]
