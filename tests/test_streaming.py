from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import timeline
from tidemart.schemas import TOPICS
from tidemart.sources import lake
from tidemart.sources.relational import derived_tables
from tidemart.streaming import landing
from tidemart.streaming.ingest import FACT_OF, Load, deduplicated

SF = "/root/testdata/sf0.001"
WRITTEN = "2024-05-01 10:00:00"


def message(n: int, **change) -> tuple:
    body = {
        "event_id": f"e{n}",
        "event_type": "payment_approved",
        "schema_version": "1.0",
        "event_ts": f"2024-01-0{1 + n % 3}T0{n % 5}:30:00+02:00",
        "source_system": "t",
        "order_id": f"o{n}",
        "payload": {"payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "payment_value": n + 0.5,
                    "payment_status": "approved"},
        **change,
    }
    return (f"o{n}".encode(), json.dumps(body, indent=n % 2 or None).encode(), "payment_events", n % 3, n, datetime(2024, 5, 1, 9))


def publish(spark, path, messages):
    spark.createDataFrame(messages, landing.MESSAGE).write.mode("append").parquet(str(path))


def land(spark, log, base, **kw):
    stream = landing.file_messages(spark, str(log), kw.pop("files", 1000))
    query = landing.start_landing(stream, str(base), f"{base}/_cp", written_at=F.lit(WRITTEN).cast("timestamp"), **kw)
    query.awaitTermination()


def test_good_bad_restart_and_late(spark, tmp_path):
    log, base = tmp_path / "log", tmp_path / "zone"
    good = [message(n, extra="kept") for n in range(20)]
    bad = [(b"k", b"oops", "payment_events", 0, 100, datetime(2024, 5, 1)), (b"k", None, "review_events", 1, 101, datetime(2024, 5, 1))]
    publish(spark, log, good + bad)
    land(spark, log, base)
    raw = lake.raw_topic(spark, f"{base}/raw", "payment_events")
    assert raw.count() == 20
    # Every row lies in its own UTC hour, whatever its message's zone.
    for r in raw.select("event_ts", "dt", "hour").collect():
        utc = datetime.fromisoformat(r.event_ts) - timedelta(hours=2)
        assert (r.dt, r.hour) == (utc.date(), utc.hour)
    lines = spark.read.text(f"{base}/raw").collect()
    assert all(json.loads(r.value)["extra"] == "kept" and "_kafka_offset" in json.loads(r.value) for r in lines)
    dead = spark.read.json(f"{base}/raw_dead_letter")
    assert sorted(r.error_reason for r in dead.collect()) == ["invalid_json", "null_message"]
    assert {(str(r.dt), r.hour) for r in dead.select("dt", "hour").collect()} == {("2024-05-01", 10)}

    land(spark, log, base)  # the same checkpoint reads nothing again
    assert spark.read.text(f"{base}/raw").count() == 20
    publish(spark, log, [message(30, event_ts="2021-02-03T04:05:06Z")])  # three years late
    land(spark, log, base)
    late = lake.raw_topic(spark, f"{base}/raw", "payment_events").where("dt = '2021-02-03' and hour = 4")
    assert [r.event_id for r in late.collect()] == ["e30"]


def test_raw_in_is_good_plus_dead(spark, tmp_path):
    log, base = tmp_path / "log", tmp_path / "zone"
    publish(spark, log, [message(n) if n % 4 else message(n, payload=3) for n in range(40)])
    land(spark, log, base, spread=2)
    assert spark.read.text(f"{base}/raw").count() == 30
    assert spark.read.text(f"{base}/raw_dead_letter").count() == 10


def test_batches_bounded_by_bytes(spark, tmp_path):
    """Files of a few kB each against a bound of two of them."""
    log = tmp_path / "log"
    for k in range(6):
        publish(spark, log, [message(n) for n in range(10 * k, 10 * k + 10)])
    sizes = [f.stat().st_size for f in log.rglob("*.parquet")]
    bound = 2 * max(sizes)
    query = landing.start_landing(landing.file_messages(spark, str(log), bytes_per_batch=bound), str(tmp_path / "zone"), str(tmp_path / "cp"))
    query.awaitTermination()
    batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sum(batches) == 60 and len(batches) >= sum(sizes) / bound
    assert spark.read.text(f"{tmp_path}/zone/raw").count() == 60


def test_audit(spark, tmp_path):
    log, base = tmp_path / "log", tmp_path / "zone"
    publish(spark, log, [message(n) for n in range(8)])
    land(spark, log, base)
    report = lake.audit(spark, f"{base}/raw")
    row = report.first()
    assert (row.topic, row["rows"], row.rows_without_metadata) == ("payment_events", 8, 0)
    assert row.files > 0 and row.bytes > 0
    assert lake.audit_status(report).first().exit_code == 0
    spark.createDataFrame([('{"event_id":"x"}', "payment_events", "2024-01-01", "00")], "value string, topic string, dt string, hour string").write.mode(
        "append"
    ).partitionBy("topic", "dt", "hour").text(f"{base}/raw")
    assert lake.audit_status(lake.audit(spark, f"{base}/raw")).first().exit_code == 1


def test_dedupe_inside_the_watermark(spark, tmp_path):
    log, base = tmp_path / "log", tmp_path / "zone"
    publish(spark, log, [message(n % 6) for n in range(18)])
    land(spark, log, base)
    stream = deduplicated(lake.raw_topic_stream(spark, f"{base}/raw", "payment_events"), "10 days").select("event_id")
    out = f"{tmp_path}/out"
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(
        out
    ).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"e{n}" for n in range(6)]


@pytest.fixture(scope="module")
def order_zone(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("orders")
    envelopes = timeline.all_envelopes(derived_tables(spark, SF), F.lit(WRITTEN).cast("timestamp_ntz"))
    few = envelopes.where("pmod(xxhash64(key), 5) = 0")
    timeline.as_messages(few, F.lit(WRITTEN).cast("timestamp_ntz")).write.parquet(f"{base}/log")
    stream = landing.file_messages(spark, f"{base}/log")
    landing.start_landing(stream, str(base), f"{base}/_cp", grain="month", spread=1).awaitTermination()
    return f"{base}/raw"


def content(load: Load, name: str):
    rows = load.table(name).read().drop("ingestion_ts", "created_at", "updated_at").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_any_split_into_batches_gives_the_same_warehouse(spark, order_zone, tmp_path):
    stamp = F.lit(WRITTEN).cast("timestamp_ntz")
    whole = Load(spark, order_zone, f"{tmp_path}/whole", as_of=stamp, files_per_batch=10_000, buckets=4)
    whole.run()
    split = Load(spark, order_zone, f"{tmp_path}/split", as_of=stamp, files_per_batch=60, buckets=4)
    split.run()
    assert len(split.metrics) > len(whole.metrics) == len(TOPICS)
    for name in (*FACT_OF.values(), "dim_customer", "dim_seller", "dim_product"):
        assert content(whole, name) == content(split, name), name
        assert content(whole, name)
    # A second run finds nothing new; a lost checkpoint repeats everything harmlessly.
    before = {name: content(whole, name) for name in FACT_OF.values()}
    whole.run()
    assert len(whole.metrics) == len(TOPICS)
    whole.process("payment_events")(
        lake.raw_topic(spark, order_zone, "payment_events"), 99
    )
    assert {name: content(whole, name) for name in FACT_OF.values()} == before
    quality = whole.quality_runs()
    assert quality.where("rows_in - rows_out <> duplicate_violations").isEmpty()


def test_run_record_tells_copies_from_refused_rows(spark, order_zone, tmp_path):
    load = Load(spark, order_zone, f"{tmp_path}/w", as_of=F.lit(WRITTEN).cast("timestamp_ntz"), buckets=4)
    good = lake.raw_topic(spark, order_zone, "payment_events")
    names = ("rows_in", "rows_out", "duplicate_violations", "set_aside", "null_violations", "schema_violations", "status")
    record = lambda k: tuple(load.metrics[k][n] for n in names)
    load.process("payment_events")(good.unionByName(good), 0)
    n = load.metrics[0]["rows_out"]
    assert record(0) == (2 * n, n, n, 0, 0, 0, "success")
    # The same rows again are copies; rows without a key and with a refused amount are kept aside.
    unkeyed = good.limit(3).withColumn("event_id", F.lit(None).cast("string"))
    negative = good.limit(2).withColumn("payload", F.col("payload").withField("payment_value", F.lit(-1).cast("decimal(18,2)")))
    load.process("payment_events")(good.unionByName(unkeyed).unionByName(negative), 1)
    assert record(1) == (n + 5, 0, n, 5, 3, 2, "failed")
    undated = good.limit(2)
    for c in ("_kafka_ingest_ts", "_raw_file_ts", "ingestion_hint_ts"):
        undated = undated.withColumn(c, F.lit(None).cast("string"))
    load.process("payment_events")(undated, 2)
    assert record(2) == (2, 0, 0, 2, 2, 0, "failed")
    aside = {r.reason: r["count"] for r in load.set_aside().groupBy("reason").count().collect()}
    assert aside == {"missing_event_id": 3, "negative_payment_value": 2, "missing_ingest_ts": 2}
    row = json.loads(load.set_aside().where("reason = 'negative_payment_value'").first().row)
    assert row["payload"]["payment_value"] == -1 and row["_kafka_topic"] == "payment_events"
    load.process("payment_events")(undated, 2)  # a repeated batch replaces what it put aside
    assert load.set_aside().count() == 7
    assert load.quality_runs().where("rows_in <> rows_out + duplicate_violations + set_aside").isEmpty()


def test_items_without_any_seller_are_kept_aside(spark, order_zone, tmp_path):
    load = Load(spark, order_zone, f"{tmp_path}/w", buckets=2)
    items = lake.raw_topic(spark, order_zone, "inventory_events").limit(6).persist()
    load.process("inventory_events")(items.withColumn("seller_id", F.lit(None).cast("string")), 0)
    assert (load.metrics[0]["rows_out"], load.metrics[0]["set_aside"], load.metrics[0]["status"]) == (0, 6, "failed")
    assert [r.reason for r in load.set_aside().collect()] == ["missing_seller"] * 6
    load.process("inventory_events")(items, 1)  # sent again with its seller, the item gets in
    assert (load.metrics[1]["rows_out"], load.metrics[1]["set_aside"]) == (6, 0)


def test_a_run_sums_up_its_topics(spark, order_zone, tmp_path):
    from tidemart.streaming.ingest import run_total

    load = Load(spark, order_zone, f"{tmp_path}/w", as_of=F.lit(WRITTEN).cast("timestamp_ntz"), files_per_batch=10_000, buckets=2)
    first = load.run(("review_events", "payment_events"))
    assert [s["topic"] for s in first] == ["payment_events", "review_events"] and {s["status"] for s in first} == {"success"}
    total = run_total(first)
    assert total["processors_run"] == 2 and total["no_new_data_processors"] == 0
    assert total["raw_count"] == total["fact_written"] + total["duplicates_skipped"] > 0 and total["dim_written"] > 0
    again = load.run(("review_events",))
    assert run_total(again) == dict.fromkeys(run_total(again), 0) | {"processors_run": 1, "no_new_data_processors": 1}
    assert load.quality_runs().where("status = 'no_new_data'").count() == 1
