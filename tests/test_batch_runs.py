"""Scheduled batch runs, and deduplication with bounded state."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.test_streaming import WRITTEN, land, message, publish
from tidemart.operators import incremental
from tidemart.sources import lake
from tidemart.streaming.batch_runs import BatchRuns
from tidemart.streaming.ingest import Load, deduplicated, late_rows

TOPIC = ("payment_events",)


def load_of(spark, base, name):
    return Load(spark, f"{base}/zone/raw", f"{base}/{name}", as_of=F.lit(WRITTEN).cast("timestamp_ntz"), buckets=2)


def content(load):
    return sorted(tuple(r) for r in load.table("fact_payments").read().select("event_id", "payment_value", "event_date").collect())


def test_runs_take_late_files_and_end_like_the_stream(spark, tmp_path):
    publish(spark, tmp_path / "log", [message(n) for n in range(12)])
    land(spark, tmp_path / "log", tmp_path / "zone", spread=1)
    load = load_of(spark, tmp_path, "batch")
    runs = BatchRuns(load, f"{tmp_path}/progress")
    first = runs.until_done(TOPIC)
    assert [r[0]["status"] for r in first] == ["success", "no_new_data"] and first[0][0]["raw_count"] == 12
    # another file of an hour that was read, and one of an older hour
    publish(spark, tmp_path / "log", [message(0), message(20, event_ts="2024-01-01T00:40:00+02:00"), message(21, event_ts="2021-01-01T00:00:00Z")])
    land(spark, tmp_path / "log", tmp_path / "zone", spread=1)
    late = runs.run(TOPIC)[0]
    assert (late["raw_count"], late["fact_written"], late["duplicates_skipped"]) == (3, 2, 1)
    assert runs.run(TOPIC)[0]["status"] == "no_new_data"
    stream = load_of(spark, tmp_path, "stream")
    stream.run(TOPIC)
    assert content(load) == content(stream) and len(content(load)) == 14


def test_runs_are_bounded_and_a_lost_one_is_repeated(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BOOTSTRAP_MIN", 4)
    days = [message(n, event_ts=f"2024-02-{1 + n // 3:02}T05:00:00Z") for n in range(15)]
    publish(spark, tmp_path / "log", days)
    land(spark, tmp_path / "log", tmp_path / "zone", spread=1)
    load = load_of(spark, tmp_path, "batch")
    runs = BatchRuns(load, f"{tmp_path}/progress")
    files = runs.admitted("payment_events")
    assert sorted(f.split("dt=")[1][:10] for f in files) == ["2024-02-01", "2024-02-02"]  # whole files, the oldest first
    load.process("payment_events")(runs._read("payment_events", files).drop("_source_file"), 1)  # lost before its progress was stored
    done = runs.until_done(TOPIC)
    counts = [r[0]["raw_count"] for r in done]
    assert sum(counts) == 15 and max(counts) <= 6 and len(counts) >= 4
    assert done[0][0]["fact_written"] == 0 and done[0][0]["duplicates_skipped"] == 6
    assert len(content(load)) == 15


def test_state_of_deduplication_is_bounded_and_late_rows_are_counted(spark, tmp_path):
    log, zone = tmp_path / "log", tmp_path / "zone"
    start = datetime(2024, 5, 1, 9)

    def arrive(day, *numbers):
        rows = [(*message(n, event_ts="2020-01-01T00:00:00Z")[:5], start + timedelta(days=day)) for n in numbers]
        publish(spark, log, rows)
        land(spark, log, zone, spread=1)

    for day in range(6):
        arrive(day, *range(day * 10, day * 10 + 10), day * 10)  # one copy each day
    arrive(0, 999)  # long after the others, stamped with the first day
    stream = deduplicated(lake.raw_topic_stream(spark, f"{zone}/raw", "payment_events", files_per_batch=1), "1 day").select("event_id")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    found = sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == sorted(f"e{n}" for n in range(60)) and late_rows(query) == 1
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(held) <= 30  # ids of the watermark's day, not of all sixty
