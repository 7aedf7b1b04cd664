from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import incremental as I
from tidemart.sources import lake

D1, D2 = date(2020, 1, 1), date(2020, 1, 2)


@pytest.fixture(scope="module")
def raw(spark):
    """Three hours, two files each, ten rows a file."""
    data = []
    for h, (day, hour) in enumerate([(D1, 10), (D1, 11), (D2, 3)]):
        for f in range(2):
            for n in range(10):
                data.append((day, hour, f"f{h}{f}", datetime(2020, 1, 1) + timedelta(hours=h, minutes=f), n))
    return spark.createDataFrame(data, "dt date, hour int, _source_file string, _ingest_ts timestamp_ntz, n int")


def names(df):
    return sorted({r._source_file for r in df.select("_source_file").distinct().collect()})


@pytest.mark.parametrize("size,files", [(1, 1), (10, 1), (11, 2), (20, 2), (35, 4), (60, 6), (999, 6)])
def test_bootstrap_admits_whole_files(raw, size, files):
    admitted = I.admit_bootstrap(I.files_of(raw), F.lit(size))
    assert names(admitted) == ["f00", "f01", "f10", "f11", "f20", "f21"][:files]
    assert {r["rows"] for r in admitted.collect()} == {10}


def test_bootstrap_admits_its_size_of_what_waits(raw, monkeypatch):
    monkeypatch.setattr(I, "BOOTSTRAP_MIN", 5)
    assert names(I.admit_bootstrap(I.files_of(raw))) == ["f00", "f01"]  # a fifth of sixty rows, in whole files


@pytest.mark.parametrize("least,most", [(5, 200_000), (15, 200_000), (1, 3), (10_000, 200_000)])
def test_bootstrap_runs_admit_every_file_once(raw, monkeypatch, least, most):
    monkeypatch.setattr(I, "BOOTSTRAP_MIN", least)
    monkeypatch.setattr(I, "BOOTSTRAP_MAX", most)
    undated = raw.withColumn("dt", F.when(F.col("_source_file") != "f00", F.col("dt")))  # without a readable partition
    files = I.files_of(undated)
    found, left, run = {r["_source_file"]: r["run"] for r in I.bootstrap_runs(files).collect()}, files, 0
    while not left.isEmpty():
        run += 1
        admitted = names(I.admit_bootstrap(left))
        assert admitted == sorted(f for f, n in found.items() if n == run)
        left = left.where(~F.col("_source_file").isin(admitted))
    assert len(found) == 6 and set(found.values()) == set(range(1, run + 1))


def test_bootstrap_size(spark):
    df = spark.createDataFrame([(1,), (60_000,), (9_000_000,)], "n bigint")
    assert [r[0] for r in df.select(I.bootstrap_size(F.col("n"))).collect()] == [10_000, 12_000, 200_000]


def test_progress(spark, raw):
    seen = raw.where("_source_file in ('f00', 'f10')").select("_source_file")
    p = I.Progress(D1, 11)
    assert names(raw.where(I.newer_hours(p))) == ["f20", "f21"]
    assert names(I.unseen_in_last_hour(raw, p, seen)) == ["f11"]
    assert names(I.pending(raw, p, seen)) == ["f01", "f11", "f20", "f21"]  # f01 came late
    assert names(I.pending(raw, p, seen, include_late=False)) == ["f11", "f20", "f21"]
    assert names(I.pending(raw, None, None)) == ["f00", "f01", "f10", "f11", "f20", "f21"]


def test_advance(raw):
    row = I.advanced(raw).first()
    assert (row.last_dt, row.last_hour, row.files) == (D2, 3, 2)


def test_window(raw):
    as_of = F.lit("2020-01-01 02:10:00").cast("timestamp_ntz")
    assert names(I.within_window(raw, 20, as_of)) == ["f20", "f21"]
    assert names(I.within_window(raw, 70, as_of)) == ["f10", "f11", "f20", "f21"]


def test_ingest_stamp_falls_back(spark):
    df = spark.createDataFrame(
        [("2020-01-01T00:00:00Z", "x", None), ("bad", "2020-01-02T00:00:00Z", None), (None, None, "2020-01-03T00:00:00Z"), (None, "", "no")],
        "_kafka_ingest_ts string, _raw_file_ts string, ingestion_hint_ts string",
    )
    got = [r[0] and r[0].day for r in df.select(lake.ingest_ts()).collect()]
    assert got == [1, 2, 3, None]


def test_path_parts(spark):
    df = spark.createDataFrame(
        [("/z/topic=a/dt=2020-01-02/hour=05/p.json",), ("/z/dt=2020-01-02/hr=7/p.json",), ("/z/dt=x/p.json",)], "_source_file string"
    )
    got = [(r.path_day, r.path_hour) for r in lake.with_path_parts(df).collect()]
    assert got == [(D2, 5), (D2, 7), (None, None)]
