from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart.operators.facts import backfill_sellers, latest_by
from tidemart.operators.merge import KeyedTable

SCHEMA = "id string, v int, event_date date"


def rows(spark, *values):
    return spark.createDataFrame([(i, v, d and date.fromisoformat(d)) for i, v, d in values], SCHEMA)


def content(table):
    return sorted((r.id, r.v, str(r.event_date)) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), ["id"], SCHEMA, buckets=4)


def test_empty_table_reads_empty(table):
    assert content(table) == []


def test_new_changed_repeated(spark, table):
    first = rows(spark, ("a", 1, "2020-01-05"), ("b", 1, "2020-02-05"))
    assert table.merge(first) == (2, 0, 0)
    assert table.merge(first) == (0, 2, 0)  # without order columns a batch wins
    assert content(table) == [("a", 1, "2020-01-05"), ("b", 1, "2020-02-05")]
    assert table.merge(rows(spark, ("b", 2, "2020-02-06"), ("c", 1, "2020-03-01"))) == (1, 1, 0)
    assert content(table) == [("a", 1, "2020-01-05"), ("b", 2, "2020-02-06"), ("c", 1, "2020-03-01")]
    assert table.merge(rows(spark, ("c", 1, None), ("c", 1, None))) == (0, 1, 0)
    assert table.merge(first.limit(0)) == (0, 0, 0)


def stamped(spark, *values):
    return spark.createDataFrame([(i, v, date(2020, 1, 1), at, n) for i, v, at, n in values], f"{SCHEMA}, at long, n int")


@pytest.fixture
def ordered(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "o"), ["id"], SCHEMA, order="at bigint, n int", buckets=4)


def test_newest_wins_whenever_it_arrives(spark, ordered):
    value = lambda: {r.id: r.v for r in ordered.read().collect()}
    assert ordered.merge(stamped(spark, ("a", 1, 5, 0), ("b", 1, 5, 0), ("b", 2, 5, 1))) == (2, 0, 0)
    assert value() == {"a": 1, "b": 2}
    assert ordered.merge(stamped(spark, ("a", 9, 4, 7), ("b", 3, 6, 0), ("c", 1, None, None))) == (1, 1, 1)
    assert value() == {"a": 1, "b": 3, "c": 1}  # the older row lost, the newer one won
    assert ordered.merge(stamped(spark, ("c", 2, 1, 0))).replaced == 1  # any place beats none
    before = {b: ordered.files(b) for b in range(4)}
    assert ordered.merge(stamped(spark, ("a", 1, 5, 0), ("b", 3, 6, 0))) == (0, 0, 2)
    assert {b: ordered.files(b) for b in range(4)} == before  # the same rows again write nothing
    assert ordered.read().columns == ["id", "v", "event_date"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_a_batch_opens_and_rewrites_its_buckets_only(spark, tmp_path):
    from tidemart.schemas import KEYS
    from tidemart.streaming.ingest import STORED

    for name, key in (("fact_order_items", "order_id"), ("dim_customer", "customer_id")):
        table = KeyedTable(spark, str(tmp_path / name), KEYS[name], STORED[name], buckets=32)
        many = spark.range(500).select(F.col("id").cast("string").alias(key), *[F.lit(1).alias(k) for k in KEYS[name][1:]])
        missing = [f for f in spark.createDataFrame([], STORED[name]).schema if f.name not in many.columns]
        filled = many.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
        table.merge(filled)
        before = {b: table.files(b) for b in range(32)}
        few = filled.where(F.col(key).isin("7", "8"))
        touched = sorted({r.b for r in few.select(table._bucket().alias("b")).collect()})
        assert len(touched) <= 2
        held = table.held(touched)
        assert "PartitionFilters: [isnotnull(bucket" in plan_of(held) or "PartitionFilters: [bucket" in plan_of(held)
        read = {f.rsplit("bucket=", 1)[1].split("/")[0] for f in held.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
        assert read == {str(b) for b in touched}
        if name == "dim_customer":
            done = table.merge_dimension(few.select(key, F.lit("x").alias("customer_city")), F.lit("2020-01-01").cast("timestamp_ntz"))
        else:
            done = table.merge(few)
        assert done == (0, 2, 0)
        after = {b: table.files(b) for b in range(32)}
        assert sorted(b for b in after if after[b] != before[b]) == touched


def test_many_merges_leave_few_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "m"), ["id"], SCHEMA, buckets=1, files_per_bucket=3)
    for n in range(7):
        table.merge(rows(spark, (f"k{n}", n, "2020-01-05")))
        assert len(table.files(0)) <= 3
    assert len(content(table)) == 7


def test_an_event_sent_again_with_a_later_month_is_one_row(spark, tmp_path):
    from tidemart.streaming.ingest import Load

    table = Load(spark, "", str(tmp_path)).table("fact_payments")
    names = ("event_id string, order_id string, customer_id string, payment_sequential int, payment_type string, payment_installments int, "
             "payment_value decimal(18,2), payment_status string, event_ts timestamp_ntz, event_date date, source_system string, "
             "schema_version string, ingestion_ts timestamp_ntz, _ingest_ts timestamp_ntz, _partition int, _offset bigint")  # fmt: skip

    def event(day):
        at = datetime.fromisoformat(day)
        return spark.createDataFrame([("E1", "o", "c", 1, "boleto", 1, None, "approved", at, at.date(), "s", "1.0", at, at, 0, 1)], names)

    table.merge(event("2001-02-01"))
    table.merge(event("2001-01-31"))  # read earlier, arrives later
    assert [str(r.event_date) for r in table.read().collect()] == ["2001-02-01"]


def test_a_write_that_was_lost_is_not_seen(spark, table, monkeypatch):
    table.merge(rows(spark, ("a", 1, "2020-01-05")))
    with monkeypatch.context() as m:
        # lost after the write, before anything was moved
        m.setattr(table, "finish", lambda: None)
        table.merge(rows(spark, ("a", 9, "2020-01-05"), ("z", 1, "2020-01-05")))
    marker = table._path("_next", "_SUCCESS")
    assert table._fs().exists(marker)
    table._fs().delete(marker, False)  # ... or while it was writing
    assert content(table) == [("a", 1, "2020-01-05")]
    assert not table._fs().exists(table._path("_next"))


def test_moves_that_were_lost_are_made_by_the_next_reader(spark, table, monkeypatch):
    table.merge(rows(spark, *[(f"k{n}", 1, "2020-01-05") for n in range(20)]))
    with monkeypatch.context() as m:
        m.setattr(table, "finish", lambda: None)
        table.merge(rows(spark, *[(f"k{n}", 2, "2020-01-05") for n in range(0, 20, 2)], ("new", 2, "2020-01-05")))
    folders = table._inside(table._path("_next", "kind=replace"))
    table._fs().delete(table._path(folders[0].getName()), True)
    table._fs().rename(folders[0], table._path(folders[0].getName()))  # one bucket was moved
    if len(folders) > 1:
        table._fs().delete(table._path(folders[1].getName()), True)  # of one only the old rows were deleted
    expected = sorted([(f"k{n}", 1 + (n % 2 == 0), "2020-01-05") for n in range(20)] + [("new", 2, "2020-01-05")])
    assert content(table) == expected
    assert content(table) == expected and not table._fs().exists(table._path("_next"))


def test_any_split_gives_the_same_table(spark, tmp_path):
    batches = [("a", 1, "2020-01-01"), ("b", 1, "2020-02-01"), ("a", 2, "2020-02-02"), ("c", 1, "2020-01-03"), ("b", 3, "2020-02-01")]
    one = KeyedTable(spark, str(tmp_path / "one"), ["id"], SCHEMA)
    ordered = spark.createDataFrame([(i, v, date.fromisoformat(d), n) for n, (i, v, d) in enumerate(batches)], f"{SCHEMA}, n int")
    one.merge(latest_by(ordered, ["id"], ("n",)))
    many = KeyedTable(spark, str(tmp_path / "many"), ["id"], SCHEMA)
    for b in batches:
        many.merge(rows(spark, b))
    assert content(one) == content(many)


DIM = "id string, city string, state string, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_dimension_update(spark, tmp_path):
    dim = KeyedTable(spark, str(tmp_path / "d"), ["id"], DIM, buckets=2)
    at = lambda day: F.lit(f"2020-01-0{day} 00:00:00").cast("timestamp_ntz")
    batch = lambda *r: spark.createDataFrame(list(r), "id string, city string, state string")
    dim.merge_dimension(batch(("a", "x", None), ("b", None, None)), at(1))
    dim.merge_dimension(batch(("a", None, "S"), ("b", None, None), ("c", "z", "T")), at(2))
    got = {r.id: r for r in dim.read().collect()}
    assert (got["a"].city, got["a"].state) == ("x", "S")  # NULL did not replace x
    assert got["a"].created_at == datetime(2020, 1, 1) and got["a"].updated_at == datetime(2020, 1, 2)
    assert got["b"].updated_at is None and got["c"].created_at == datetime(2020, 1, 2)
    before = [dim.files(b) for b in range(2)]
    assert dim.merge_dimension(batch(("a", None, None), ("c", "z", "T")), at(3)).rows == 0
    assert [dim.files(b) for b in range(2)] == before  # nothing new, nothing written


def test_latest_row_wins_with_many_copies(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"), F.col("id").alias("n")
    )
    got = latest_by(df, ["k"], ("n",))
    assert got.count() == 501 and got.where("k = 'hot'").first().v == 1499


def test_backfill(spark):
    items = spark.createDataFrame(
        [("o1", 1, None), ("o1", 2, "S9"), ("o2", 1, ""), ("o3", 1, None)], "order_id string, order_item_id int, seller_id string"
    )
    events = spark.createDataFrame(
        [
            ("o1", "S2", datetime(2020, 1, 2), "e2"),
            ("o1", "S1", datetime(2020, 1, 1), "e1"),
            ("o2", "S4", datetime(2020, 1, 1), "e3"),
            ("o3", None, datetime(2020, 1, 1), "e4"),
        ],
        "order_id string, seller_id string, event_ts timestamp_ntz, event_id string",
    )
    got = sorted((r.order_id, r.order_item_id, r.seller_id) for r in backfill_sellers(items, events).collect())
    # Two sellers: the earliest event decides.  No seller anywhere: the row goes.
    assert got == [("o1", 1, "S1"), ("o1", 2, "S9"), ("o2", 1, "S4")]
