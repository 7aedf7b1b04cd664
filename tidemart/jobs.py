"""Registered queries of the event path: sourcing, landing, incremental load.

They run the real jobs over the given tables: events are derived from orders and
line items (or taken from ``events``), landed by the stream, loaded by the
merges, and the resulting table is returned.  A session builds each folder once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.operators import bulk, curated, facts, incremental, snapshots, timeline
from tidemart.operators.merge import KeyedTable
from tidemart.operators.validation import checked, is_iso8601, payload_drift, schema_drift
from tidemart.schemas import KEYS, TOPICS
from tidemart.session import shared_dir
from tidemart.sources import lake
from tidemart.sources.projection import SourceTables
from tidemart.sources.relational import derived_tables, read_csv_tables
from tidemart.sources.star import Star
from tidemart.streaming import landing
from tidemart.streaming.batch_runs import BatchRuns
from tidemart.streaming.ingest import FACT_OF, STORED, Load, deduplicated, run_total

AS_OF = "2001-12-05 00:00:00"
LOG_BYTES_PER_TASK = 4 << 20
LOG_BYTES_PER_FULL_TASK = 64 << 20
LOG_BYTES_PER_BATCH = 1 << 30


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, for results that leave the engine."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def order_number(column: str) -> Column:
    return F.substring(column, 2, 20).cast("bigint")


def with_field(name: str, value: str, text: str = "value") -> Column:
    """JSON text with the value of a field replaced; ``$1`` in the new value is the old one."""
    return F.regexp_replace(text, rf'"{name}":("[^"]*"|[^,}}]*)', f'"{name}":{value}')


#: Topic, last digit of the order's number, field and its new value.
REFUSED = (
    ("payment_events", 1, "payment_value", "-$1"),
    ("payment_events", 2, "payment_value", "null"),
    ("review_events", 3, "review_score", "9"),
    ("review_events", 4, "review_score", "null"),
    ("inventory_events", 5, "price", "-$1"),
    ("inventory_events", 6, "freight_value", "-$1"),
    ("inventory_events", 7, "product_id", "null"),
    ("delivery_events", 8, "order_id", "null"),
    ("order_events", 9, "event_id", "null"),
)
#: Topic, remainder of the order's number by 7, field and a value of a wrong type.
RETYPED = (
    ("order_events", 1, "item_count", '"3"'),
    ("order_events", 2, "order_value", "true"),
    ("order_events", 3, "purchase_ts", "7"),
    ("order_events", 4, "trace_id", "12"),
    ("payment_events", 1, "payment_value", '"1.5"'),
    ("payment_events", 2, "payment_installments", "2.5"),
    ("payment_events", 3, "payment_value", "1e30"),
    ("payment_events", 4, "payment_type", "[1]"),
    ("delivery_events", 1, "carrier_status", "false"),
    ("delivery_events", 2, "shipped_ts", "1700000000"),
    ("review_events", 1, "review_score", '{"n":5}'),
    ("review_events", 2, "review_score", "99999999999"),
    ("review_events", 3, "customer_id", "1"),
    ("inventory_events", 1, "order_item_id", '"1"'),
    ("inventory_events", 2, "price", '"free"'),
    ("inventory_events", 3, "freight_value", "null"),
)


class Pipeline:
    """The folders of one session and source directory, built on first use."""

    _known: dict[tuple[str, str], "Pipeline"] = {}

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self.base = shared_dir(spark, "pipeline")
        self._landed: set[str] = set()

    @classmethod
    def of(cls, spark: SparkSession, directory: str) -> "Pipeline":
        key = (spark.sparkContext.applicationId, directory)
        if key not in cls._known:
            cls._known[key] = cls(spark, directory)
        return cls._known[key]

    @cached_property
    def tables(self):
        return derived_tables(self.spark, self.directory)

    def log_tasks(self, messages: str, deliveries: int = 1) -> int:
        """How many tasks a log is worth, so that one of a few MB does not become a file per task, topic and month.

        A small log is dealt to the cores there are, a large one in as many rounds over them as it takes to sort in memory:
        each task writes a file a month, and making files costs more than filling them.
        """
        path, fs = self._file(messages)
        size, cores = deliveries * fs.getContentSummary(path).getLength(), self.spark.sparkContext.defaultParallelism
        rounds = -(-size // (cores * LOG_BYTES_PER_FULL_TASK))
        return min(1 + size // LOG_BYTES_PER_TASK, cores * max(1, rounds))

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def land(self, messages: str, name: str, checkpoint: str, deliveries: int = 1, used_up: bool = False, **options) -> str:
        """Land a message log; the same checkpoint never lands a message again.

        The source delivers its log ``deliveries`` times: each delivery is read from the log, checked and written on its own.
        A log that is ``used_up`` goes as it is landed, so that it does not stand beside its whole zone.
        """
        target = f"{self.base}/{name}"
        stream = landing.file_messages(self.spark, messages, bytes_per_batch=LOG_BYTES_PER_BATCH if used_up else None, used_up=used_up)
        stream = reduce(DataFrame.unionAll, [stream] * deliveries)
        if not options.get("spread", landing.SPREAD):
            stream = stream.coalesce(self.log_tasks(messages, deliveries))
        written = F.lit(AS_OF).cast("timestamp")
        landing.start_landing(
            stream, target, f"{self.base}/_landing/{checkpoint}", written_at=written, **options
        ).awaitTermination()
        if used_up:
            path, fs = self._file(messages)
            fs.delete(path, True)
        return target

    # ---- orders and line items as events ---------------------------------------------
    def write_log(self, envelopes: DataFrame, name: str) -> str:
        path = f"{self.base}/messages/{name}"
        timeline.as_messages(envelopes, as_of()).write.mode("overwrite").parquet(path, compression="zstd")
        return path

    def order_topic(self, topic: str) -> str:
        """The raw zone with one topic's events landed twice, as an at-least-once source may deliver them."""
        if topic not in self._landed:
            log = self.write_log(timeline.topic_envelopes(self.tables, as_of(), topic), f"orders/{topic}")
            self.land(log, "orders", f"orders-{topic}", deliveries=2, used_up=True, grain="month", spread=0)
            self._landed.add(topic)
        return f"{self.base}/orders/raw"

    @property
    def order_zone(self) -> str:
        """The raw zone with the events of all topics."""
        return [self.order_topic(topic) for topic in TOPICS][0]

    @cached_property
    def details(self) -> str:
        path, stamp = f"{self.base}/reference", as_of()
        customers = snapshots.customer_details(self.tables["customers"], stamp)
        products = snapshots.product_details(self.tables["products"], self.tables["translation"], stamp)
        snapshots.write_snapshot(customers, path, "customer_details", AS_OF[:10])
        snapshots.write_snapshot(products, path, "product_details", AS_OF[:10])
        return path

    @cached_property
    def load(self) -> Load:
        load = Load(
            self.spark,
            self.order_zone,
            f"{self.base}/warehouse",
            customer_details=snapshots.read_latest(self.spark, self.details, "customer_details"),
            product_details=snapshots.read_latest(self.spark, self.details, "product_details"),
            files_per_batch=10_000,
            as_of=as_of(),
            buckets=4,
        )
        load.run()
        return load

    @cached_property
    def stored_star(self) -> Star:
        """The star schema stored by month; a table is stored when a mart first reads it."""
        return Star.kept(SourceTables(self.spark, self.directory), f"{self.base}/star")

    def raw(self, topic: str) -> DataFrame:
        return lake.raw_topic(self.spark, self.order_topic(topic), topic)

    # ---- the same events with values that a load must refuse, every third order's twice ----
    def flawed_messages(self) -> DataFrame:
        e = timeline.all_envelopes(self.tables, as_of())
        value = F.col("value")
        for topic, digit, field, bad in REFUSED:
            value = F.when((F.col("topic") == topic) & (order_number("key") % 10 == digit), with_field(field, bad)).otherwise(value)
        flawed = e.withColumn("value", value)
        return flawed.unionByName(flawed.where(order_number("key") % 3 == 0))

    @cached_property
    def flawed_load(self) -> tuple[Load, list[list[dict]]]:
        """A load of those events in two runs, the second of which finds nothing, and what each run did."""
        zone = self.land(self.write_log(self.flawed_messages(), "flawed"), "flawed", "flawed", used_up=True, grain="month", spread=0)
        load = Load(self.spark, f"{zone}/raw", f"{self.base}/flawed-warehouse", files_per_batch=10_000, as_of=as_of(), buckets=4)
        return load, [load.run(), load.run()]

    # ---- the events table as messages, every 50th malformed ------------------------------
    def click_messages(self) -> DataFrame:
        e = SourceTables(self.spark, self.directory).read("events")
        stamp = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
        fields = {
            "event_id": F.concat(F.lit("E"), F.col("event_id").cast("string")),
            "event_type": F.col("event_type"),
            "schema_version": F.lit("1.0"),
            "event_ts": stamp,
            "source_system": F.lit("clicks"),
            "order_id": F.col("user_id").cast("string"),
            "channel": F.lit("web"),
        }

        def text(payload: Column, ts: Column = stamp, leave_out: tuple[str, ...] = ()) -> Column:
            body = {**fields, "event_ts": ts, "payload": payload}
            return F.to_json(F.struct(*[c.alias(n) for n, c in body.items() if n not in leave_out])).cast("binary")

        payload = F.from_json("props", "k bigint")
        flaw = F.when(F.col("event_id") % 50 == 0, F.floor(F.col("event_id") / 50) % 7)
        value = (
            F.when(flaw == 0, F.lit(None).cast("binary"))
            .when(flaw == 1, F.unhex(F.lit("7BFF7D")))
            .when(flaw == 2, F.lit("not json").cast("binary"))
            .when(flaw == 3, F.lit("[1]").cast("binary"))
            .when(flaw == 4, text(payload, leave_out=("order_id", "payload")))
            .when(flaw == 5, text(F.lit(5)))
            .when(flaw == 6, text(payload, F.lit("bad")))
            .otherwise(text(payload))
        )
        return e.select(
            F.col("user_id").cast("string").cast("binary").alias("key"),
            value.alias("value"),
            F.lit("click_events").alias("topic"),
            F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )

    @cached_property
    def click_log(self) -> str:
        path = f"{self.base}/messages/clicks"
        self.click_messages().write.mode("overwrite").parquet(path)
        return path

    @cached_property
    def click_zone(self) -> str:
        return self.land(self.click_log, "clicks", "clicks", spread=1)


Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


def job(fn: Callable[[Pipeline], DataFrame]) -> Callable[[Pipeline], DataFrame]:
    JOBS[fn.__name__] = lambda spark, sf_dir: fn(Pipeline.of(spark, sf_dir))
    return fn


@job
def load_source_tables(p: Pipeline) -> DataFrame:
    """Rows and filled cells of every source table after a trip through CSV."""
    path = shared_dir(p.spark, "csv")
    for name, df in p.tables.items():
        df.write.csv(f"{path}/{name}", header=True, quoteAll=True, escape='"', emptyValue="", nullValue="")
    read = read_csv_tables(p.spark, {name: f"{path}/{name}" for name in p.tables})
    filled = lambda df: sum((F.count(c) for c in df.columns), F.lit(0))
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), filled(df).alias("filled_cells"))
        for name, df in read.items()
    ]
    return curated.stack(counts)


# ---- event sourcing ------------------------------------------------------------------------


@job
def order_item_rollup(p: Pipeline) -> DataFrame:
    return plain(timeline.order_item_rollup(p.tables["items"]))


def _flat(events: DataFrame) -> DataFrame:
    return plain(events.select(*[c for c in events.columns if c != "payload"], "payload.*"))


for _builder in timeline.BUILDERS:
    JOBS[_builder.__name__] = lambda spark, sf_dir, build=_builder: _flat(build(Pipeline.of(spark, sf_dir).tables))


@job
def event_timeline(p: Pipeline) -> DataFrame:
    return timeline.event_timeline(p.tables).drop("payload")


@job
def build_envelope(p: Pipeline) -> DataFrame:
    """Envelopes read back from their JSON text."""
    value = F.from_json("value", lake.ENVELOPE)
    return timeline.all_envelopes(p.tables, as_of()).select("topic", "key", value.alias("v")).select("topic", "key", "v.*")


@job
def customer_details_snapshot(p: Pipeline) -> DataFrame:
    return snapshots.read_latest(p.spark, p.details, "customer_details")


@job
def product_details_snapshot(p: Pipeline) -> DataFrame:
    return snapshots.read_latest(p.spark, p.details, "product_details")


@job
def bulk_dim_customer(p: Pipeline) -> DataFrame:
    return bulk.bulk_dim_customer(p.tables)


@job
def bulk_dim_seller(p: Pipeline) -> DataFrame:
    return bulk.bulk_dim_seller(p.tables)


@job
def bulk_dim_product(p: Pipeline) -> DataFrame:
    return bulk.bulk_dim_product(p.tables)


@job
def bulk_fact_order_events(p: Pipeline) -> DataFrame:
    return bulk.bulk_fact_order_events(p.tables, as_of())


@job
def bulk_fact_payments(p: Pipeline) -> DataFrame:
    return plain(bulk.bulk_fact_payments(p.tables, as_of()))


@job
def bulk_fact_delivery_events(p: Pipeline) -> DataFrame:
    return plain(bulk.bulk_fact_delivery_events(p.tables, as_of()))


@job
def bulk_fact_reviews(p: Pipeline) -> DataFrame:
    return plain(bulk.bulk_fact_reviews(p.tables, as_of()))


@job
def bulk_fact_order_items(p: Pipeline) -> DataFrame:
    return plain(bulk.bulk_fact_order_items(p.tables))


@job
def full_reload(p: Pipeline) -> DataFrame:
    """Rows per mart after loading everything twice."""
    path = f"{p.base}/reloaded"
    for _ in range(2):
        bulk.full_reload(p.tables, path, as_of())
    names = list(bulk.bulk_marts(p.tables, as_of()))
    counts = [p.spark.read.parquet(f"{path}/{n}").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(n)) for n in names]
    return curated.stack(counts)


@job
def dim_date_build(p: Pipeline) -> DataFrame:
    return bulk.dim_date_build(p.tables)


# ---- raw landing ---------------------------------------------------------------------------------


@job
def validate_envelope(p: Pipeline) -> DataFrame:
    return checked(p.click_messages()).select("offset", "error_reason")


@job
def validate_payload_types(p: Pipeline) -> DataFrame:
    """Verdicts on the events of all topics, some of them with a field of a wrong type."""
    value = F.col("value")
    for topic, remainder, field, bad in RETYPED:
        value = F.when((F.col("topic") == topic) & (order_number("key") % 7 == remainder), with_field(field, bad)).otherwise(value)
    messages = timeline.all_envelopes(p.tables, as_of()).select("topic", value.cast("binary").alias("value"))
    judged = checked(messages, strict_types=True)
    return judged.select("topic", F.get_json_object("text", "$.event_id").alias("event_id"), "error_reason")


@job
def iso8601_check(p: Pipeline) -> DataFrame:
    """Verdicts on the event times of ``events`` written in nine shapes."""
    e = SourceTables(p.spark, p.directory).read("events")
    second = F.substring(F.col("ts").cast("string"), 1, 19)
    t_form, shape = F.replace(second, F.lit(" "), F.lit("T")), F.col("event_id") % 9
    text = (
        F.when(shape == 0, t_form)
        .when(shape == 1, second)
        .when(shape == 2, F.concat(t_form, F.lit("Z")))
        .when(shape == 3, F.concat(t_form, F.lit("+00:00")))
        .when(shape == 4, F.substring(second, 1, 10))
        .when(shape == 5, F.concat(t_form, F.lit(".25")))
        .when(shape == 6, F.replace(second, F.lit("-"), F.lit("/")))
        .when(shape == 7, F.concat(F.substring(second, 1, 5), F.lit("19-45")))
        .otherwise(F.lit("soon"))
    )
    return e.select("event_id", is_iso8601(text).alias("valid"))


@job
def partitioned_raw_sink(p: Pipeline) -> DataFrame:
    """What the landing stream wrote to the raw zone, with its partition."""
    lines = p.spark.read.schema("value string, topic string, dt date, hour int").text(f"{p.click_zone}/raw")
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return lines.select(
        field("event_id").alias("event_id"),
        field("channel").alias("unknown_field_kept"),
        field("_kafka_offset").cast("bigint").alias("offset"),
        field("_contract_version").alias("contract"),
        "topic",
        "dt",
        "hour",
    )


@job
def micro_batch_read(p: Pipeline) -> DataFrame:
    """The click log landed in batches of a single file each."""
    stream = landing.file_messages(p.spark, p.click_log, files_per_batch=1)
    target = f"{p.base}/clicks-by-file"
    landing.start_landing(stream, target, f"{p.base}/_landing/clicks-by-file", grain="month", spread=1).awaitTermination()
    lines = p.spark.read.schema("value string, topic string, dt date, hour int").text(f"{target}/raw")
    return lines.groupBy("topic").agg(F.count_distinct(F.get_json_object("value", "$.event_id")).alias("events"))


@job
def enrich_with_source_metadata(p: Pipeline) -> DataFrame:
    """Source metadata as found in the raw lines of the payment events."""
    lines = p.spark.read.schema("value string, topic string, dt date, hour int").text(p.order_topic("payment_events")).where("topic = 'payment_events'")
    names = ("_kafka_topic", "_kafka_key", "_kafka_ingest_ts", "_raw_file_ts", "_contract_version")
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return lines.groupBy(*[field(n) for n in names]).agg(F.count(F.lit(1)).alias("lines"))


@job
def group_sort_by_partition_offset(p: Pipeline) -> DataFrame:
    """Lines of each file that come before a line with a lower partition or offset."""
    lines = p.spark.read.text(f"{p.click_zone}/raw")
    at = lambda name: F.get_json_object("value", f"$.{name}").cast("bigint")
    place = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"),
        F.struct(at("_kafka_partition"), at("_kafka_offset")).alias("at"),
    )
    in_file = Window.partitionBy("file").orderBy("line")  # a file's size is bounded by its writer
    before = place.withColumn("before", F.lag("at").over(in_file))
    return before.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("before") > F.col("at")).alias("out_of_order"))


@job
def dead_letter_route(p: Pipeline) -> DataFrame:
    schema = "error_reason string, original_payload string, _kafka_offset bigint, topic string, dt date, hour int"
    records = p.spark.read.schema(schema).json(f"{p.click_zone}/raw_dead_letter")
    return records.select("error_reason", F.col("_kafka_offset").alias("offset"), "topic", "dt", "hour")


@job
def at_least_once_commit(p: Pipeline) -> DataFrame:
    """Lines in the raw zone before and after a restart on the same checkpoint."""
    count = lambda: p.spark.read.text(f"{p.click_zone}/raw").agg(F.count(F.lit(1)).alias("lines"))
    path = f"{p.base}/restart"
    count().withColumn("run", F.lit("first")).write.mode("overwrite").parquet(f"{path}/first")
    p.land(p.click_log, "clicks", "clicks", spread=1)
    return p.spark.read.parquet(f"{path}/first").unionByName(count().withColumn("run", F.lit("restarted")))


@job
def raw_lake_audit(p: Pipeline) -> DataFrame:
    """Rows and rows lacking metadata per topic; file counts depend on the run."""
    return lake.audit(p.spark, p.order_zone).select("topic", "rows", "rows_without_metadata")


@job
def raw_lake_inventory(p: Pipeline) -> DataFrame:
    return lake.audit(p.spark, p.order_zone)


@job
def streaming_dedupe(p: Pipeline) -> DataFrame:
    """The twice-landed events of all topics as streams without repeated event ids."""
    out, found = shared_dir(p.spark, "deduplicated"), []
    for topic in TOPICS:
        stream = lake.raw_topic_stream(p.spark, p.order_zone, topic, files_per_batch=10_000)
        rows = deduplicated(stream, "3 days").select("topic", "event_id", "order_id", "event_type")
        query = (
            rows.writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/_checkpoint/{topic}")
            .trigger(availableNow=True)
            .start(f"{out}/{topic}")
        )
        query.awaitTermination()
        found.append(p.spark.read.schema("topic string, event_id string, order_id string, event_type string").parquet(f"{out}/{topic}"))
    return curated.stack(found)


@job
def payload_schema_drift(p: Pipeline) -> DataFrame:
    """Unknown, absent and retyped payload fields over the events of all topics, some of them altered."""
    value, n = F.col("value"), order_number("key")
    for topic, remainder, field, bad in RETYPED:
        value = F.when((F.col("topic") == topic) & (n % 7 == remainder), with_field(field, bad)).otherwise(value)
    value = F.when(n % 7 == 5, F.replace(value, F.lit('"payload":{'), F.lit('"payload":{"coupon":"x",'))).otherwise(value)
    value = F.when((n % 7 == 6) & (F.col("topic") == "review_events"), F.replace(value, F.lit('"review_id"'), F.lit('"review_key"'))).otherwise(value)
    return payload_drift(timeline.all_envelopes(p.tables, as_of()).select("topic", value.alias("text")))


@job
def message_schema_drift(p: Pipeline) -> DataFrame:
    """Unknown and absent optional fields over the valid messages."""
    valid = checked(p.click_messages()).where("error_reason is null")
    return (
        schema_drift(valid)
        .groupBy(
            F.array_join("unknown_fields", ",").alias("unknown_fields"),
            F.array_join("missing_fields", ",").alias("missing_fields"),
            "major_changed",
        )
        .agg(F.count(F.lit(1)).alias("messages"))
    )


# ---- incremental load --------------------------------------------------------------------------------


def _all_raw(p: Pipeline, topics: tuple[str, ...] = TOPICS) -> DataFrame:
    return curated.stack(
        [
            lake.with_source_file(p.raw(t)).select("topic", "dt", "hour", "event_id", "_source_file", lake.ingest_ts().alias("_ingest_ts"))
            for t in topics
        ]
    )


@job
def raw_json_scan(p: Pipeline) -> DataFrame:
    return _all_raw(p).groupBy("topic", "dt", "hour").agg(F.count(F.lit(1)).alias("lines"))


@job
def source_file_partition_extract(p: Pipeline) -> DataFrame:
    """Partition values read from the path text agree with the partition columns."""
    parts = lake.with_path_parts(_all_raw(p))
    same = (F.col("path_day") == F.col("dt")) & (F.col("path_hour") == F.col("hour"))
    return parts.groupBy("topic").agg(F.count(F.lit(1)).alias("lines"), F.count_if(same).alias("agreeing"))


@job
def ingest_ts_resolve(p: Pipeline) -> DataFrame:
    """First readable of three stamps, over ``events`` with some of them broken."""
    e = SourceTables(p.spark, p.directory).read("events")
    text, n = F.substring(F.col("ts").cast("string"), 1, 19), F.col("event_id")
    later = lambda h: F.substring((F.col("ts") + F.make_dt_interval(hours=F.lit(h))).cast("string"), 1, 19)
    stamps = e.select(
        "event_id",
        F.when(n % 2 == 0, text).otherwise(F.lit("broken")).alias("_kafka_ingest_ts"),
        F.when(n % 3 == 0, later(1)).alias("_raw_file_ts"),
        F.when(n % 5 == 0, later(2)).alias("ingestion_hint_ts"),
    )
    return stamps.select("event_id", lake.ingest_ts().cast("timestamp_ntz").alias("ingest_ts")).where("ingest_ts is not null")


LAST = incremental.Progress(date(1998, 3, 1), 0)


@job
def bootstrap_batch(p: Pipeline) -> DataFrame:
    """Whole files that each bootstrap run admits, the oldest first, until no topic has any left, per partition (the files depend on the run)."""
    path, runs = shared_dir(p.spark, "bootstrap"), []
    for topic in TOPICS:
        incremental.files_of(_all_raw(p, (topic,))).write.parquet(f"{path}/{topic}")  # counted once, as a run keeps them
        runs.append(incremental.bootstrap_runs(p.spark.read.parquet(f"{path}/{topic}")))
    return curated.stack(runs).groupBy("run", "dt", "hour").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))


@job
def newer_partition_filter(p: Pipeline) -> DataFrame:
    newer = p.raw("order_events").where(incremental.newer_hours(LAST))
    return newer.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("lines"))


@job
def same_partition_unseen_files(p: Pipeline) -> DataFrame:
    """The last hour's files, none of which another topic's reader has seen."""
    raw = _all_raw(p, ("order_events", "payment_events"))
    here = raw.where("topic = 'order_events'")
    seen = raw.where("topic = 'payment_events'").select("_source_file")
    unseen = incremental.unseen_in_last_hour(here, LAST, seen)
    return unseen.groupBy("topic", "dt", "hour").agg(F.count(F.lit(1)).alias("lines"))


@job
def ingest_window_filter(p: Pipeline) -> DataFrame:
    e = SourceTables(p.spark, p.directory).read("events").withColumn("_ingest_ts", F.col("ts"))
    newest = e.agg(F.max("ts").alias("t")).scalar()
    return incremental.within_window(e, 24 * 60, newest).select("event_id", "ts")


@job
def checkpoint_advance(p: Pipeline) -> DataFrame:
    return incremental.advanced(_all_raw(p, ("order_events",))).select("last_dt", "last_hour")


@job
def checkpoint_read(p: Pipeline) -> DataFrame:
    """Last hour per topic from stored progress."""
    path = shared_dir(p.spark, "progress")
    assert incremental.read_progress(p.spark, path) is None
    incremental.save_progress(_all_raw(p), path)
    stored = incremental.read_progress(p.spark, path)
    return (
        stored.groupBy("topic")
        .agg(F.max(F.struct("dt", "hour")).alias("h"))
        .select("topic", F.col("h.dt").alias("last_dt"), F.col("h.hour").alias("last_hour"))
    )


@job
def raw_value_checks(p: Pipeline) -> DataFrame:
    """Order events with a negative value, an unreadable time or a foreign major version."""
    raw = p.raw("order_events")
    return raw.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("payload.order_value") < 0).alias("negative_order_value"),
        F.count_if(facts.stamp("event_ts").isNull()).alias("unreadable_event_ts"),
        F.count_if(F.split("schema_version", r"\.")[0] != "1").alias("other_major_version"),
        F.count_if(F.col("payload.order_value") == 0).alias("zero_order_value"),
    )


@job
def dim_customer_build(p: Pipeline) -> DataFrame:
    details = snapshots.read_latest(p.spark, p.details, "customer_details")
    return facts.dim_customer(p.raw("order_events"), details)


@job
def dim_seller_build(p: Pipeline) -> DataFrame:
    return facts.dim_seller(p.raw("inventory_events"))


@job
def dim_product_build(p: Pipeline) -> DataFrame:
    details = snapshots.read_latest(p.spark, p.details, "product_details")
    return facts.dim_product(p.raw("inventory_events"), details).select("product_id", "product_category_name", "product_weight_g")


@job
def fact_order_events_build(p: Pipeline) -> DataFrame:
    return facts.fact_order_events(p.raw("order_events"), as_of())


@job
def fact_payments_build(p: Pipeline) -> DataFrame:
    return plain(facts.fact_payments(p.raw("payment_events"), as_of()))


@job
def fact_delivery_events_build(p: Pipeline) -> DataFrame:
    return plain(facts.fact_delivery_events(p.raw("delivery_events"), as_of()))


@job
def fact_reviews_build(p: Pipeline) -> DataFrame:
    return plain(facts.fact_reviews(p.raw("review_events"), as_of()))


@job
def fact_order_items_build(p: Pipeline) -> DataFrame:
    return plain(facts.fact_order_items(p.raw("inventory_events")))


def _stored(name: str) -> Job:
    return lambda spark, sf_dir: plain(Pipeline.of(spark, sf_dir).load.table(name).read())


for _name in ("fact_order_events", "fact_payments", "fact_delivery_events", "fact_reviews", "fact_order_items"):
    JOBS[f"upsert_{_name}"] = _stored(_name)


def _stored_dim(name: str) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim = Pipeline.of(spark, sf_dir).load.table(name).read()
        return dim.drop("updated_at")

    return run


for _name in ("dim_customer", "dim_seller", "dim_product"):
    JOBS[f"upsert_{_name}"] = _stored_dim(_name)


@job
def dimension_type1_update(p: Pipeline) -> DataFrame:
    """Two merges into a customer dimension: new values replace, NULL does not."""
    path = shared_dir(p.spark, "type1")
    table = KeyedTable(p.spark, path, KEYS["dim_customer"], STORED["dim_customer"])
    source = SourceTables(p.spark, p.directory).read("customer")
    k = F.col("c_custkey")

    def batch(rows: DataFrame, city: Column, state: Column) -> DataFrame:
        none = F.lit(None).cast("string")
        return rows.select(
            F.concat(F.lit("C"), k.cast("string")).alias("customer_id"),
            none.alias("customer_unique_id"),
            city.cast("string").alias("customer_city"),
            state.cast("string").alias("customer_state"),
            none.alias("customer_zip_prefix"),
        )

    first = batch(source.where(k % 2 == 0), F.when(k % 4 == 0, F.lit("old city")), F.lit("old"))
    second = batch(source.where(k % 3 == 0), F.when(k % 5 == 0, F.lit("new city")), F.lit("new"))
    table.merge_dimension(first, F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    table.merge_dimension(second, F.lit("2001-01-02 00:00:00").cast("timestamp_ntz"))
    return table.read().select("customer_id", "customer_city", "customer_state", "created_at", "updated_at")


@job
def idempotent_new_rows(p: Pipeline) -> DataFrame:
    payments = Star.projected(p.spark, p.directory).fact_payments
    held = payments.where("payment_sequential = 1")
    return incremental.new_rows(payments, held, ["event_id"]).select("event_id", "order_id")


@job
def append_facts_simple(p: Pipeline) -> DataFrame:
    payments = Star.projected(p.spark, p.directory).fact_payments
    both = incremental.append_new(payments, payments.where("payment_type = 'boleto'"), ["event_id"])
    return plain(both.select("event_id", "payment_type", "payment_value"))


@job
def seller_backfill(p: Pipeline) -> DataFrame:
    """Items whose seller was removed for every third order get the order's seller."""
    s = Star.projected(p.spark, p.directory)
    number = F.substring("order_id", 2, 20).cast("bigint")
    items = s.fact_order_items.withColumn("seller_id", F.when(number % 3 != 0, F.col("seller_id")))
    return facts.backfill_sellers(items, s.fact_order_events).select("order_id", "order_item_id", "seller_id")


@job
def run_metrics(p: Pipeline) -> DataFrame:
    runs = p.load.quality_runs()
    names = ("rows_in", "rows_out", "null_violations", "duplicate_violations", "schema_violations")
    return runs.groupBy("dataset_name", "status").agg(*[F.sum(n).alias(n) for n in names])


@job
def load_quarantine(p: Pipeline) -> DataFrame:
    """What became of every row of a load with bad values: merged, a copy, or set aside for a reason."""
    load, _ = p.flawed_load
    aside = load.set_aside().groupBy("topic", F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
    merged = [
        load.table(fact).read().agg(F.lit(topic).alias("topic"), F.lit("merged").alias("outcome"), F.count(F.lit(1)).alias("rows"))
        for topic, fact in FACT_OF.items()
    ]
    runs = load.quality_runs().groupBy("dataset_name").agg(F.sum("duplicate_violations").alias("rows"))
    topic = F.create_map(*[F.lit(x) for t, fact in FACT_OF.items() for x in (fact, t)])[F.col("dataset_name")]
    copies = runs.select(topic.alias("topic"), F.lit("copy").alias("outcome"), "rows")
    return curated.stack([aside, *merged, copies])


@job
def run_summary(p: Pipeline) -> DataFrame:
    """Each topic's counts in two runs of the load with bad values, and the total of each run."""
    _, runs = p.flawed_load
    rows = []
    for number, topics in enumerate(runs, 1):
        rows += [(number, s["topic"], 1, s["raw_count"], s["dim_written"], s["fact_written"], s["duplicates_skipped"], s["set_aside"],
                  int(s["status"] == "no_new_data"), s["status"]) for s in topics]
        rows.append((number, "all", *run_total(topics).values(), None))
    names = ("processors_run", "raw_count", "dim_written", "fact_written", "duplicates_skipped", "set_aside", "no_new_data_processors")
    return p.spark.createDataFrame(rows, f"run int, topic string, {', '.join(f'{n} bigint' for n in names)}, status string")


@job
def upsert_late_older_event(p: Pipeline) -> DataFrame:
    """Payments merged in the wrong order: the copy read last stays, whenever it arrives."""
    table = KeyedTable(p.spark, shared_dir(p.spark, "late"), KEYS["fact_payments"], STORED["fact_payments"], facts.ORDER)

    def arrive(status: str, day: int, which: Column) -> None:
        raw = p.raw("payment_events").where(which).withColumn("_kafka_ingest_ts", F.lit(f"2001-12-{day:02}T00:00:00Z"))
        raw = raw.withColumn("payload", F.col("payload").withField("payment_status", F.lit(status)))
        table.merge(facts.fact_payments(raw, as_of(), ordered=True), collapsed=True)

    number = order_number("order_id")
    arrive("second", 6, number % 2 == 0)
    arrive("first", 5, F.lit(True))
    arrive("third", 7, number % 3 == 0)
    arrive("first", 5, F.lit(True))
    return table.read().select("event_id", "order_id", "payment_status")


@job
def batch_runs(p: Pipeline) -> DataFrame:
    """Keys and dates of all facts after batch runs, with the files of some orders arriving late."""
    base = shared_dir(p.spark, "batch-runs")
    lines = p.spark.read.schema("value string, topic string, dt date, hour int").text(p.order_zone)
    late = order_number("order_id") % 5 == 0

    def land(which: Column) -> None:
        some = lines.withColumn("order_id", F.get_json_object("value", "$.order_id")).where(which).drop("order_id")
        some.repartition("topic", "dt", "hour").write.mode("append").partitionBy("topic", "dt", "hour").text(f"{base}/raw", compression=landing.LINES)

    load = Load(p.spark, f"{base}/raw", f"{base}/warehouse", as_of=as_of(), buckets=4)
    land(~late)
    # Each run looks up the keys of the whole table: beyond a size, runs grow with the zone and not in number.
    runs = BatchRuns(load, f"{base}/progress", rows=max(200_000, -(-lines.count() // 10)))
    runs.until_done()
    land(late)  # files of hours that were read already
    runs.until_done()
    shown = lambda fact: F.concat_ws("|", *KEYS[fact]).alias("key")
    return curated.stack(
        [load.table(fact).read().select(F.lit(topic).alias("topic"), shown(fact), "event_date") for topic, fact in FACT_OF.items()]
    )


@job
def staging_events_clean(p: Pipeline) -> DataFrame:
    return curated.staging_events_clean([p.raw(t) for t in TOPICS])


@job
def loaded_star_revenue(p: Pipeline) -> DataFrame:
    """Category revenue over the event-loaded warehouse, end to end."""
    from tidemart.plans.sales import category_revenue

    return category_revenue(Star(p.spark, lambda name: p.load.table(name).read()))


@job
def mart_refresh(p: Pipeline) -> DataFrame:
    """A stored payment mart after recomputing one of its months."""
    path = shared_dir(p.spark, "mart")
    star = Star.projected(p.spark, p.directory)
    curated.write_mart(curated.mart_payment_mix(star), path)
    curated.refresh_mart(star, curated.mart_payment_mix, path, ["1998-03"])
    return p.spark.read.parquet(path).drop("event_month")


def _refreshed(build: Callable[[Star], DataFrame]) -> Job:
    """A stored mart that lacks a month and has one too many, after both were refreshed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, path = Pipeline.of(spark, sf_dir).stored_star, shared_dir(spark, build.__name__)
        whole = build(star)
        month = F.date_format("event_date", "yyyy-MM")
        gone = whole.where(month == "1998-04").withColumn("event_date", F.to_date(F.lit("2030-01-15")))
        curated.write_mart(whole.where(month != "1998-03").unionByName(gone), path)
        curated.refresh_mart(star, build, path, ["1998-03", "2030-01"])
        return spark.read.parquet(path).drop("event_month")

    return run


for _name in curated.DAY_OF:
    JOBS[f"{_name}_refresh"] = _refreshed(getattr(curated, _name))
