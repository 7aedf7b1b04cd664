"""Incremental load: raw zone to star schema, one stream per topic.

Each stream reads the files it has not read, in bounded batches, and merges the
batch by business key: dimensions first, then the fact.  Progress is the
stream's checkpoint; merges are idempotent, so a batch repeated after a crash
or the same events landed twice leave the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemart.operators import facts as X
from tidemart.operators.bulk import first_rows
from tidemart.operators.merge import KeyedTable, Merged
from tidemart.operators.validity import MISSING, set_aside
from tidemart.schemas import KEYS, TOPICS
from tidemart.sources.lake import ingest_ts, raw_topic_stream

_EVENT_TAIL = "event_ts timestamp_ntz, event_date date, source_system string, schema_version string, ingestion_ts timestamp_ntz"
_DIM_TAIL = "created_at timestamp_ntz, updated_at timestamp_ntz"

STORED = {
    "dim_customer": "customer_id string, customer_unique_id string, customer_city string, customer_state string, "
    f"customer_zip_prefix string, {_DIM_TAIL}",
    "dim_seller": f"seller_id string, seller_city string, seller_state string, seller_zip_prefix string, {_DIM_TAIL}",
    "dim_product": "product_id string, product_category_name string, "
    + ", ".join(f"{c} int" for c in X.PRODUCT_SIZES)
    + f", {_DIM_TAIL}",
    "fact_order_events": "event_id string, order_id string, event_type string, customer_id string, seller_id string, "
    "order_status string, purchase_ts timestamp_ntz, approved_ts timestamp_ntz, "
    f"estimated_delivery_ts timestamp_ntz, {_EVENT_TAIL}",
    "fact_payments": "event_id string, order_id string, customer_id string, payment_sequential int, payment_type string, "
    f"payment_installments int, payment_value decimal(18,2), payment_status string, {_EVENT_TAIL}",
    "fact_delivery_events": "event_id string, order_id string, event_type string, carrier_status string, "
    "shipped_ts timestamp_ntz, delivered_customer_ts timestamp_ntz, delivery_delay_hours decimal(10,2), "
    f"seller_id string, customer_id string, {_EVENT_TAIL}",
    "fact_reviews": "event_id string, order_id string, review_id string, review_score int, "
    "review_created_ts timestamp_ntz, review_answer_ts timestamp_ntz, review_response_hours decimal(10,2), "
    f"review_comment_title string, customer_id string, seller_id string, {_EVENT_TAIL}",
    "fact_order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price decimal(18,2), freight_value decimal(18,2), event_date date",
}

FACT_OF = {
    "order_events": "fact_order_events",
    "payment_events": "fact_payments",
    "delivery_events": "fact_delivery_events",
    "review_events": "fact_reviews",
    "inventory_events": "fact_order_items",
}

#: The ids that a topic's rows name and the dimension of each, in the order of their merges.
_CUSTOMER, _SELLER = {"customer_id": "dim_customer"}, {"seller_id": "dim_seller"}
DIM_OF = {
    "order_events": {**_CUSTOMER, **_SELLER},
    "payment_events": _CUSTOMER,
    "delivery_events": {**_CUSTOMER, **_SELLER},
    "review_events": {**_CUSTOMER, **_SELLER},
    "inventory_events": {"payload.product_id": "dim_product", **_SELLER},
}


RECORD = (
    "run_id string, dataset_name string, rows_in bigint, rows_out bigint, null_violations bigint, "
    "duplicate_violations bigint, schema_violations bigint, set_aside bigint, dim_rows bigint, status string"
)


@dataclass
class Load:
    """One warehouse folder and the settings of the runs that fill it.

    Every row of a batch is merged, a copy, or set aside with a reason; what is set
    aside is kept as JSON under ``_set_aside``, by topic and batch.
    """

    spark: SparkSession
    raw: str
    warehouse: str
    customer_details: DataFrame | None = None
    product_details: DataFrame | None = None
    files_per_batch: int = 1000
    as_of: Column | None = None
    run_id: str = "run"
    buckets: int = 16
    metrics: list[dict] = field(default_factory=list)

    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def table(self, name: str) -> KeyedTable:
        order = X.ORDER if name.startswith("fact_") else ""
        return KeyedTable(self.spark, f"{self.warehouse}/{name}", KEYS[name], STORED[name], order, self.buckets)

    # ---- one batch -----------------------------------------------------------------
    def survey(self, topic: str, judged: DataFrame) -> DataFrame:
        """(name, id, rows) of a batch from one pass over it: how many rows had each outcome, and the ids its valid rows name.

        Ids are combined before the shuffle, so that what is kept is small beside the batch,
        which is read again for its facts and kept nowhere.
        """
        valid, reason = F.col("reason").isNull(), F.col("reason")
        foreign = ~F.coalesce(F.col("schema_version").startswith("1."), F.lit(False))
        outcome = F.when(valid, F.when(foreign, "foreign").otherwise("good")).when(reason.startswith(MISSING), "missing").otherwise("broken")
        found = {"outcome": outcome, **{path: F.when(valid, F.col(path)) for path in DIM_OF[topic]}}
        if topic == "inventory_events":
            found["unsold"] = F.when(valid & (F.coalesce("seller_id", F.lit("")) == ""), "rows")
        pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), id_.alias("id")) for name, id_ in found.items()]))
        return judged.select(pairs.alias("f")).where("f.id is not null").groupBy("f.name", "f.id").agg(F.count(F.lit(1)).alias("rows"))

    def dimensions(self, topic: str, found: DataFrame) -> dict[str, DataFrame]:
        """The dimension rows of the ids that :meth:`survey` found."""
        dims = {}
        for path, dim in DIM_OF[topic].items():
            ids = found.where(F.col("name") == path).select(F.col("id").alias(path.removeprefix("payload.")))
            if path.startswith("payload."):
                ids = ids.select(F.struct("*").alias("payload"))
            dims[dim] = getattr(X, dim)(ids)
        return dims

    def sideload(self) -> None:
        """Merge the side-loaded attributes once per run, not once per batch.

        A known value is never replaced by NULL, so the ids that batches bring
        later leave these attributes alone.
        """
        if self.customer_details is not None:
            rows = first_rows(X.customers_from_details(self.customer_details), "customer_id")
            self.table("dim_customer").merge_dimension(rows, self.now())
        if self.product_details is not None:
            rows = first_rows(X.products_from_details(self.product_details), "product_id")
            self.table("dim_product").merge_dimension(rows, self.now())

    def fact(self, topic: str, raw: DataFrame, unsold: bool = True) -> tuple[DataFrame, DataFrame | None]:
        """The fact rows of valid raw rows, one per key, and the items for which no seller is known.

        ``unsold`` says whether any item lacks its seller.
        """
        if topic != "inventory_events":
            return getattr(X, FACT_OF[topic])(raw, self.now(), ordered=True), None
        items = X.fact_order_items(raw, ordered=True)
        if not unsold:
            return items, None  # nothing to look up, so the event history is not opened
        found = X.find_sellers(items, self.table("fact_order_events").read()).persist()
        return found.where("seller_id is not null"), found.where("seller_id is null")

    def _put_aside(self, rows: DataFrame, topic: str, part: str) -> None:
        """Keep refused rows (with their ``reason``) whole; the part names the folder, so a repeated batch replaces it."""
        body = F.to_json(F.struct(*[c for c in rows.columns if c != "reason"]), {"ignoreNullFields": "false"})
        rows.select("reason", body.alias("row")).write.mode("overwrite").parquet(f"{self.warehouse}/_set_aside/topic={topic}/part={part}")

    def set_aside(self) -> DataFrame:
        """Everything refused so far: topic, reason, row."""
        return self.spark.read.schema("reason string, row string, topic string, part string").parquet(f"{self.warehouse}/_set_aside").drop("part")

    def process(self, topic: str):
        def run(batch: DataFrame, batch_id: int) -> None:
            name, part = FACT_OF[topic], f"{self.run_id}-{batch_id}"
            judged = batch.withColumn("reason", set_aside(topic))
            found = self.survey(topic, judged).persist()
            try:
                seen = {(r["name"], r["id"]): r["rows"] for r in found.where("name in ('outcome', 'unsold')").collect()}  # five at most
                of = lambda *outcomes: sum(seen.get(("outcome", o), 0) for o in outcomes)
                counts = {
                    "rows_in": of("good", "foreign", "missing", "broken"),
                    "set_aside": of("missing", "broken"),
                    "null_violations": of("missing"),
                    "schema_violations": of("broken", "foreign"),
                }
                dim_rows = sum(self.table(d).merge_dimension(dim, self.now()).rows for d, dim in self.dimensions(topic, found).items())
                fact, unsold = self.fact(topic, judged.where("reason is null").drop("reason"), ("unsold", "rows") in seen)
                merged = self.table(name).merge(fact, collapsed=True)
                if counts["set_aside"]:
                    self._put_aside(judged.where("reason is not null"), topic, part)
                if unsold is not None:
                    lacking = unsold.count()
                    if lacking:
                        self._put_aside(unsold.withColumn("reason", F.lit("missing_seller")), topic, f"{part}-unsold")
                    counts["set_aside"] += lacking
                    counts["null_violations"] += lacking
                self.metrics.append(self._record(topic, f"{topic}-{batch_id}", counts, merged, dim_rows))
            finally:
                found.unpersist()

        return run

    def _record(self, topic: str, batch: str, seen: dict, merged: Merged, dim_rows: int, status: str = "") -> dict:
        """One quality row per batch, and one for a topic that had none in a run.

        Copies of a key are expected and merge away.  A batch fails its check if it
        has null or schema violations, that is, rows set aside or of a foreign version.
        """
        row = {
            "run_id": f"{self.run_id}-{batch}",
            "dataset_name": FACT_OF[topic],
            "rows_in": seen["rows_in"],
            "rows_out": merged.rows,
            "null_violations": seen["null_violations"],
            "duplicate_violations": seen["rows_in"] - seen["set_aside"] - merged.rows,
            "schema_violations": seen["schema_violations"],
            "set_aside": seen["set_aside"],
            "dim_rows": dim_rows,
            "status": status or ("failed" if seen["null_violations"] + seen["schema_violations"] else "success"),
        }
        frame = self.spark.createDataFrame([tuple(row.values())], RECORD).withColumn("run_ts", self.now().cast("timestamp_ntz"))
        # The batch id names the file, so a repeated batch replaces its record.
        frame.write.mode("overwrite").parquet(f"{self.warehouse}/fact_data_quality/{row['run_id']}")
        return row

    # ---- runs ------------------------------------------------------------------------
    def start(self, topic: str) -> StreamingQuery:
        stream = raw_topic_stream(self.spark, self.raw, topic, self.files_per_batch)
        return (
            stream.writeStream.foreachBatch(self.process(topic))
            .option("checkpointLocation", f"{self.warehouse}/_checkpoints/{topic}")
            .trigger(availableNow=True)
            .start()
        )

    def run(self, topics: tuple[str, ...] = TOPICS) -> list[dict]:
        """Load everything that is waiting, topic after topic in the fixed order, and say what each topic did.

        Order events come first: they name the sellers that items may lack.
        """
        self.sideload()
        done = []
        for topic in (t for t in TOPICS if t in topics):
            before = len(self.metrics)
            self.start(topic).awaitTermination()
            done.append(topic_summary(topic, self.metrics[before:]) if len(self.metrics) > before else self.idle(topic))
        return done

    def idle(self, topic: str) -> dict:
        """Record that a run found nothing for a topic."""
        nothing = dict.fromkeys(("rows_in", "set_aside", "null_violations", "schema_violations"), 0)
        return topic_summary(topic, [self._record(topic, f"{topic}-idle", nothing, Merged(), 0, "no_new_data")])

    def quality_runs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.warehouse}/fact_data_quality/*")


def topic_summary(topic: str, records: list[dict]) -> dict:
    """What a run did for one topic, summed over its batches."""
    total = lambda name: sum(r[name] for r in records)
    statuses = {r["status"] for r in records}
    return {
        "topic": topic,
        "raw_count": total("rows_in"),
        "dim_written": total("dim_rows"),
        "fact_written": total("rows_out"),
        "duplicates_skipped": total("duplicate_violations"),
        "set_aside": total("set_aside"),
        "status": next(s for s in ("failed", "success", "no_new_data") if s in statuses),
    }


def run_total(summaries: list[dict]) -> dict:
    """The totals of a run over its topics."""
    total = lambda name: sum(s[name] for s in summaries)
    counts = ("raw_count", "dim_written", "fact_written", "duplicates_skipped", "set_aside")
    return {
        "processors_run": len(summaries),
        **{name: total(name) for name in counts},
        "no_new_data_processors": sum(s["status"] == "no_new_data" for s in summaries),
    }


def deduplicated(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop repeated event ids of a stream of raw records, as far apart as ``delay`` in time of arrival.

    The watermark follows the ingestion stamp, not the event's own time: copies come
    from redelivery, so they arrive soon after each other, while a back-fill brings events of any age.
    The state holds the ids of the last ``delay``; rows that arrive later than that
    are dropped and counted by :func:`late_rows`.  Rows without a
    readable stamp are left out; the load sets them aside.
    """
    stamped = events.withColumn("arrival", ingest_ts()).where("arrival is not null")
    return stamped.withWatermark("arrival", delay).dropDuplicatesWithinWatermark(["event_id"])


def late_rows(query: StreamingQuery) -> int:
    """Rows the query's state operators dropped because they came after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
