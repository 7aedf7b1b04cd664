"""Raw landing: validated messages into a partitioned raw zone, the rest aside.

Layout, both as JSON Lines (gzip):

    <base>/raw/topic=<t>/dt=<event day>/hour=<event hour>/...
    <base>/raw_dead_letter/topic=<t>/dt=<write day>/hour=<write hour>/...

The raw line is the message as it came with the source metadata appended, so
unknown fields survive.  Every row goes to its own event hour; a back-fill of
sparse history may use the coarser ``grain="month"``, which files a row under the
first hour of its month and so avoids a file per quiet hour.  With ``spread=0`` a
task writes the rows it has read, as a file per topic and hour that they fall into,
and no line is sent on: for back-fills of few hours in large files.  Delivery is at
least once: a batch repeated after a crash repeats its lines, and readers drop
the copies by event id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemart.operators.validation import PLAIN, STAMP, checked
from tidemart.schemas import CONTRACT_VERSION

# Files per (topic, hour): one hour may hold a large part of a batch, and is
# then written by several tasks.  Zero leaves the rows where they were read.
SPREAD = 4
# Lines repeat their names; plain, they take some six times the room.
LINES = "gzip"
# Half of a line is hashes, on which the slower levels win nothing.
LEVEL = {"zlib.compress.level": "BEST_SPEED"}

MESSAGE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def metadata(written_at: Column) -> list[Column]:
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return [
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("key").cast("string").alias("_kafka_key"),
        stamp(F.col("timestamp")).alias("_kafka_ingest_ts"),
        stamp(written_at).alias("_raw_file_ts"),
        F.lit(CONTRACT_VERSION).alias("_contract_version"),
    ]


def _hour_parts(ts: Column, grain: str = "hour") -> list[Column]:
    """Day and hour, as texts only once they name a folder."""
    start = F.date_trunc(grain, ts)
    return [F.to_date(start).alias("dt"), F.lpad(F.hour(start).cast("string"), 2, "0").alias("hour")]


def _clustered(df: DataFrame, spread: int) -> DataFrame:
    if spread:
        df = df.repartition("topic", "dt", "hour", F.pmod(F.xxhash64("partition", "offset"), F.lit(spread)))
    return df.sortWithinPartitions("topic", "dt", "hour", "partition", "offset")


def raw_lines(valid: DataFrame, written_at: Column, grain: str = "hour") -> DataFrame:
    """Message text with metadata appended, plus its partition values."""
    # A raw line break in valid JSON is only layout, so a blank may replace it.
    body = F.regexp_replace(F.trim(F.translate("text", "\r\n\t", "   ")), r"\}$", "")
    extra = F.to_json(F.struct(*metadata(written_at)), {"ignoreNullFields": "false"})
    # Cut as bytes: counting the letters of a line takes longer than copying it.
    cut = lambda text, first, last: F.substring(text.cast("binary"), F.lit(first), F.octet_length(text) - last).cast("string")
    opened = F.when(F.col(PLAIN), cut(F.col("text"), 1, 1)).otherwise(body)  # a plain message has no layout and ends with its brace
    line = F.concat(opened, F.lit(","), cut(F.col("_extra"), 2, 1))
    happened = F.coalesce(F.try_to_timestamp(F.col(STAMP)), "timestamp")
    return valid.withColumn("_extra", extra).select(line.alias("value"), "topic", "partition", "offset", *_hour_parts(happened, grain))


def dead_lines(invalid: DataFrame, written_at: Column) -> DataFrame:
    original = F.coalesce("text", F.base64("value"), F.lit(""))
    record = F.struct("error_reason", original.alias("original_payload"), *metadata(written_at))
    line = F.to_json(record, {"ignoreNullFields": "false"})
    return invalid.select(line.alias("value"), "topic", "partition", "offset", *_hour_parts(written_at))


def _append(df: DataFrame, path: str, spread: int) -> None:
    lines = _clustered(df, spread).select("value", "topic", "dt", "hour")
    lines.write.mode("append").partitionBy("topic", "dt", "hour").options(**LEVEL).text(path, compression=LINES)


def land_batch(
    base: str,
    written_at: Column | None = None,
    strict_types: bool = True,
    grain: str = "hour",
    spread: int = SPREAD,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body; ``written_at`` defaults to the wall clock."""

    def in_place(judged: DataFrame, now: Column) -> None:
        # The messages are kept nowhere between the two writes.  Without an exchange the runtime
        # drops no part of the plan, so the count is always made; dead letters cost a second reading.
        seen = Observation()
        valid = judged.observe(seen, F.count("error_reason").alias("dead")).where("error_reason is null")
        _append(raw_lines(valid, now, grain), f"{base}/raw", spread)
        dead = judged.where("error_reason is not null")
        _append(dead_lines(dead if seen.get["dead"] else dead.limit(0), now), f"{base}/raw_dead_letter", spread)

    def land(batch: DataFrame, _batch_id: int) -> None:
        now = F.current_timestamp() if written_at is None else written_at
        judged = checked(batch, strict_types=strict_types, keep=True)
        if not spread:
            return in_place(judged, now)
        judged = judged.persist()
        try:
            _append(raw_lines(judged.where("error_reason is null"), now, grain), f"{base}/raw", spread)
            _append(dead_lines(judged.where("error_reason is not null"), now), f"{base}/raw_dead_letter", spread)
        finally:
            judged.unpersist()

    return land


def file_messages(
    spark: SparkSession, path: str, files_per_batch: int = 1000, bytes_per_batch: int | None = None, used_up: bool = False
) -> DataFrame:
    """A message log kept as Parquet files, read as a bounded-batch stream.

    ``bytes_per_batch`` bounds a batch by the size of its files instead of their number;
    a file larger than that is a batch of its own.  With ``used_up`` the files of a batch
    are deleted once it is committed; those of the last batch are left to the caller.
    """
    bound = ("maxFilesPerTrigger", files_per_batch) if bytes_per_batch is None else ("maxBytesPerTrigger", bytes_per_batch)
    stream = spark.readStream.schema(MESSAGE).option(*bound).option("maxFileAge", "36500d")
    return stream.option("cleanSource", "delete" if used_up else "off").parquet(path)


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], offsets_per_batch: int = 5_000_000) -> DataFrame:
    """The same columns from a broker (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_batch)
        .load()
        .select("key", "value", "topic", "partition", "offset", "timestamp")
    )


def start_landing(
    messages: DataFrame,
    base: str,
    checkpoint: str,
    available_now: bool = True,
    every: str = "30 seconds",
    **landing,
) -> StreamingQuery:
    """Run the landing stream; progress lives in ``checkpoint`` alone.

    ``landing`` takes the keyword arguments of :func:`land_batch`.
    """
    writer = messages.writeStream.foreachBatch(land_batch(base, **landing)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
