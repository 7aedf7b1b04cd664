"""Reading the raw zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schemas import ENVELOPE, METADATA, PAYLOAD_FIELDS, REQUIRED_METADATA


#: File streams skip files older than this against the newest one; late files must be read.
EVERY_AGE = "36500d"


def raw_schema(topic: str) -> str:
    return f"{ENVELOPE}, payload struct<{_struct(PAYLOAD_FIELDS[topic])}>, {METADATA}"


def _struct(fields: str) -> str:
    # "a string, b decimal(18,2)" -> "a: string, b: decimal(18,2)"
    parts = [f.strip() for f in fields.replace("(18,2)", "(18;2)").replace("(10,2)", "(10;2)").split(",")]
    return ", ".join(p.replace(" ", ": ", 1) for p in parts).replace(";", ",")


def raw_topic(spark: SparkSession, raw: str, topic: str) -> DataFrame:
    """One topic with its day and hour as real, prunable partition columns."""
    schema = f"{raw_schema(topic)}, topic string, dt date, hour int"
    return spark.read.schema(schema).option("basePath", raw).json(f"{raw}/topic={topic}")


def raw_topic_stream(spark: SparkSession, raw: str, topic: str, files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream; the query's checkpoint remembers the files seen."""
    schema = f"{raw_schema(topic)}, dt date, hour int"
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", EVERY_AGE)
        .json(f"{raw}/topic={topic}")
        .withColumn("topic", F.lit(topic))
    )


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def with_path_parts(df: DataFrame, file: str = "_source_file") -> DataFrame:
    """Day and hour from the path text, for layouts that are not partition columns."""
    named = F.filter(F.split(file, "/"), lambda part: part.contains("="))

    def value(*keys: str) -> Column:
        found = F.filter(named, lambda part: F.substring_index(part, "=", 1).isin(*keys))
        return F.substring_index(F.try_element_at(found, F.lit(-1)), "=", -1)

    return df.withColumn("path_day", F.try_to_date(value("dt"))).withColumn("path_hour", value("hour", "hr").try_cast("int"))


def ingest_ts(*columns: str) -> Column:
    """The first ingestion stamp that can be read."""
    names = columns or ("_kafka_ingest_ts", "_raw_file_ts", "ingestion_hint_ts")
    return F.coalesce(*[F.try_to_timestamp(F.col(c)) for c in names])


def audit(spark: SparkSession, raw: str) -> DataFrame:
    """Files, bytes, rows and rows without required metadata per topic.

    All rows are checked; files are collapsed before the topic, so no topic
    gathers its rows in one task.
    """
    lines = spark.read.schema("value string, topic string, dt date, hour int").text(raw)
    absent = F.size(F.array_except(F.array(*[F.lit(m) for m in REQUIRED_METADATA]), F.json_object_keys("value")))
    per_file = (
        lines.select("topic", "_metadata.file_path", "_metadata.file_size", (F.coalesce(absent, F.lit(-1)) != 0).alias("bad"))
        .groupBy("topic", "file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("bad"))
    )
    return per_file.groupBy("topic").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.sum("bad").alias("rows_without_metadata"),
    )


def audit_status(report: DataFrame) -> DataFrame:
    """0 when fine, 1 when metadata is missing, 2 when the zone is empty."""
    return report.agg(
        F.when(F.count(F.lit(1)) == 0, 2).when(F.sum("rows_without_metadata") > 0, 1).otherwise(0).alias("exit_code")
    )
