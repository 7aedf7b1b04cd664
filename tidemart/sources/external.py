"""Optional relational source and sink over JDBC (needs a driver on the class path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """A table; ``split`` = (column, lower, upper, partitions) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split:
        column, lower, upper, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 16) -> None:
    """Append rows over a bounded number of connections."""
    writer = df.write.format("jdbc").options(url=url, dbtable=table, **properties)
    writer.option("numPartitions", connections).option("batchsize", 10_000).mode("append").save()
