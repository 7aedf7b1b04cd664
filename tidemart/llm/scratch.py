"""Tables kept between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.session import shared_dir


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows once and read them back: later steps neither recompute nor depend on a lost executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Partitions of a keyed exchange: what the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
