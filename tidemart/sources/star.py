"""Access to the star schema, whether projected lazily or read from a warehouse."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.projection import BUILDERS, SourceTables

# A calendar has at most 366 rows a year, and the two vocabularies are seeded by
# hand: these are the only tables small by construction.  Customer, seller and
# product grow with the data and are left to the planner's size check.
BOUNDED = ("dim_date", "dim_payment_type", "dim_event_type")

FACTS = tuple(t for t in BUILDERS if t.startswith("fact_"))
DIMS = tuple(t for t in BUILDERS if t.startswith("dim_"))
# Facts that are written by month of event_date.
DATED = tuple(t for t in FACTS if t != "fact_data_quality")


#: The partition column of a stored fact.
MONTH = "event_month"


def within(months: list[str], day: str = "event_date") -> Column:
    """Whether a day lies in one of the months, as ranges that reach a scan."""
    out = F.lit(False)
    for m in months:
        first = F.to_date(F.lit(f"{m}-01"))
        out = out | F.col(day).between(first, F.last_day(first))
    return out


class Star:
    """The twelve tables plus the row subsets most queries start from."""

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame]):
        self.spark = spark
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def projected(cls, spark: SparkSession, directory: str) -> "Star":
        return cls.over(SourceTables(spark, directory))

    @classmethod
    def over(cls, source: SourceTables) -> "Star":
        return cls(source.spark, lambda name: BUILDERS[name](source))

    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> "Star":
        star = cls(spark, lambda name: spark.read.parquet(f"{path}/{name}"))
        star.path = path
        return star

    @classmethod
    def kept(cls, source: SourceTables, path: str) -> "Star":
        """Tables stored under ``path``; one that is missing is projected and stored on first use."""
        spark, lazy, stored = source.spark, cls.over(source), cls.stored(source.spark, path)

        def load(name: str) -> DataFrame:
            done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")
            if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
                store_table(name, lazy.table(name), path)
            return stored._load(name)

        return cls(spark, load)

    @classmethod
    def bucketed(cls, spark: SparkSession, database: str) -> "Star":
        return cls(spark, lambda name: spark.table(f"{database}.{name}"))

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            df = self._load(name).drop(MONTH)
            self._frames[name] = F.broadcast(df) if name in BOUNDED else df
        return self._frames[name]

    def in_months(self, months: list[str], *facts: str) -> "Star":
        """The same tables, with the named facts cut to these months (yyyy-MM) of event_date.

        A stored fact is cut by its month folders, so the others are not opened.
        """

        def load(name: str) -> DataFrame:
            df = self._load(name)
            if name not in facts:
                return df
            return df.where(F.col(MONTH).isin(months)) if MONTH in df.columns else df.where(within(months))

        return Star(self.spark, load)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BUILDERS:
            return self.table(name)
        raise AttributeError(name)

    # ---- row subsets -------------------------------------------------------
    @property
    def created(self) -> DataFrame:
        return self.fact_order_events.where("event_type = 'order_created'")

    @property
    def approved(self) -> DataFrame:
        return self.fact_payments.where("payment_status = 'approved'")

    @property
    def delivered(self) -> DataFrame:
        return self.fact_delivery_events.where("event_type = 'order_delivered'")

    @property
    def timed(self) -> DataFrame:
        """Deliveries whose delay is known."""
        return self.delivered.where("delivery_delay_hours is not null")

    # ---- order-grain summaries ----------------------------------------------
    # Joins on order_id start from one row per order, so that an order with many
    # payments or reviews never multiplies rows; sums and counts of the joined
    # rows are then products of the per-order sums and counts.
    @property
    def paid_by_order(self) -> DataFrame:
        return self.approved.groupBy("order_id").agg(
            F.sum("payment_value").alias("paid"), F.count("payment_value").alias("payments")
        )

    @property
    def reviews_by_order(self) -> DataFrame:
        return self.fact_reviews.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count("review_score").alias("scored"),
            F.sum("review_score").alias("score_sum"),
            F.count_if(F.col("review_score") <= 2).alias("low_reviews"),
            F.sum(F.when(F.col("review_score") <= 2, F.col("review_score"))).alias("low_sum"),
        )

    @property
    def created_paid(self) -> DataFrame:
        """Created orders with their approved payments; unpaid orders stay."""
        return self.created.join(self.paid_by_order, "order_id", "left")

    @property
    def items_categorised(self) -> DataFrame:
        """Order items with their product's category (inner join)."""
        products = self.dim_product.select(
            "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
        )
        return self.fact_order_items.join(products, "product_id")


def store_table(name: str, df: DataFrame, path: str) -> None:
    """Store one table for repeated reading.

    Facts are clustered by month and sorted by order inside each file, so date
    predicates skip files and order lookups skip row groups by their statistics.
    The rebalance lets the runtime split a large month and merge small ones, so
    the files come out at the advisory size whatever the scale.  The table is
    replaced whole, and its ``_SUCCESS`` file tells that it is complete.
    """
    if name in DATED:
        (
            df.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))
            .hint("rebalance", "event_month")
            .sortWithinPartitions("event_month", "order_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("event_month")
            .parquet(f"{path}/{name}")
        )
    else:
        (df.coalesce(1) if name in BOUNDED else df).write.mode("overwrite").parquet(f"{path}/{name}")


def write_star(star: Star, path: str, tables_at_once: int = 4) -> None:
    """Store the whole star schema.

    Several tables are written at a time: the short stages of one fill the gaps
    of another.
    """
    with ThreadPoolExecutor(tables_at_once) as pool:
        list(pool.map(lambda name: store_table(name, star.table(name), path), sorted(BUILDERS, reverse=True)))


# Facts that meet on the order.
ORDERED = ("fact_order_events", "fact_payments", "fact_delivery_events", "fact_reviews", "fact_order_items")


def write_bucketed_star(star: Star, database: str, path: str, buckets: int) -> None:
    """Store the star schema as catalog tables whose facts are bucketed by order.

    Joins and aggregates on order_id then read matching buckets and need no
    shuffle.  ``buckets`` should make a bucket of the largest fact about one to
    two shuffle partitions in size; all facts must use the same number.
    """
    star.spark.sql(f"create database if not exists {database}")
    for name in BUILDERS:
        df = star.table(name)
        if name in ORDERED:
            # The same hash as the buckets: every task writes one bucket's file.
            writer = df.repartition(buckets, "order_id").write.bucketBy(buckets, "order_id").sortBy("order_id")
        else:
            writer = (df.coalesce(1) if name in BOUNDED else df).write
        writer.mode("overwrite").option("path", f"{path}/{name}").format("parquet").saveAsTable(f"{database}.{name}")
