"""Star schema derived from the order/line-item tables.

Each builder is a lazy plan over the source parquet, so a query reads only the
columns it needs.  ``prim`` is an aggregate on the order key on purpose: its key
is then known to be unique and the left join to it disappears from any plan
that does not use the seller.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.columns import monday_week_of_year
from tidemart.schemas import EVENT_TYPE_SEED, PAYMENT_TYPE_SEED


def plus_hours(ts: str, hours: str) -> Column:
    return F.expr(f"timestampadd(HOUR, cast({hours} as int), {ts})")


def plus_seconds(ts: str, seconds: str) -> Column:
    return F.expr(f"timestampadd(SECOND, cast({seconds} as int), {ts})")


class SourceTables:
    """The parquet tables of one directory and the frames derived from them."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:  # listing and footer reading happen once
            self._read[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._read[name]

    @cached_property
    def item_rows(self) -> DataFrame:
        """Line items with one row per (order, line); the smallest row wins.

        A minimum over a struct combines copies before the shuffle, which a
        ranking window would not.
        """
        rest = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        return (
            self.read("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(F.struct(*rest)).alias("r"))
            .select("l_orderkey", "l_linenumber", *[F.col(f"r.{c}").alias(c) for c in rest])
        )

    @cached_property
    def primary_seller(self) -> DataFrame:
        first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey"))
        return (
            self.read("lineitem")
            .groupBy("l_orderkey")
            .agg(first.alias("f"))
            .select("l_orderkey", F.concat(F.lit("S"), F.col("f.l_suppkey").cast("string")).alias("seller_id"))
        )

    @cached_property
    def order_rows(self) -> DataFrame:
        k = "o_orderkey"
        buy = f"({k}*37)%24"
        late = f"({k}*131)%241-168"
        promise = f"{buy}+24*(10+{k}%15)"
        return self.read("orders").select(
            F.col(k).alias("k"),
            F.concat(F.lit("O"), F.col(k).cast("string")).alias("order_id"),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
            "o_totalprice",
            "o_orderstatus",
            plus_hours("o_orderdate", buy).alias("purchase_ts"),
            F.when(F.expr(f"{k}%20<>0"), plus_hours("o_orderdate", f"{buy}+1+{k}%47")).alias("approved_ts"),
            plus_hours("o_orderdate", promise).alias("est_ts"),
            F.when(F.expr(f"{k}%20<>0"), plus_hours("o_orderdate", f"{buy}+48+{k}%30")).alias("shipped_ts"),
            F.when(F.expr(f"{k}%10 not in (0,1)"), plus_hours("o_orderdate", f"{promise}+{late}")).alias("deliv_ts"),
            F.expr(late).alias("delay_h"),
        )

    @cached_property
    def orders_with_seller(self) -> DataFrame:
        orders, prim = self.order_rows, self.primary_seller
        return orders.join(prim, orders.k == prim.l_orderkey, "left").drop("l_orderkey")


def _tail(ts: str) -> list[Column]:
    return [
        F.lit("fixture").alias("source_system"),
        F.lit("1.0").alias("schema_version"),
        plus_seconds(ts, "5+k%120").alias("ingestion_ts"),
    ]


def _key(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def dim_customer(s: SourceTables) -> DataFrame:
    return s.read("customer").select(
        _key("C", "c_custkey").alias("customer_id"),
        F.expr("concat('U', cast(c_custkey%1000 as string))").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        _key("ST", "c_nationkey").alias("customer_state"),
        F.lit(None).cast("string").alias("customer_zip_prefix"),
    )


def dim_seller(s: SourceTables) -> DataFrame:
    return s.read("supplier").select(
        _key("S", "s_suppkey").alias("seller_id"),
        F.expr("concat('CITY', cast(s_suppkey%7 as string))").alias("seller_city"),
        _key("ST", "s_nationkey").alias("seller_state"),
        F.lit(None).cast("string").alias("seller_zip_prefix"),
    )


def dim_product(s: SourceTables) -> DataFrame:
    return s.read("part").select(
        _key("P", "p_partkey").alias("product_id"),
        F.when(F.expr("p_partkey%50<>0"), F.concat_ws("_", "p_type", "p_brand")).alias("product_category_name"),
        F.col("p_size").alias("product_length_cm"),
    )


def dim_payment_type(s: SourceTables) -> DataFrame:
    return s.spark.createDataFrame(
        PAYMENT_TYPE_SEED, "payment_type string, is_digital boolean, is_installment_supported boolean"
    )


def dim_event_type(s: SourceTables) -> DataFrame:
    return s.spark.createDataFrame(EVENT_TYPE_SEED, "event_type string, domain string, is_terminal_state boolean")


def calendar(days: DataFrame, day: str = "full_date") -> DataFrame:
    """Calendar attributes for a frame of distinct days."""
    d = F.col(day)
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        d.alias("full_date"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        monday_week_of_year(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (F.last_day(d) == d).alias("is_month_end"),
    )


def distinct_days(df: DataFrame, *stamps: str) -> DataFrame:
    """Distinct days over several timestamp columns in one scan."""
    days = F.array(*[F.col(c).cast("date") for c in stamps])
    return df.select(F.explode(days).alias("full_date")).where("full_date is not null").distinct()


def dim_date(s: SourceTables) -> DataFrame:
    return calendar(distinct_days(s.order_rows, "purchase_ts", "approved_ts", "deliv_ts", "est_ts"))


def fact_order_events(s: SourceTables) -> DataFrame:
    o = s.orders_with_seller
    status = (
        F.when(F.expr("k%20=0"), "canceled")
        .when(F.col("o_orderstatus") == "O", "created")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise("processing")
    )

    def rows(src: DataFrame, prefix: str, kind: str, ts: str, state: Column, est: Column) -> DataFrame:
        return src.select(
            F.concat(F.lit(prefix), "order_id").alias("event_id"),
            "order_id",
            F.lit(kind).alias("event_type"),
            F.col(ts).alias("event_ts"),
            F.col(ts).cast("date").alias("event_date"),
            "customer_id",
            "seller_id",
            state.alias("order_status"),
            "purchase_ts",
            "approved_ts",
            est.alias("estimated_delivery_ts"),
            *_tail(ts),
        )

    created = rows(o, "oc-", "order_created", "purchase_ts", status, F.col("est_ts"))
    approved = rows(
        o.where("approved_ts is not null"),
        "oa-",
        "order_approved",
        "approved_ts",
        F.lit("approved"),
        F.lit(None).cast("timestamp_ntz"),
    )
    return created.unionByName(approved)


def fact_payments(s: SourceTables) -> DataFrame:
    o = s.order_rows.withColumn(
        "s", F.explode(F.when(F.expr("k%5=0"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    )
    o = o.withColumn("event_ts", F.coalesce("approved_ts", "purchase_ts"))
    return o.select(
        F.concat(F.lit("pp-"), "order_id", F.lit("-"), F.col("s").cast("string")).alias("event_id"),
        "order_id",
        F.col("s").alias("payment_sequential"),
        F.expr("element_at(array('credit_card','boleto','voucher','debit_card'), cast((k+s)%4 as int)+1)").alias("payment_type"),
        F.expr("cast(case when k%97=0 then null when (k+s)%4=0 then 1+k%12 else 1 end as int)").alias("payment_installments"),
        F.expr(
            "cast(cast(floor(o_totalprice/10) as bigint)*0.01"
            "*(case when k%5<>0 then 1.0 when s=1 then 0.8 else 0.2 end) as decimal(18,2))"
        ).alias("payment_value"),
        F.expr("case when k%23=0 then 'failed' else 'approved' end").alias("payment_status"),
        "event_ts",
        F.col("event_ts").cast("date").alias("event_date"),
        "customer_id",
        *_tail("event_ts"),
    )


def fact_delivery_events(s: SourceTables) -> DataFrame:
    o = s.orders_with_seller

    def rows(prefix: str, kind: str, state: str, ts: str, delay: Column) -> DataFrame:
        return o.where(F.col(ts).isNotNull()).select(
            F.concat(F.lit(prefix), "order_id").alias("event_id"),
            "order_id",
            F.lit(kind).alias("event_type"),
            F.lit(state).alias("carrier_status"),
            "shipped_ts",
            F.col("deliv_ts").alias("delivered_customer_ts"),
            delay.cast("decimal(10,2)").alias("delivery_delay_hours"),
            F.col(ts).alias("event_ts"),
            F.col(ts).cast("date").alias("event_date"),
            "seller_id",
            "customer_id",
            *_tail(ts),
        )

    shipped = rows("ds-", "order_shipped", "shipped", "shipped_ts", F.lit(None))
    delivered = rows("dd-", "order_delivered", "delivered", "deliv_ts", F.when(F.expr("k%101<>0"), F.col("delay_h")))
    return shipped.unionByName(delivered)


def fact_reviews(s: SourceTables) -> DataFrame:
    o = s.orders_with_seller.where("deliv_ts is not null and k%4<>0")
    o = o.withColumn("created", plus_hours("deliv_ts", "k%72"))
    return o.select(
        F.concat(F.lit("rv-"), "order_id").alias("event_id"),
        _key("R", "k").alias("review_id"),
        "order_id",
        F.expr("cast(1+(k*13+case when delay_h>0 then 2 else 0 end)%5 as int)").alias("review_score"),
        F.col("created").alias("review_created_ts"),
        F.when(F.expr("k%7<>0"), plus_hours("created", "k%96")).alias("review_answer_ts"),
        F.when(F.expr("k%7<>0"), F.expr("k%96")).cast("decimal(10,2)").alias("review_response_hours"),
        F.when(F.expr("k%3=0"), F.expr("concat('title ', cast(k%11 as string))")).alias("review_comment_title"),
        F.col("created").alias("event_ts"),
        F.col("created").cast("date").alias("event_date"),
        "customer_id",
        "seller_id",
        *_tail("created"),
    )


def fact_order_items(s: SourceTables) -> DataFrame:
    items, orders = s.item_rows, s.order_rows.select("k", "order_id", "purchase_ts")
    return _items(items.join(orders, items.l_orderkey == orders.k))


def items_by_order_id(s: SourceTables) -> DataFrame:
    """The same items, joined on the order's id: a later large join on it finds the rows of an order together."""
    items = s.item_rows.withColumn("order_id", _key("O", "l_orderkey"))
    return _items(items.join(s.order_rows.select("order_id", "purchase_ts"), "order_id"))


def _items(joined: DataFrame) -> DataFrame:
    return joined.select(
        "order_id",
        F.col("l_linenumber").alias("order_item_id"),
        _key("P", "l_partkey").alias("product_id"),
        _key("S", "l_suppkey").alias("seller_id"),
        plus_hours("purchase_ts", "72").alias("shipping_limit_date"),
        F.expr("cast(cast(floor(l_extendedprice) as bigint)*0.01 as decimal(18,2))").alias("price"),
        F.expr("cast(cast(floor(l_quantity*(100+2000*l_tax)) as bigint)*0.01 as decimal(18,2))").alias("freight_value"),
        F.col("purchase_ts").cast("date").alias("event_date"),
    )


def fact_data_quality(s: SourceTables) -> DataFrame:
    """Three sample quality runs over three facts, from their real counts."""

    def counted(name: str, df: DataFrame, checked: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("dataset_name"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(checked).isNull()).alias("bad"),
        )

    per_table = (
        counted("fact_order_events", fact_order_events(s), "seller_id")
        .unionByName(counted("fact_payments", fact_payments(s), "payment_installments"))
        .unionByName(counted("fact_order_items", fact_order_items(s), "price"))
    )
    runs = per_table.withColumn("r", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return runs.select(
        _key("run-", "r").alias("run_id"),
        "dataset_name",
        plus_seconds("timestamp_ntz'2001-12-01 00:00:00'", "86400*r").alias("run_ts"),
        F.col("n").alias("rows_in"),
        (F.col("n") - F.col("bad")).alias("rows_out"),
        F.col("bad").alias("null_violations"),
        F.lit(0).cast("bigint").alias("duplicate_violations"),
        F.lit(0).cast("bigint").alias("schema_violations"),
        F.when((F.col("bad") > 0) & (F.col("r") == 2), "failed").otherwise("success").alias("status"),
    )


BUILDERS: dict[str, Callable[[SourceTables], DataFrame]] = {
    "dim_date": dim_date,
    "dim_customer": dim_customer,
    "dim_seller": dim_seller,
    "dim_product": dim_product,
    "dim_payment_type": dim_payment_type,
    "dim_event_type": dim_event_type,
    "fact_order_events": fact_order_events,
    "fact_payments": fact_payments,
    "fact_delivery_events": fact_delivery_events,
    "fact_reviews": fact_reviews,
    "fact_order_items": fact_order_items,
    "fact_data_quality": fact_data_quality,
}
