"""The transactional source tables: read from CSV, or derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schemas import RELATIONAL
from tidemart.sources import projection as P

Tables = dict[str, DataFrame]


def read_csv_tables(spark: SparkSession, paths: dict[str, str]) -> Tables:
    """Read the named source tables with their declared schemas (no inference).

    A value that does not fit its column's type becomes NULL.  Review titles may
    contain line breaks, so only review files are read whole; all others split.
    """
    return {
        name: spark.read.schema(RELATIONAL[name]).csv(path, header=True, multiLine=name == "reviews", escape='"')
        for name, path in paths.items()
    }


def derived_tables(spark: SparkSession, directory: str) -> Tables:
    """The same tables derived from the order/line-item tables."""
    s = P.SourceTables(spark, directory)
    status = (
        F.when(F.expr("k%20=0"), "canceled")
        .when(F.col("o_orderstatus") == "O", "created")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise("processing")
    )
    orders = s.order_rows.select(
        "order_id",
        "customer_id",
        status.alias("order_status"),
        F.col("purchase_ts").alias("order_purchase_timestamp"),
        F.col("approved_ts").alias("order_approved_at"),
        F.col("shipped_ts").alias("order_delivered_carrier_date"),
        F.col("deliv_ts").alias("order_delivered_customer_date"),
        F.col("est_ts").alias("order_estimated_delivery_date"),
    )
    items = P.items_by_order_id(s).drop("event_date")
    payments = P.fact_payments(s).select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )
    reviews = P.fact_reviews(s).select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        F.col("review_created_ts").alias("review_creation_date"),
        F.col("review_answer_ts").alias("review_answer_timestamp"),
    )
    customers = s.read("customer").select(
        P._key("C", "c_custkey").alias("customer_id"),
        F.expr("concat('U', cast(c_custkey%1000 as string))").alias("customer_unique_id"),
        F.expr("cast(1000000 + c_custkey*7 as string)").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        P._key("ST", "c_nationkey").alias("customer_state"),
    )
    sellers = s.read("supplier").select(
        P._key("S", "s_suppkey").alias("seller_id"),
        F.expr("cast(2000000 + s_suppkey*7 as string)").alias("seller_zip_code_prefix"),
        F.expr("concat('CITY', cast(s_suppkey%7 as string))").alias("seller_city"),
        P._key("ST", "s_nationkey").alias("seller_state"),
    )
    category = F.when(F.expr("p_partkey%50<>0"), F.concat_ws("_", "p_type", "p_brand"))
    products = s.read("part").select(
        P._key("P", "p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.lit(None).cast("string").alias("product_description_lenght"),
        F.expr("cast(p_partkey%6 as string)").alias("product_photos_qty"),
        F.expr("case when p_partkey%13=0 then 'n/a' else cast(p_size*10 as string) end").alias("product_weight_g"),
        F.col("p_size").cast("string").alias("product_length_cm"),
        F.col("p_size").cast("string").alias("product_height_cm"),
        F.col("p_size").cast("string").alias("product_width_cm"),
    )
    # Some categories have no translation, as in real reference data.
    translation = (
        products.where("product_category_name is not null and length(product_category_name)%7 <> 0")
        .select("product_category_name", F.lower("product_category_name").alias("product_category_name_english"))
        .distinct()
    )
    return {
        "orders": orders,
        "items": items,
        "payments": payments,
        "reviews": reviews,
        "customers": customers,
        "sellers": sellers,
        "products": products,
        "translation": translation,
    }
