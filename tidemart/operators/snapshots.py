"""Side-loaded reference datasets: customer and product details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.schemas import CONTRACT_VERSION

# ---- fixed values: pick lists of the synthetic attributes ---------------------
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA "
    "RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
CITIES = "Ashford Birchwood Cedarville Eastbrook Fairmont Glenhaven Lakeside Maplewood Northfield Oakdale Riverton Westport".split()
BRANDS = "Alder Beacon Cobalt Dune Ember Foxglove Granite Harbor Ivory Juniper Kestrel Lumen Meridian Nimbus Orchard Pinnacle".split()
# -------------------------------------------------------------------------------


def pick(values: list[str], key: str, salt: str) -> Column:
    """A value that depends only on the key: equal ids always get equal values."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{salt}|"), F.col(key)).cast("binary")), 1, 8)
    number = F.conv(digest, 16, 10).cast("bigint")
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _provenance(generated_ts: Column) -> list[Column]:
    return [generated_ts.cast("string").alias("_generated_ts"), F.lit(CONTRACT_VERSION).alias("_contract_version")]


def customer_details(customers: DataFrame, generated_ts: Column) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        pick(STATES, "customer_unique_id", "state").alias("state"),
        pick(CITIES, "customer_unique_id", "city").alias("city"),
        *_provenance(generated_ts),
    )


def product_details(products: DataFrame, translation: DataFrame, generated_ts: Column) -> DataFrame:
    """Products with the translated category; products without one are kept."""
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.col("product_category_name_english").alias("product_category"),
        pick(BRANDS, "product_id", "brand").alias("brand"),
        *_provenance(generated_ts),
    )


def write_snapshot(df: DataFrame, base: str, name: str, day: str) -> None:
    """A dated snapshot as Parquet and JSON Lines, then the ``_latest`` copy of it."""
    for place in (f"dt={day}", "_latest"):
        target = f"{base}/{name}/{place}/{name}"
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{target}.parquet")
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{target}.jsonl")


def read_latest(spark, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}/_latest/{name}.parquet")
