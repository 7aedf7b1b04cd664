"""Mix sources to target weights by capped water-filling, then sample whole and fractional repetitions.

A source's target is its share of the total by weight, but never above
``max_epochs`` times its size; what a clamped source cannot take is shared among
the others by weight until none is above its cap.  With the sources sorted by
cap over weight, the clamped ones are a prefix, so the water level follows from
running sums over the list of sources, which has one row per source.

Each document is taken ``floor(target / size of its source)`` times.  The rest of
the target is a seeded sample: documents in the order of a hash of their id, as
long as the middle of a document lies below the rest.  A source so misses its
target by half a document at most; rows that agree in id, source and size are
one document there and are taken alike.  The running sums are made in hash buckets of
a source, so that a source with a third of all rows is spread over many tasks.

Null texts have no words; a null source is a source of its own; a null id is
hashed as the empty string.  Documents without words are never taken.  An empty table gives an empty result.
Columns of the input other than the id, text and source pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept

WORD = r"[^\x20\x09-\x0D]+"
#: Hash buckets a source is split into, as hexadecimal digits of the hash.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights for a table of sources: the cycle repeats over their names by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).cast("long"))


def targets(sources: DataFrame, max_epochs: int = 3, share: float = 1.0) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): the capped water level by running sums over the sources."""
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.col("total") - F.col("capped")) / F.col("open")
    return (
        sources.withColumn("cap", max_epochs * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # the first source whose cap is above the level ends the clamped prefix
        .withColumn("level", F.min(F.when(F.col("ratio") >= level, F.struct("ratio", F.col("source").isNull().alias("last"), "source", (F.col("total") - F.col("capped")).alias("rest"), "open"))).over(every))
        .withColumn("filled", (F.col("level")["rest"] * F.col("weight")) / F.col("level")["open"])
        .select("source", "source_size", "weight", F.coalesce(F.least(F.col("cap").cast("double"), F.col("filled")), F.col("cap").cast("double")).alias("target"))
    )


def repetitions(sized: DataFrame, weights: DataFrame | None = None, max_epochs: int = 3, seed: str = "mix-1", share: float = 1.0) -> DataFrame:
    """The (doc_id, source, size) of all rows with ``rows`` that share them, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``weights`` has (source, weight); without it the weights 1, 2, 3 repeat.  A
    source missing there weighs nothing and is not taken.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighted = cycled_weights(totals)
    else:
        named = weights.select(F.col("source").alias("named"), F.col("weight").cast("long").alias("weight")).where("weight > 0")
        weighted = totals.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    plan = targets(weighted, max_epochs, share).select(F.col("source").alias("plan_source"), "source_size", "target")

    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = units.withColumn("place", digest).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)).withColumn("words", F.col("size") * F.col("rows"))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("words").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start")
    )
    starts = starts.join(plan, F.col("s").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner_start", F.coalesce(F.sum("words").over(within), F.lit(0)))
    joined = placed.join(starts, (F.col("bucket") == F.col("b")) & F.col("source").eqNullSafe(F.col("s")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    middle = F.col("bucket_start") + F.col("inner_start") + F.col("words") / F.lit(2.0)
    return (
        joined.withColumn("whole", whole)
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.when(middle < rest, 1).otherwise(0)).otherwise(0).cast("long"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("doc_id", "source", "size", "rows", "source_size", "target", "copies", "taken")
    )


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = 3, seed: str = "mix-1") -> DataFrame:
    """The mixture itself: each taken document once per repetition, with the number of the ``copy`` (an input column of that name gives way)."""
    own = [c for c in docs.columns if c != "copy"]
    taken = kept(repetitions(sizes(docs), weights, max_epochs, seed).where("copies > 0").select("doc_id", "source", "size", "copies"), "mix")
    rows = docs.select(F.struct(*own).alias("row"), word_count(F.col("text")).alias("words")).alias("d")
    match = F.col("row.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("row.source").eqNullSafe(F.col("t.source")) & (F.col("words") == F.col("t.size"))
    joined = rows.join(taken.alias("t"), match)
    return joined.select("row.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("t.copies"))).alias("copy"))
