"""Exact interpolated quantiles that never gather a column in one task.

The built-in exact ``percentile`` merges a map of every distinct value into one
buffer.  Here values are counted in parallel and cut into slots by an
order-preserving function of the value alone; a running count over the slots
finds the few that hold the wanted ranks.  Those are cut once more, into equal
steps between their least and greatest value, and only the steps that hold a
wanted rank are ranked value by value.  Many metrics share one count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 64 slots per power of two: a slot spans about 1 % of its values, and all
# doubles together fall into fewer than 300,000 slots.
SLOTS_PER_OCTAVE = 64
ZERO_GAP = 100_000
NO_VALUE = -(1 << 31)  # the slot of NULL
STEPS = 4096


def slot_of(v: Column) -> Column:
    """A slot number that never decreases when the value grows."""
    size = F.floor(F.log2(F.abs(v)) * SLOTS_PER_OCTAVE) + ZERO_GAP
    return F.when(v == 0, 0).when(v > 0, size).otherwise(-size).cast("int")


def value_counts(values: DataFrame) -> DataFrame:
    """Rows (metric, v) collapsed to (metric, v, n); NULL is counted as a value."""
    return values.groupBy("metric", "v").agg(F.count(F.lit(1)).alias("n"))


def _rank(p: float) -> Column:
    return (F.col("total") - 1).cast("double") * F.lit(float(p))


def _holding(cells: DataFrame, within: Sequence[str], number: str, probs: Sequence[float]) -> DataFrame:
    """The cells that hold a wanted rank, two for each probability and metric at most.

    ``before`` values precede the first cell of a group and becomes the count before the cell.
    """
    so_far = Window.partitionBy(*within).orderBy(number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("end", F.col("before") + F.sum("size").over(so_far))
    placed = placed.withColumn("before", F.col("end") - F.col("size"))
    holds = [(F.col("before") <= F.ceil(_rank(p))) & (F.floor(_rank(p)) < F.col("end")) for p in probs]
    return F.broadcast(placed.where(reduce(lambda x, y: x | y, holds)).drop("end", "size"))


def quantiles_by_metric(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per metric that has a value, with columns q0, q1, ... for ``probs``."""
    # The slot is never NULL, so no join adds a filter that would make its scan of the counts another one.
    slotted = counts.withColumn("slot", F.coalesce(slot_of(F.col("v")), F.lit(NO_VALUE)))
    known = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)
    v = F.col("v").cast("double")
    everything = Window.partitionBy("metric").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slots = (
        slotted.groupBy("metric", "slot")
        .agg(F.sum(known).alias("size"), F.min(v).alias("least"), F.max(v).alias("greatest"))
        .withColumn("total", F.sum("size").over(everything))  # slots are few by construction
        .withColumn("before", F.lit(0).cast("bigint"))
    )
    step = F.floor(F.try_divide(v - F.col("least"), F.col("greatest") - F.col("least")) * STEPS)
    stepped = slotted.join(_holding(slots, ["metric"], "slot", probs), ["metric", "slot"]).withColumn(
        "step", F.coalesce(step, F.lit(0).cast("bigint"))
    )
    steps = stepped.groupBy("metric", "slot", "step", "total", "before").agg(F.sum("n").alias("size"))
    wanted = _holding(steps, ["metric", "slot"], "step", probs)

    in_step = Window.partitionBy("metric", "slot", "step").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        stepped.select("metric", "slot", "step", "v", "n")
        .join(wanted, ["metric", "slot", "step"])
        .withColumn("upto", F.col("before") + F.sum("n").over(in_step))
        .withColumn("since", F.col("upto") - F.col("n"))
    )

    def at(r: Column) -> Column:
        return F.max(F.when((F.col("since") <= r) & (r < F.col("upto")), v))

    out = []
    for i, p in enumerate(probs):
        low, high = at(F.floor(_rank(p))), at(F.ceil(_rank(p)))
        part = F.max(_rank(p) - F.floor(_rank(p)))
        out.append((low + (high - low) * part).alias(f"q{i}"))
    return placed.groupBy("metric").agg(*out)


def exact_quantiles(df: DataFrame, value: Column, probs: Sequence[float]) -> DataFrame:
    """One row with columns q0, q1, ... for ``probs``; NULL over an empty input."""
    counts = value_counts(df.select(F.lit("").alias("metric"), value.cast("double").alias("v")))
    return quantiles_by_metric(counts, probs).agg(*[F.max(f"q{i}").alias(f"q{i}") for i in range(len(probs))])
