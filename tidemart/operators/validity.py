"""Which raw rows a load refuses, with the reason: the declared constraints of the fact tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.operators.facts import stamp
from tidemart.sources.lake import ingest_ts

# ---- fixed values: fields that must be there and ranges, per topic ----------------------
NEEDED = {
    "order_events": ("event_id", "order_id", "event_type"),
    "payment_events": (
        "event_id", "order_id", "payload.payment_sequential", "payload.payment_type", "payload.payment_value", "payload.payment_status",
    ),
    "delivery_events": ("event_id", "order_id", "event_type"),
    "review_events": ("event_id", "order_id", "payload.review_id", "payload.review_score", "payload.review_created_ts"),
    "inventory_events": ("order_id", "payload.order_item_id", "payload.product_id"),
}
NOT_NEGATIVE = {"payment_events": ("payload.payment_value",), "inventory_events": ("payload.price", "payload.freight_value")}
RANGES = {"review_events": (("payload.review_score", 1, 5),)}
# -------------------------------------------------------------------------------------------

#: Reasons that count as missing values in the run record; all others count as broken rules.
MISSING = "missing_"


def _name(path: str) -> str:
    return path.removeprefix("payload.")


def set_aside(topic: str) -> Column:
    """The first constraint a raw row breaks, null if it breaks none."""
    rules: list[tuple[str, Column]] = [("missing_ingest_ts", ingest_ts().isNull())]
    for path in NEEDED[topic]:
        rules.append((MISSING + _name(path), F.coalesce(F.col(path).cast("string"), F.lit("")) == ""))
    rules.append(("missing_event_ts", F.col("event_ts").isNull()))
    rules.append(("unreadable_event_ts", stamp("event_ts").isNull()))
    rules += [(f"negative_{_name(path)}", F.col(path) < 0) for path in NOT_NEGATIVE.get(topic, ())]
    rules += [(f"{_name(path)}_out_of_range", ~F.col(path).between(low, high)) for path, low, high in RANGES.get(topic, ())]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in rules])
