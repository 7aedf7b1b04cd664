"""Ladders of bucket edges and the expression that applies them."""

from __future__ import annotations

from operator import le, lt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: bucket edges and labels -------------------------------
SPEND = [(50, "< R$50"), (100, "R$50-100"), (200, "R$100-200"), (500, "R$200-500"), (1000, "R$500-1000")]
SPEND_TOP = "R$1000+"
PRICE_SHORT = [(50, "< R$50"), (100, "R$50-100"), (200, "R$100-200"), (500, "R$200-500")]
PRICE_SHORT_TOP = "R$500+"
FREIGHT = [(10, "< R$10"), (20, "R$10-20"), (30, "R$20-30"), (50, "R$30-50"), (100, "R$50-100")]
FREIGHT_TOP = "R$100+"
FREIGHT_SHORT = [(10, "< R$10"), (20, "R$10-20"), (30, "R$20-30"), (50, "R$30-50")]
FREIGHT_SHORT_TOP = "R$50+"
FREIGHT_PCT = [(5, "< 5%"), (10, "5-10%"), (20, "10-20%"), (30, "20-30%"), (50, "30-50%")]
FREIGHT_PCT_TOP = "50%+"
DELAY = [(-48, "2+ days early"), (-24, "1-2 days early"), (0, "On time"), (24, "1 day late"), (48, "1-2 days late")]
DELAY_TOP = "2+ days late"
RESPONSE = [(24, "< 24h"), (48, "24-48h"), (72, "48-72h")]
RESPONSE_TOP = "72h+"
LEAD = [(3, "0-3 days"), (7, "4-7 days"), (14, "8-14 days"), (21, "15-21 days"), (30, "22-30 days")]
LEAD_TOP = "30+ days"
SECOND_ORDER = [(7, "0-7 days"), (14, "8-14 days"), (30, "15-30 days"), (60, "31-60 days"), (90, "61-90 days")]
SECOND_ORDER_TOP = "90+ days"
ORDER_COUNT = [(1, "1 order"), (2, "2 orders"), (3, "3 orders"), (5, "4-5 orders")]
ORDER_COUNT_TOP = "6+ orders"
SELLER_IDLE = [(30, "Active (≤30d)"), (60, "Slowing (31-60d)"), (90, "At Risk (61-90d)")]
SELLER_IDLE_TOP = "Inactive (90d+)"
CUSTOMER_IDLE = [(30, "Active (≤30d)"), (60, "Cooling (31-60d)"), (90, "Dormant (61-90d)"), (180, "At Risk (91-180d)")]
CUSTOMER_IDLE_TOP = "Churned (180d+)"
INSTALLMENTS = [(1, "1 (no split)"), (3, "2-3"), (6, "4-6"), (10, "7-10")]
INSTALLMENTS_TOP = "11+"
# ---------------------------------------------------------------------------


def _ladder(value: Column, steps, top: str, test, null_label: str | None) -> Column:
    chain = None
    if null_label is not None:
        chain = F.when(value.isNull(), null_label)
    for edge, label in steps:
        hit = test(value, F.lit(edge))
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(top)


def below(value: Column, steps, top: str, null_label: str | None = None) -> Column:
    """First label whose edge is above value; NULL falls to ``top`` unless labelled."""
    return _ladder(value, steps, top, lt, null_label)


def up_to(value: Column, steps, top: str, null_label: str | None = None) -> Column:
    """First label whose edge is not below value; NULL falls to ``top`` unless labelled."""
    return _ladder(value, steps, top, le, null_label)
