"""Edges, labels and pick lists that the statements need, spelled out apart from the engine's."""

from __future__ import annotations

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
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA "
    "RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
CITIES = "Ashford Birchwood Cedarville Eastbrook Fairmont Glenhaven Lakeside Maplewood Northfield Oakdale Riverton Westport".split()
BRANDS = "Alder Beacon Cobalt Dune Ember Foxglove Granite Harbor Ivory Juniper Kestrel Lumen Meridian Nimbus Orchard Pinnacle".split()
# ---------------------------------------------------------------------------
