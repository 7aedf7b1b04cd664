"""Analytic plans over the star schema; importing this package registers them."""

from tidemart.plans import (  # noqa: F401
    calendar,
    customers,
    dashboard,
    delivery,
    observability,
    overview,
    products,
    reviews,
    sales,
    sellers,
    statistics,
)
