"""Named plans over the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemart.sources.star import Star

PLANS: dict[str, Callable[[Star], DataFrame]] = {}


def plan(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a plan under its function name."""
    if fn.__name__ in PLANS:
        raise ValueError(f"duplicate plan {fn.__name__}")
    PLANS[fn.__name__] = fn
    return fn
