"""Rows of a large table with ids out of another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids that are broadcast at most; beyond that the join shuffles both sides.
MOST_SENT = 200_000


def of_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi", key: str = "doc_id") -> DataFrame:
    """``docs`` whose id is among ``ids`` (or not, with left_anti).  ``ids`` is counted first and should be a stored table."""
    name = "wanted"
    while name in docs.columns:
        name += "_"
    wanted = ids.select(F.col(ids.columns[0]).alias(name)).where(F.col(name).isNotNull()).distinct()
    few = wanted.limit(MOST_SENT + 1).count() <= MOST_SENT
    return docs.join(F.broadcast(wanted) if few else wanted, F.col(key) == F.col(name), how)
