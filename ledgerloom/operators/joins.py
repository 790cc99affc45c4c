"""Joins that a hot key cannot gather in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is hot; so there are at most as many hot keys.
HOT_PART = 1000


def join_one(rows: DataFrame, places: DataFrame, keys: list[str], members: str = "members") -> DataFrame:
    """``rows`` with the one row of ``places`` that has the same ``keys``; rows without one go.

    ``members`` counts the rows of each key. A hot key's place, of which there are ``HOT_PART`` at most, is broadcast, so that its rows stay where they
    are; the others are shuffled. Both inputs are read twice: pass written tables.
    """
    total = places.agg(F.sum(members)).first()[0] or 0
    hot = F.broadcast(places.filter(F.col(members) * HOT_PART > total))
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(places.filter(F.col(members) * HOT_PART <= total), keys))
