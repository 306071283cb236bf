"""Joining a lookup that is usually small, without assuming that it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def join_lookup(left: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Broadcast ``lookup`` when a count proves it small, else a shuffled join.

    The probe stops after ``BROADCAST_ROWS + 1`` rows. Pass a lookup that is cheap to
    evaluate twice: a materialised frame or an aggregate with few groups.
    """
    few = lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(lookup) if few else lookup, on, how)
