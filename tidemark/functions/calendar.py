"""Month arithmetic on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(day: Column) -> Column:
    """Months since year 0, so that a difference counts calendar months."""
    return F.year(day) * F.lit(12) + F.month(day)


def label_of_index(index: Column) -> Column:
    """'YYYY-MM' of a value made by :func:`month_index`."""
    zero_based = index - F.lit(1)
    year = F.floor(zero_based / F.lit(12)).cast("int")
    month = F.pmod(zero_based, F.lit(12)) + F.lit(1)
    return F.when(index.isNotNull(), F.format_string("%04d-%02d", year, month))
