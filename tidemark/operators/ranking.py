"""Global order without a single-partition window.

``row_number() over (order by ...)`` and ``sum() over (order by ...)`` without a
PARTITION BY move the whole table into one task. Here the rows are range-partitioned
on a total order instead, sorted inside each partition and numbered there; what is
left to combine is one row per partition. The numbered rows are checkpointed, because
range boundaries come from a sample and a recomputed sample could move a row.

The order must end in a unique column. That makes the result deterministic, and it
also spreads a value shared by many rows over several range partitions.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

_PLACE = "_place"
_SLICE = "_slice"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_positions(df: DataFrame, order: list[Column], totals: dict[str, str] | None = None) -> DataFrame:
    """Add ``rank`` (1-based) and ``n_rows`` of the global order.

    For every ``name: column`` in ``totals`` (integer columns) also add ``cum_name``,
    the running sum up to and including the row, and ``total_name``.
    """
    totals = totals or {}
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    ).withColumn(_SLICE, F.shiftright(_PLACE, _ROW_BITS).cast("int"))

    # One row per range partition from here on: safe to order globally and to broadcast.
    slices = placed.groupBy(_SLICE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(f"_sum_{n}") for n, c in totals.items()],
    )
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.partitionBy()
    zero = F.lit(0).cast("decimal(38,0)")
    offsets = slices.select(
        _SLICE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(overall).alias("n_rows"),
        *[
            F.coalesce(F.sum(f"_sum_{n}").over(before).cast("decimal(38,0)"), zero).alias(f"_sum_{n}_before")
            for n in totals
        ],
        *[F.sum(f"_sum_{n}").over(overall).cast("decimal(38,0)").alias(f"total_{n}") for n in totals],
    )

    row_in_slice = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = placed.join(F.broadcast(offsets), _SLICE).withColumn(
        "rank", F.col("_rows_before") + row_in_slice + F.lit(1)
    )
    within = Window.partitionBy(_SLICE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    for name, column in totals.items():
        running = F.sum(F.col(column).cast("decimal(20,0)")).over(within)
        ranked = ranked.withColumn(f"cum_{name}", (F.col(f"_sum_{name}_before") + running).cast("decimal(38,0)"))
    return ranked.drop(_PLACE, _SLICE, "_rows_before", *[f"_sum_{n}_before" for n in totals])


def ntile_of(rank: Column, n_rows: Column, tiles: int) -> Column:
    """NTILE from a global rank: the first ``n % tiles`` tiles hold one row more."""
    base = F.floor(n_rows / F.lit(tiles))
    extra = n_rows % F.lit(tiles)
    in_large = extra * (base + F.lit(1))
    large = F.floor((rank - F.lit(1)) / (base + F.lit(1)))
    small = extra + F.floor((rank - F.lit(1) - in_large) / F.greatest(base, F.lit(1)))
    return (F.when(rank <= in_large, large).otherwise(small) + F.lit(1)).cast("int")


def with_ntile(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    return with_positions(df, order).withColumn(name, ntile_of(F.col("rank"), F.col("n_rows"), tiles)).drop(
        "rank", "n_rows"
    )


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per ``by`` group, one column per prob.

    Equal values are collapsed to (value, count) before anything is ordered, so a value
    shared by a third of all rows is a single row of the ordered frame. Groups named in
    ``by`` must be few (labels); NULL values are ignored.
    """
    by = by or []
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    spread = with_positions(counts, [F.col(c) for c in [*by, value]], {"n": "_n"})
    before = F.col("cum_n").cast("bigint") - F.col("_n")
    if by:
        groups = spread.groupBy(*by).agg(F.min(before).alias("_start"), F.sum("_n").alias("_size"))
        spread = spread.join(F.broadcast(groups), by)  # one row per label
    else:
        spread = spread.withColumn("_start", F.lit(0)).withColumn("_size", F.col("total_n").cast("bigint"))
    first = before - F.col("_start")
    last = first + F.col("_n")

    picks, lows, highs = [], {}, {}
    for name, prob in probs.items():
        share = Fraction(str(prob))
        steps = (F.col("_size") - F.lit(1)) * F.lit(share.numerator)
        low = F.floor(steps / F.lit(share.denominator))
        rest = steps % F.lit(share.denominator)
        high = low + F.when(rest > 0, F.lit(1)).otherwise(F.lit(0))
        lows[name], highs[name] = f"_lo_{name}", f"_hi_{name}"
        for index, alias in ((low, lows[name]), (high, highs[name])):
            picks.append(F.max(F.when((first <= index) & (index < last), F.col(value))).alias(alias))
        picks.append(F.max(rest / F.lit(float(share.denominator))).alias(f"_part_{name}"))
    found = spread.groupBy(*by).agg(F.max("_size").alias("n_values"), *picks)
    return found.select(
        *by,
        "n_values",
        *[
            (
                F.col(lows[n]).cast("double")
                + (F.col(highs[n]).cast("double") - F.col(lows[n]).cast("double")) * F.col(f"_part_{n}")
            ).alias(n)
            for n in probs
        ],
    )


def column_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles of several columns in one pass: one row, one struct of ``probs`` per column."""
    pairs = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns]
    long = df.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")
    found = quantiles(long, "_value", probs, by=["_column"])
    return found.agg(
        *[
            F.struct(*[F.max(F.when(F.col("_column") == c, F.col(name))).alias(name) for name in probs]).alias(c)
            for c in columns
        ]
    )
