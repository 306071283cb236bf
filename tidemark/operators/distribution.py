"""Box-plot statistics, histograms and trend lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WHISKER = 1.5


def box_stats(df: DataFrame, value: str, by: str, descending: bool = False) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``value`` per label, numbered by median.

    The whiskers are the outermost values within 1.5 IQR of the box, never inside it.
    """
    boxes = quantiles(df, value, QUARTILES, by=[by])
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    fenced = boxes.withColumn("_low", F.col("q1") - reach).withColumn("_high", F.col("q3") + reach)
    v = F.col(value).cast("double")
    spread = (
        df.filter(v.isNotNull())
        .join(F.broadcast(fenced.select(by, "_low", "_high")), by)  # one row per label
        .groupBy(by)
        .agg(
            F.min(F.when(v >= F.col("_low"), v)).alias("_least"),
            F.max(F.when(v <= F.col("_high"), v)).alias("_most"),
            F.sum(F.when((v < F.col("_low")) | (v > F.col("_high")), 1).otherwise(0)).alias("outliers"),
        )
    )
    median = F.col("median").desc() if descending else F.col("median")
    return boxes.join(F.broadcast(spread), by).select(
        by,
        F.col("n_values").alias("customers"),
        "q1",
        "median",
        "q3",
        F.least("_least", "q1").alias("whisker_low"),
        F.greatest("_most", "q3").alias("whisker_high"),
        "outliers",
        F.row_number().over(Window.orderBy(median, by)).alias("position"),
    )


def histogram(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each label.

    Empty bins are listed, the last bin is closed, and a label with a single value gets
    a range of one around it.
    """
    v = F.col(value).cast("double")
    ends = (
        df.filter(v.isNotNull() & F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.min(v).alias("least"), F.max(v).alias("most"))
        .select(
            by,
            F.when(F.col("least") == F.col("most"), F.col("least") - 0.5).otherwise(F.col("least")).alias("_from"),
            F.when(F.col("least") == F.col("most"), F.col("most") + 0.5).otherwise(F.col("most")).alias("_to"),
        )
    )
    width = F.col("_to") - F.col("_from")
    index = F.least(F.floor((v - F.col("_from")) / width * bins), F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(v.isNotNull())
        .join(F.broadcast(ends), by)  # one row per label
        .groupBy(by, index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    edges = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return edges.join(F.broadcast(counted), [by, "bin"], "left").select(
        by,
        "bin",
        (F.col("_from") + width * F.col("bin") / bins).alias("bin_from"),
        (F.col("_from") + width * (F.col("bin") + 1) / bins).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("customers"),
    )


def linear_trend(df: DataFrame, y: str, x: str, by: str | None = None) -> DataFrame:
    """Least-squares line of ``y`` over ``x`` (a missing ``x`` counts as 0)."""
    filled = F.coalesce(F.col(x), F.lit(0.0)).cast("double")
    target = F.col(y).cast("double")
    return df.groupBy(*([by] if by else [])).agg(
        F.regr_slope(target, filled).alias("slope"),
        F.regr_intercept(target, filled).alias("intercept"),
        F.regr_count(target, filled).alias("customers"),
    )
