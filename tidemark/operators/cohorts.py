"""Monthly acquisition cohorts.

Orders are reduced to one row per customer and month before any window or join. A
customer has at most one row per calendar month then, the distinct-customer counts
become plain counts, and the size of a cohort is its number of period-0 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import label_of_index, month_index
from tidemark.functions.fixedpoint import micros, quotient, ratio, scaled, wide_sum
from tidemark.operators.customers import repeat_rows
from tidemark.params import Params

HEATMAP_COHORTS = 24
HEATMAP_PERIODS = 19


def cohort_base(clean: DataFrame) -> DataFrame:
    first = clean.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    return first.select("customer_id", F.date_format("first_order_date", "yyyy-MM").alias("cohort_month"))


def _customer_months(orders: DataFrame) -> DataFrame:
    """customer_id, month, orders, spend (millionths), cohort, period_number."""
    months = (
        orders.withColumn("month", month_index(F.col("order_date")))
        .groupBy("customer_id", "month")
        .agg(F.count(F.lit(1)).alias("orders"), wide_sum(micros(F.col("total_amount"))).alias("spend"))
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    return months.withColumn("cohort", first).withColumn("period_number", F.col("month") - F.col("cohort"))


def cohort_activity(clean: DataFrame) -> DataFrame:
    """One row per order."""
    months = _customer_months(clean).select(
        "customer_id",
        label_of_index(F.col("cohort")).alias("cohort_month"),
        label_of_index(F.col("month")).alias("order_month"),
        "period_number",
        "orders",
    )
    return repeat_rows(months, "orders")


def cohort_sizes(clean: DataFrame) -> DataFrame:
    return cohort_base(clean).groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))


def _cohort_periods(orders: DataFrame, p: Params) -> DataFrame:
    """One row per cohort and period: a few hundred rows."""
    cells = (
        _customer_months(orders)
        .filter(F.col("cohort").isNotNull() & F.col("period_number").between(0, p.max_period))
        .groupBy("cohort", "period_number")
        .agg(F.count("customer_id").alias("active_customers"), F.sum("spend").alias("spend"))
    )
    newcomers = F.when(F.col("period_number") == 0, F.col("active_customers"))
    return cells.withColumn("cohort_size", F.max(newcomers).over(Window.partitionBy("cohort"))).withColumn(
        "cohort_month", label_of_index(F.col("cohort"))
    )


def cohort_retention(orders: DataFrame, p: Params) -> DataFrame:
    """Pass clean orders, or the base orders (dates unfiltered) for the alternative table."""
    return _cohort_periods(orders, p).select(
        "cohort_month",
        "period_number",
        "active_customers",
        "cohort_size",
        ratio(F.col("active_customers") * 100, F.col("cohort_size"), 1).alias("retention_rate_pct"),
    )


def cohort_revenue(clean: DataFrame, p: Params) -> DataFrame:
    return _cohort_periods(clean, p).select(
        "cohort_month",
        "period_number",
        "cohort_size",
        ratio(F.col("spend").cast("double") / 1_000_000, F.col("cohort_size"), 2).alias("avg_revenue_per_customer"),
    )


def avg_retention_curve(retention: DataFrame) -> DataFrame:
    tenths = F.sum(scaled(F.col("retention_rate_pct"), 1))
    return retention.groupBy("period_number").agg(
        ratio(tenths, F.count(F.lit(1)) * 10, 1).alias("avg_retention_pct"),
        F.count(F.lit(1)).alias("cohorts_included"),
    )


def retention_curve_first_year(retention: DataFrame) -> DataFrame:
    """The unrounded curve of the first twelve months."""
    tenths = F.sum(scaled(F.col("retention_rate_pct"), 1))
    return (
        retention.filter(F.col("period_number") <= 12)
        .groupBy("period_number")
        .agg(quotient(tenths, F.count(F.lit(1)) * 10).alias("retention_rate_pct"))
    )


def retention_matrix(retention: DataFrame) -> DataFrame:
    """Latest cohorts by period; an absent cell is NULL."""
    periods = list(range(HEATMAP_PERIODS))
    wide = retention.groupBy("cohort_month").pivot("period_number", periods).agg(F.max("retention_rate_pct"))
    named = wide.select("cohort_month", *[F.col(str(n)).alias(f"p{n}") for n in periods])
    return named.orderBy(F.col("cohort_month").desc()).limit(HEATMAP_COHORTS)
