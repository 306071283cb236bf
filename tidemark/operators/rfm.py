"""Recency, frequency and monetary scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, from_cents, ratio, wide_sum
from tidemark.operators.customers import order_totals
from tidemark.operators.ranking import column_quantiles, with_ntile
from tidemark.params import Params

# Score bands and segment names.
RECENCY_BANDS = [(30, 5), (60, 4), (120, 3), (180, 2)]
FREQUENCY_BANDS = [(20, 5), (12, 4), (6, 3), (2, 2)]
# Segment, then the inclusive range of the recency, frequency and monetary score.
# 'Cannot Lose Them' never applies: 'At Risk' covers it. The order is part of the rule.
SEGMENT_RULES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("Promising", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (3, 5), (1, 2)),
    ("At Risk", (1, 2), (4, 5), (1, 5)),
    ("Cannot Lose Them", (1, 1), (4, 5), (1, 5)),
    ("Hibernating High Value", (1, 2), (1, 2), (3, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
]
OTHER_SEGMENT = "Need Attention"
PERCENTILES = {"p20": 0.2, "p40": 0.4, "p60": 0.6, "p80": 0.8}


def rfm_raw(clean: DataFrame, p: Params) -> DataFrame:
    return order_totals(clean, p).select(
        "customer_id",
        F.datediff(F.lit(p.ref_date), "last_order_date").alias("recency_days"),
        F.col("order_count").alias("frequency"),
        from_cents(F.col("spend_cents")).alias("monetary"),
    )


def recency_score(days: str) -> Column:
    bands = " ".join(f"WHEN {days} <= {limit} THEN {points}" for limit, points in RECENCY_BANDS)
    return F.expr(f"CASE {bands} ELSE 1 END")


def frequency_score(orders: str) -> Column:
    bands = " ".join(f"WHEN {orders} >= {limit} THEN {points}" for limit, points in FREQUENCY_BANDS)
    return F.expr(f"CASE {bands} ELSE 1 END")


def with_band_scores(df: DataFrame) -> DataFrame:
    """Add r, f and m scores to any frame with customer_id and the three raw values."""
    tiled = with_ntile(df, [F.col("monetary"), F.col("customer_id")], 5, "m_score")
    return tiled.withColumns({"r_score": recency_score("recency_days"), "f_score": frequency_score("frequency")})


def rfm_scores(raw: DataFrame) -> DataFrame:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return with_band_scores(raw).select(
        "customer_id",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        ratio(r + f + m, F.lit(3), 2).alias("rfm_avg_score"),
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_cell"),
    )


def segment_label(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """The first rule that matches names the segment."""
    rules = []
    for name, *bands in SEGMENT_RULES:
        inside = [f"{score} BETWEEN {low} AND {high}" for score, (low, high) in zip((r, f, m), bands)]
        rules.append(f"WHEN {' AND '.join(inside)} THEN '{name}'")
    return F.expr(f"CASE {' '.join(rules)} ELSE '{OTHER_SEGMENT}' END")


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("rfm_segment", segment_label())


def rfm_segment_summary(segments: DataFrame) -> DataFrame:
    spend = wide_sum(cents(F.col("monetary")))
    n = F.count(F.lit(1))
    return segments.groupBy("rfm_segment").agg(
        n.alias("customer_count"),
        ratio(F.sum("recency_days"), n, 1).alias("avg_recency_days"),
        ratio(F.sum("frequency"), n, 1).alias("avg_orders"),
        ratio(spend.cast("double") / 100, n, 0).alias("avg_revenue"),
        ratio(spend, F.lit(100), 0).alias("total_revenue"),
    )


def _percentile_score(value: str, ascending: bool) -> Column:
    score = F.lit(5 if ascending else 1)
    for position, name in reversed(list(enumerate(PERCENTILES))):
        points = position + 1 if ascending else 5 - position
        score = F.when(F.col(value) <= F.col(f"_breaks.{value}.{name}"), points).otherwise(score)
    return score


def rfm_percentile_scores(features: DataFrame) -> DataFrame:
    """Scores 1-5 between the 20/40/60/80 percentiles, bins closed on the right.

    Tied break points leave a bin empty instead of failing. The break points are one
    scalar subquery: one row, whatever the size of the table.
    """
    values = ["recency_days", "frequency", "monetary"]
    breaks = column_quantiles(features, values, PERCENTILES).select(F.struct(*values)).scalar()
    scored = features.withColumn("_breaks", breaks).withColumns(
        {
            "r_score": _percentile_score("recency_days", ascending=False),
            "f_score": _percentile_score("frequency", ascending=True),
            "m_score": _percentile_score("monetary", ascending=True),
        }
    )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumns({"rfm_total": total, "rfm_avg": total / F.lit(3)}).drop("_breaks")
