"""Report figures and dashboard queries over the customer master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, from_cents, quotient, ratio, scaled, wide_sum
from tidemark.operators.churn import RISK_TIERS
from tidemark.operators.ltv import TIERS
from tidemark.operators.ranking import quantiles, with_positions

# Report rates and sizes of the dashboard extracts.
CHURN_CUT = 0.05
SAVE_RATE = 0.20
LAKH = 1e5
RFM_SAMPLE, RFM_SEED = 2_000, 42
DISCOUNT_SAMPLE, DISCOUNT_SEED = 1_500, 1
EXPLORER_ROWS = 200
EXPLORER_COLUMNS = [
    "customer_id",
    "city",
    "segment_label",
    "churn_risk_tier",
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "discount_usage_rate",
    "churn_prob",
    "ltv_predicted",
    "ltv_tier",
]


def _mean_cents(total: Column, n: Column) -> Column:
    return quotient(total, n * 100)


def _money_if(rule: Column, value: str = "monetary") -> Column:
    return F.coalesce(wide_sum(F.when(rule, cents(F.col(value)))), F.lit(0))


def top_fifth_revenue(master: DataFrame) -> DataFrame:
    """Revenue (cents) of the floor(n / 5) largest spenders."""
    spend = master.select("customer_id", cents(F.col("monetary")).alias("_cents"))
    placed = with_positions(spend, [F.col("_cents").desc(), F.col("customer_id")])
    return placed.filter(F.col("rank") * 5 <= F.col("n_rows")).agg(
        F.coalesce(wide_sum(F.col("_cents")), F.lit(0)).alias("top_cents")
    )


def mean_retention(retention: DataFrame, period: int) -> DataFrame:
    """Unweighted mean over the cohorts that reached ``period``; 0 without cohorts."""
    reached = retention.filter(F.col("period_number") == period)
    rate = quotient(F.sum(scaled(F.col("retention_rate_pct"), 1)), F.count(F.lit(1)) * 10)
    return reached.agg(F.coalesce(rate, F.lit(0.0)).alias("rate"))


def report_kpis(master: DataFrame, retention: DataFrame) -> DataFrame:
    """One row: the master is aggregated once, the rest are one-row scalar subqueries."""
    churned = F.col("is_churned")
    tier, spend = F.col("churn_risk_tier"), cents(F.col("monetary"))
    sums = master.agg(
        F.count(F.lit(1)).alias("n"),
        wide_sum(spend).alias("spend"),
        wide_sum(cents(F.col("avg_order_value"))).alias("aov"),
        F.sum(churned.cast("bigint")).alias("churned"),
        F.count(F.when(tier == RISK_TIERS[2], 1)).alias("high_risk"),
        F.count(F.when(tier == RISK_TIERS[1], 1)).alias("medium_risk"),
        F.sum(scaled(F.col("discount_usage_rate"), 2)).alias("discount"),
        _money_if(churned == 1).alias("churned_spend"),
        _money_if(churned == 0).alias("active_spend"),
        _money_if(F.col("ltv_tier") == TIERS[3]).alias("platinum_spend"),
    ).withColumns(
        {
            "top": top_fifth_revenue(master).scalar(),
            "median_recency_days": quantiles(master, "recency_days", {"median": 0.5}).select("median").scalar(),
            "month1_retention_pct": mean_retention(retention, 1).scalar(),
            "month3_retention_pct": mean_retention(retention, 3).scalar(),
        }
    )
    n = F.col("n")
    return sums.select(
        n.alias("total_customers"),
        from_cents(F.col("spend")).alias("total_revenue"),
        _mean_cents(F.col("spend"), n).alias("avg_customer_revenue"),
        _mean_cents(F.col("aov"), n).alias("avg_order_value"),
        "median_recency_days",
        from_cents(F.col("top")).alias("top20_revenue"),
        (quotient(F.col("top"), F.col("spend")) * 100).alias("top20_share_pct"),
        (quotient(F.col("churned"), n) * 100).alias("churn_rate_pct"),
        "high_risk",
        "medium_risk",
        _mean_cents(F.col("discount"), n).alias("mean_discount_rate_pct"),
        _mean_cents(F.col("churned_spend"), F.col("churned")).alias("churned_avg_revenue"),
        _mean_cents(F.col("active_spend"), n - F.col("churned")).alias("active_avg_revenue"),
        "month1_retention_pct",
        "month3_retention_pct",
        F.coalesce(quotient(F.col("platinum_spend"), F.col("spend")) * 100, F.lit(0.0)).alias("platinum_share_pct"),
    )


def report_derived_kpis(master: DataFrame, retention: DataFrame) -> DataFrame:
    """Protected revenue, at-risk pipeline and win-back value in lakh, and early churn."""
    high = F.col("churn_risk_tier") == RISK_TIERS[2]
    at_risk = F.coalesce(F.col("churn_risk_tier"), F.lit("")) != RISK_TIERS[0]
    sums = master.agg(
        _money_if(at_risk).alias("at_risk"),
        F.count(F.when(high, 1)).alias("high_risk"),
        F.count(F.when(high, F.col("ltv_predicted"))).alias("valued"),
        _money_if(high, "ltv_predicted").alias("high_ltv"),
    ).withColumns({"top": top_fifth_revenue(master).scalar(), "m1": mean_retention(retention, 1).scalar()})
    mean_ltv = F.coalesce(_mean_cents(F.col("high_ltv"), F.col("valued")), F.lit(0.0))
    return sums.select(
        (from_cents(F.col("top")) * CHURN_CUT / LAKH).alias("protected_revenue_lakh"),
        (from_cents(F.col("at_risk")) / LAKH).alias("at_risk_pipeline_lakh"),
        (mean_ltv * F.col("high_risk") * SAVE_RATE / LAKH).alias("win_back_lakh"),
        (F.lit(100.0) - F.col("m1")).alias("month1_churn_pct"),
    )


def report_segment_table(summary: DataFrame, label: str = "segment_label") -> DataFrame:
    order = F.row_number().over(Window.orderBy(F.col("total_revenue").desc(), label))  # one row per label
    return summary.select(
        order.alias("position"), label, "customer_count", ratio(F.col("avg_revenue"), F.lit(1), 0).alias("avg_revenue"),
        "revenue_share_pct",
    )


def customer_filter(
    master: DataFrame,
    city: str | None = None,
    segment: str | None = None,
    risk: str | None = None,
    min_revenue: float | None = None,
    max_revenue: float | None = None,
) -> DataFrame:
    """Customers that match every given criterion; None or 'All' does not restrict."""
    kept = master
    for column, wanted in (("city", city), ("segment_label", segment), ("churn_risk_tier", risk)):
        if wanted not in (None, "All"):
            kept = kept.filter(F.col(column) == wanted)
    if min_revenue is not None:
        kept = kept.filter(F.col("monetary") >= min_revenue)
    if max_revenue is not None:
        kept = kept.filter(F.col("monetary") <= max_revenue)
    return kept


def filter_domains(master: DataFrame) -> DataFrame:
    """What the filters can be set to: cities, segments and the revenue bounds."""
    none = F.lit(None).cast("double")

    def values(column: str) -> DataFrame:
        found = master.filter(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
        return found.select(F.lit(column).alias("domain"), "value", none.alias("bound"))

    ends = master.agg(F.min("monetary").alias("least"), F.max("monetary").alias("most"))
    bounds = ends.select(
        F.explode(F.array(F.struct(F.lit("min").alias("value"), F.col("least").alias("bound")),
                          F.struct(F.lit("max").alias("value"), F.col("most").alias("bound")))).alias("_b")
    ).select(F.lit("monetary").alias("domain"), "_b.value", "_b.bound")
    return values("city").unionByName(values("segment_label")).unionByName(bounds)


def dashboard_kpis(master: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return master.agg(
        n.alias("customers"),
        from_cents(wide_sum(cents(F.col("monetary")))).alias("total_revenue"),
        _mean_cents(wide_sum(cents(F.col("avg_order_value"))), n).alias("avg_order_value"),
        (quotient(F.sum("is_churned"), n) * 100).alias("churn_rate_pct"),
        F.count(F.when(F.col("churn_risk_tier") == RISK_TIERS[2], 1)).alias("high_risk"),
        _mean_cents(wide_sum(cents(F.col("ltv_predicted"))), F.count("ltv_predicted")).alias("avg_ltv"),
        quotient(F.sum("recency_days"), F.count("recency_days")).alias("avg_recency_days"),
    )


def segment_revenue_share(master: DataFrame) -> DataFrame:
    sums = master.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customers"), wide_sum(cents(F.col("monetary"))).alias("_cents")
    )
    share = quotient(F.col("_cents"), F.sum("_cents").over(Window.partitionBy())) * 100
    return sums.select(
        "segment_label", "customers", from_cents(F.col("_cents")).alias("revenue"), share.alias("revenue_share_pct")
    )


def seeded_sample(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` customers, the smallest by a seeded hash of the id."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("customer_id").cast("string")))
    return df.withColumn("_draw", draw).orderBy("_draw", "customer_id").limit(rows).drop("_draw")


def rfm_sample(master: DataFrame) -> DataFrame:
    """Scatter sample; the marker size is the revenue capped at the sample's 99th percentile."""
    columns = ["customer_id", "segment_label", "recency_days", "frequency", "monetary"]
    sample = seeded_sample(master.select(*columns), RFM_SAMPLE, RFM_SEED)
    cap = quantiles(sample, "monetary", {"p99": 0.99}).select("p99").scalar()
    return sample.withColumn("_cap", cap).select(
        *columns, F.greatest(F.lit(0.0), F.least("monetary", "_cap")).alias("marker_size")
    )


def discount_sample(master: DataFrame) -> DataFrame:
    columns = ["customer_id", "segment_label", "discount_usage_rate", "monetary"]
    return seeded_sample(master.select(*columns), DISCOUNT_SAMPLE, DISCOUNT_SEED)


def median_ltv_by_segment(master: DataFrame) -> DataFrame:
    return quantiles(master, "ltv_predicted", {"median_ltv": 0.5}, by=["segment_label"]).drop("n_values")


def discount_by_segment(master: DataFrame) -> DataFrame:
    n = F.count("discount_usage_rate")
    mean = _mean_cents(F.sum(scaled(F.col("discount_usage_rate"), 2)), n)
    return master.groupBy("segment_label").agg(mean.alias("avg_discount_rate"))


def customer_explorer(master: DataFrame) -> DataFrame:
    columns = [c for c in EXPLORER_COLUMNS if c in master.columns]
    return master.select(*columns).orderBy(F.col("ltv_predicted").desc(), "customer_id").limit(EXPLORER_ROWS)


def dashboard_segment_table(master: DataFrame) -> DataFrame:
    """Eight figures per segment with one decimal; the share uses the rounded total."""
    n = F.count(F.lit(1))
    spend = wide_sum(cents(F.col("monetary")))
    probability = wide_sum(scaled(F.col("churn_prob"), 9)).cast("double") / 1e9
    table = master.groupBy("segment_label").agg(
        n.alias("customers"),
        ratio(F.sum("recency_days"), n, 1).alias("avg_recency"),
        ratio(F.sum("frequency"), n, 1).alias("avg_orders"),
        ratio(spend.cast("double") / 100, n, 1).alias("avg_revenue"),
        ratio(spend, F.lit(100), 1).alias("total_revenue"),
        ratio(F.sum(scaled(F.col("discount_usage_rate"), 2)).cast("double") / 100, n, 1).alias("avg_discount_rate"),
        ratio(probability, F.count("churn_prob"), 1).alias("avg_churn_prob"),
        ratio(wide_sum(cents(F.col("ltv_predicted"))).cast("double") / 100, F.count("ltv_predicted"), 1).alias(
            "avg_ltv"
        ),
        spend.alias("_cents"),
    )
    overall = from_cents(F.sum("_cents").over(Window.partitionBy()))
    return table.withColumn("revenue_share_pct", ratio(F.col("total_revenue") * 100, overall, 1)).drop("_cents")


def dataset_summary(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of every dataset."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in datasets.items()
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
