"""Customer lifetime value."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, quotient, ratio, round_half_up, wide_sum
from tidemark.functions.sizing import cached_for_training
from tidemark.operators.distribution import QUARTILES
from tidemark.operators.features import share_column
from tidemark.operators.ranking import column_quantiles, quantiles
from tidemark.params import Params
from tidemark.session import materialise

# Model inputs (the first category joins them) and the names of the quartiles.
LTV_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "discount_usage_rate",
    "orders_per_month",
    "lifespan_days",
    "recent_spend_ratio",
    "distinct_products_bought",
]
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


def ltv_heuristic(features: DataFrame, p: Params) -> DataFrame:
    """Order value x daily rate x horizon x recency decay x discount haircut, never negative."""
    active = F.greatest(F.coalesce("lifespan_days", F.lit(0)), F.lit(1))
    decay = F.exp(-F.log(F.lit(2.0)) * F.col("recency_days") / F.lit(float(p.half_life_days)))
    haircut = F.lit(1.0) - F.col("discount_usage_rate") / F.lit(100.0) * F.lit(p.haircut)
    value = (
        F.col("avg_order_value")
        * F.col("daily_purchase_rate")
        * F.lit(p.horizon_days)
        * F.col("retention_factor")
        * F.col("discount_ltv_haircut")
    )
    return (
        features.withColumn("active_days", active)
        .withColumn("daily_purchase_rate", quotient(F.col("frequency"), F.col("active_days")))
        .withColumn("retention_factor", decay)
        .withColumn("discount_ltv_haircut", haircut)
        .withColumn("ltv_heuristic", F.greatest(round_half_up(value, 2), F.when(value.isNotNull(), F.lit(0.0))))
    )


def _feature_names(features: DataFrame, p: Params) -> list[str]:
    wanted = [*LTV_FEATURES, share_column(p.categories[0]), "tenure_days"]
    return [c for c in wanted if c in features.columns]


def _assembled(df: DataFrame, names: list[str]) -> DataFrame:
    filled = df.withColumns({f"_{c}": F.coalesce(F.col(c), F.lit(0)).cast("double") for c in names})
    vectors = VectorAssembler(inputCols=[f"_{c}" for c in names], outputCol="_ltv_point").transform(filled)
    return vectors.drop(*[f"_{c}" for c in names])


def in_test_part(p: Params, key: str = "customer_id") -> Column:
    """A reproducible share of the customers, decided by the key alone: no shuffle."""
    slot = F.pmod(F.xxhash64(F.col(key), F.lit(p.seed)), F.lit(10_000))
    return slot < F.lit(int(p.test_fraction * 10_000))


def train_ltv_model(valued: DataFrame, p: Params) -> tuple[GBTRegressionModel, list[str], float, float]:
    """(model, features, MAE, R squared); the error is measured on the held-out customers."""
    names = _feature_names(valued, p)
    data = _assembled(valued, names).withColumn("_test", in_test_part(p))
    data = cached_for_training(data.select("customer_id", "_ltv_point", "ltv_heuristic", "_test"), valued.count(), "customer_id")
    trainer = GBTRegressor(
        featuresCol="_ltv_point",
        labelCol="ltv_heuristic",
        predictionCol="_ltv",
        maxIter=p.ltv_rounds,
        stepSize=0.08,
        maxDepth=4,
        subsamplingRate=0.8,
        seed=p.seed,
    )
    model = trainer.fit(data.filter(~F.col("_test")))
    held_out = model.transform(data.filter("_test"))
    judge = RegressionEvaluator(labelCol="ltv_heuristic", predictionCol="_ltv")
    mae = judge.evaluate(held_out, {judge.metricName: "mae"})
    r2 = judge.evaluate(held_out, {judge.metricName: "r2"})
    data.unpersist()
    return model, names, mae, r2


def ltv_model(valued: DataFrame, p: Params) -> DataFrame:
    _, _, mae, r2 = train_ltv_model(valued, p)
    return valued.sparkSession.createDataFrame([(float(mae), float(r2))], "mae double, r2 double")


def predict_ltv(valued: DataFrame, model: GBTRegressionModel, names: list[str]) -> DataFrame:
    scored = model.transform(_assembled(valued, names))
    return scored.withColumn("ltv_predicted", round_half_up(F.greatest("_ltv", F.lit(0.0)), 2)).drop(
        "_ltv_point", "_ltv"
    )


def ltv_tiers(df: DataFrame, value: str, name: str = "ltv_tier") -> DataFrame:
    """Quartile tier, closed on the right. Tied quartiles leave a tier empty."""
    breaks = quantiles(df, value, QUARTILES).select(F.struct(*QUARTILES)).scalar()
    tier = F.when(F.col(value) > F.col("_breaks.q3"), TIERS[3])
    for quartile, label in (("q1", TIERS[0]), ("median", TIERS[1]), ("q3", TIERS[2])):
        tier = tier.when(F.col(value) <= F.col(f"_breaks.{quartile}"), label)
    return df.withColumn("_breaks", breaks).withColumn(name, tier).drop("_breaks")


def ltv_scored(valued: DataFrame, p: Params) -> DataFrame:
    model, names, _, _ = train_ltv_model(valued, p)
    return ltv_tiers(materialise(predict_ltv(valued, model, names)), "ltv_predicted")


def ltv_tier_summary(df: DataFrame, value: str = "ltv_predicted", tier: str = "ltv_tier") -> DataFrame:
    """All four tiers appear, also without customers."""
    n = F.count(value)
    spend = wide_sum(cents(F.col(value)))
    sums = df.groupBy(tier).agg(
        F.count(F.lit(1)).alias("_n"),
        ratio(spend.cast("double") / 100, n, 0).alias("_mean"),
        ratio(spend, F.lit(100), 0).alias("_sum"),
    )
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in TIERS])).alias(tier))
    return names.join(F.broadcast(sums), tier, "left").select(  # one row per tier
        tier,
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("customers"),
        F.col("_mean").alias("avg_ltv"),
        F.coalesce("_sum", F.lit(0.0)).alias("total_ltv"),
    )


def ltv_axis_limit(df: DataFrame, first: str = "ltv_heuristic", second: str = "ltv_predicted") -> DataFrame:
    tops = column_quantiles(df, [first, second], {"p99": 0.99})
    return tops.select(F.greatest(F.col(f"{first}.p99"), F.col(f"{second}.p99")).alias("axis_limit"))
