"""Behavioural segments: scaling, K-Means, labelling and the Pareto view."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, from_cents, quotient, ratio, scaled, wide_sum
from tidemark.functions.sizing import cached_for_training
from tidemark.operators import lloyd
from tidemark.operators.ranking import with_positions
from tidemark.params import Params

# Clustering inputs, score weights and the label (with its colour) by rank.
CLUSTER_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "discount_usage_rate",
    "orders_per_month",
    "recent_spend_ratio",
]
SCORE_WEIGHTS = {"recency": 0.30, "frequency": 0.30, "monetary": 0.25, "discount": 0.15}
LABELS_BY_RANK = [
    ("Champions", "#2ECC71"),
    ("Loyal Customers", "#3498DB"),
    ("Promising", "#F39C12"),
    ("Discount Dependent", "#E67E22"),
    ("At Risk", "#E74C3C"),
    ("Lost / Inactive", "#95A5A6"),
    ("Need Attention", "#9B59B6"),
]
SWEEP = range(3, 9)
SWEEP_RESTARTS = 10
SWEEP_ITERATIONS = 300


def z_name(column: str) -> str:
    return f"{column}_z"


def z_scores(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_z``: distance from the mean in population standard deviations.

    NULL counts as 0, and a constant column is only centred. Mean and deviation come from
    ``fit_on`` (default: the frame itself) as one scalar subquery.
    """
    value = {c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in columns}
    moments = (df if fit_on is None else fit_on).agg(
        F.struct(
            *[F.avg(value[c]).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(value[c]).alias(f"std_{c}") for c in columns],
        ).alias("moments")
    )

    def z(column: str) -> Column:
        std = F.col(f"_moments.std_{column}")
        return (value[column] - F.col(f"_moments.mean_{column}")) / F.when(std == 0, F.lit(1.0)).otherwise(std)

    with_moments = df.withColumn("_moments", moments.scalar())
    return with_moments.withColumns({z_name(c): z(c) for c in columns}).drop("_moments")


def scaled_features(features: DataFrame) -> DataFrame:
    return z_scores(features, CLUSTER_FEATURES).select("customer_id", *[z_name(c) for c in CLUSTER_FEATURES])


def _points(features: DataFrame) -> DataFrame:
    columns = [z_name(c) for c in CLUSTER_FEATURES]
    scaled_rows = z_scores(features, CLUSTER_FEATURES)
    return scaled_rows.withColumn("_point", F.array(*columns)).drop(*columns)


def _cheapest(fits: list[lloyd.Fit]) -> lloyd.Fit:
    return min(fits, key=lambda found: found.cost)


def kmeans_k_sweep(features: DataFrame, p: Params, restarts: int = SWEEP_RESTARTS) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) for k = 3..8.

    All starts of all k share their passes; the silhouettes of the six best fits are independent jobs.
    """
    placed = _points(features).select("customer_id", "_point")
    points = cached_for_training(placed.withColumn("_key", F.col("customer_id")), features.count(), "_key")
    starts = [(k, p.seed + n) for k in SWEEP for n in range(restarts)]
    fits = lloyd.fit(points, "customer_id", "_point", starts, SWEEP_ITERATIONS)
    best = {k: _cheapest([found for (size, _), found in zip(starts, fits) if size == k]) for k in SWEEP}
    judge = ClusteringEvaluator(featuresCol="_vector", predictionCol="cluster_id")

    def silhouette(k: int) -> float:
        placed = points.select(array_to_vector("_point").alias("_vector"), lloyd.nearest("_point", best[k].centres).alias("cluster_id"))
        return float(judge.evaluate(placed))

    with ThreadPoolExecutor(len(SWEEP)) as pool:
        judged = dict(zip(SWEEP, pool.map(silhouette, SWEEP)))
    points.unpersist()
    rows = [(k, best[k].cost, judged[k]) for k in SWEEP]
    return features.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def cluster_profiles(clustered: DataFrame) -> DataFrame:
    """Mean behaviour per cluster, its composite score, rank and label.

    A pure function of (cluster_id, features): one row per cluster. Each mean is scaled to
    0..1 over the clusters; a metric equal in all clusters stays as it is.
    """
    n = F.count(F.lit(1))
    means = clustered.groupBy("cluster_id").agg(
        n.alias("customers"),
        quotient(F.sum("recency_days"), n).alias("recency"),
        quotient(F.sum("frequency"), n).alias("frequency"),
        quotient(wide_sum(cents(F.col("monetary"))), n * 100).alias("monetary"),
        quotient(F.sum(scaled(F.col("discount_usage_rate"), 2)), n * 100).alias("discount"),
    )
    clusters = Window.partitionBy()  # as many rows as clusters

    def unit(metric: str) -> Column:
        low, high = F.min(metric).over(clusters), F.max(metric).over(clusters)
        return F.when(high > low, (F.col(metric) - low) / (high - low)).otherwise(F.col(metric))

    scored = means.select("*", *[unit(m).alias(f"_{m}") for m in SCORE_WEIGHTS]).withColumn(
        "score",
        (F.lit(1.0) - F.col("_recency")) * SCORE_WEIGHTS["recency"]
        + F.col("_frequency") * SCORE_WEIGHTS["frequency"]
        + F.col("_monetary") * SCORE_WEIGHTS["monetary"]
        + (F.lit(1.0) - F.col("_discount")) * SCORE_WEIGHTS["discount"],
    )
    ties = F.count(F.lit(1)).over(Window.partitionBy("score"))
    mean_rank = F.rank().over(Window.orderBy(F.col("score").desc())) + F.floor((ties - 1) / F.lit(2))
    last = len(LABELS_BY_RANK)
    names = F.array(*[F.lit(name) for name, _ in LABELS_BY_RANK])
    colours = F.array(*[F.lit(colour) for _, colour in LABELS_BY_RANK])
    ranked = scored.withColumn("cluster_rank", mean_rank.cast("int"))
    place = F.least(F.col("cluster_rank"), F.lit(last))
    return ranked.select(
        "cluster_id",
        "customers",
        F.col("recency").alias("avg_recency_days"),
        F.col("frequency").alias("avg_orders"),
        F.col("monetary").alias("avg_revenue"),
        F.col("discount").alias("avg_discount_rate"),
        "score",
        "cluster_rank",
        F.element_at(names, place).alias("segment_label"),
        F.element_at(colours, place).alias("segment_color"),
    )


def kmeans_segments(features: DataFrame, p: Params) -> DataFrame:
    """Features plus cluster_id, segment_label and segment_color.

    ``features`` is read several times: pass a materialised table. The assignment is a
    projection of it, and the label lookup has one row per cluster: nothing is shuffled.
    """
    points = _points(features)
    placed = points.select(F.col("customer_id").alias("_key"), "customer_id", "_point")
    training = cached_for_training(placed, features.count(), "_key")
    starts = [(p.n_clusters, p.seed + n) for n in range(p.kmeans_restarts)]
    best = _cheapest(lloyd.fit(training, "customer_id", "_point", starts, p.kmeans_iterations))
    training.unpersist()
    clustered = points.withColumn("cluster_id", lloyd.nearest("_point", best.centres)).drop("_point")
    labels = cluster_profiles(clustered).select("cluster_id", "segment_label", "segment_color")
    return clustered.join(F.broadcast(labels), "cluster_id").select(*features.columns, *labels.columns)


def segment_summary(df: DataFrame, label: str = "segment_label") -> DataFrame:
    spend = wide_sum(cents(F.col("monetary")))
    n = F.count(F.lit(1))
    sums = df.groupBy(label).agg(
        n.alias("customer_count"),
        ratio(F.sum("recency_days"), n, 1).alias("avg_recency_days"),
        ratio(F.sum("frequency"), n, 1).alias("avg_orders"),
        ratio(spend.cast("double") / 100, n, 1).alias("avg_revenue"),
        ratio(spend, F.lit(100), 1).alias("total_revenue"),
        ratio(F.sum(scaled(F.col("discount_usage_rate"), 2)).cast("double") / 100, n, 1).alias("avg_discount_pct"),
        spend.alias("_cents"),
    )
    share = ratio(F.col("_cents").cast("double") * 100, F.sum("_cents").over(Window.partitionBy()), 1)
    return sums.withColumn("revenue_share_pct", share).drop("_cents")


def segment_counts_revenue(df: DataFrame, label: str = "segment_label") -> DataFrame:
    sums = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("customers"), wide_sum(cents(F.col("monetary"))).alias("_cents")
    )
    share = ratio(F.col("customers") * 100, F.sum("customers").over(Window.partitionBy()), 1)
    return sums.select(label, "customers", share.alias("customer_share_pct"), from_cents(F.col("_cents")).alias("revenue"))


def rfm_scatter_data(df: DataFrame, label: str = "segment_label") -> DataFrame:
    """Marker size relative to the largest spender of the segment."""
    largest = df.groupBy(label).agg(F.max("monetary").alias("_largest"))
    size = quotient(F.col("monetary"), F.col("_largest")) * 120 + 10
    return df.join(F.broadcast(largest), label).select(  # one row per label
        "customer_id", label, "recency_days", "frequency", "monetary", size.alias("marker_size")
    )


def pareto_curve(df: DataFrame) -> DataFrame:
    """Cumulative revenue and customers, largest spender first."""
    spend = df.select("customer_id", "monetary", cents(F.col("monetary")).alias("_cents"))
    placed = with_positions(spend, [F.col("_cents").desc(), F.col("customer_id")], {"cents": "_cents"})
    return placed.select(
        "customer_id",
        "monetary",
        F.col("rank").alias("position"),
        from_cents(F.col("cum_cents")).alias("cum_revenue"),
        (quotient(F.col("cum_cents"), F.col("total_cents")) * 100).alias("cum_revenue_pct"),
        (quotient(F.col("rank"), F.col("n_rows")) * 100).alias("cum_customer_pct"),
    )


def pareto_at_20(curve: DataFrame) -> DataFrame:
    """The point of the curve nearest to 20 % of the customers; the first one of two."""
    distance = F.abs(F.col("cum_customer_pct") - F.lit(20.0))
    nearest = F.min_by(F.struct("position", "cum_customer_pct", "cum_revenue_pct"), F.struct(distance, "position"))
    return curve.agg(nearest.alias("_point")).select("_point.*")
