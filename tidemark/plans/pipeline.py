"""The full analysis: tables in, customer master and report figures out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import churn, kpis, ltv, metrics, rfm, segments
from tidemark.plans.workspace import Workspace
from tidemark.session import materialise
from tidemark.sources.master import write_master


class Analysis(NamedTuple):
    master: DataFrame
    segment_summary: DataFrame
    retention: DataFrame
    model_auc: dict[str, float]
    cross_validation: DataFrame | None
    ltv_error: tuple[float, float]
    evaluation: dict[str, DataFrame]

    def kpis(self) -> DataFrame:
        return kpis.report_kpis(self.master, self.retention)

    def derived_kpis(self) -> DataFrame:
        return kpis.report_derived_kpis(self.master, self.retention)


def segmented(w: Workspace) -> DataFrame:
    """Features with percentile scores and K-Means segments."""
    return materialise(segments.kmeans_segments(rfm.rfm_percentile_scores(w.feature_table), w.p))


def evaluate_models(data: churn.ChurnData, models: dict[str, Model]) -> dict[str, DataFrame]:
    """Every measure of each model over the held-out customers, told apart by ``model_name``."""
    label, score = "label", "churn_prob"
    measures = {
        "average_precision": lambda df: metrics.average_precision(df, label, score),
        "roc_points": lambda df: metrics.roc_points(df, label, score),
        "confusion_matrix": lambda df: metrics.confusion_matrix(df, label, "prediction"),
        "classification_report": lambda df: metrics.classification_report(df, label, "prediction"),
        "churn_prob_histogram": lambda df: churn.churn_prob_histogram(df, score, label),
    }
    held_out = {name: materialise(churn.test_predictions(data, model)) for name, model in models.items()}
    found = {"feature_importance": churn.feature_importance(data, models)}
    for measure, of in measures.items():
        parts = [of(df).select(F.lit(name).alias("model_name"), "*") for name, df in held_out.items()]
        found[measure] = reduce(DataFrame.unionByName, parts)
    return found


def run_analysis(w: Workspace, cross_validate: bool = True, exclude_leaky: bool = False) -> Analysis:
    """Segments, churn scores and lifetime value, one row per customer.

    The lifetime model does not use the churn score, so the models are trained side by
    side; scoring is then one projection of the prepared table after the other.
    """
    p = w.p
    segment_table = segmented(w)
    data = churn.prepare(segment_table, p, exclude_leaky)
    with ThreadPoolExecutor(3) as pool:
        lifetime = pool.submit(ltv.train_ltv_model, ltv.ltv_heuristic(segment_table, p), p)
        fitted = pool.submit(churn.train_models, data, p)
        folds = pool.submit(churn.churn_cv, data, p) if cross_validate else None
        models = fitted.result()
        model, names, mae, r2 = lifetime.result()
        comparison = folds.result() if folds else None

    ranking = churn.model_scores(data, models)
    data.training.unpersist()
    evaluation = evaluate_models(data, models)
    scored = churn.churn_scored(data, models[ranking[0][0]], p)
    valued = materialise(ltv.predict_ltv(ltv.ltv_heuristic(scored, p), model, names))
    return Analysis(
        master=materialise(ltv.ltv_tiers(valued, "ltv_predicted")),
        segment_summary=segments.segment_summary(segment_table),
        retention=w.retention,
        model_auc=dict(ranking),
        cross_validation=comparison,
        ltv_error=(mae, r2),
        evaluation=evaluation,
    )


def save(analysis: Analysis, folder: str) -> None:
    """Write the master and the report tables below ``folder``."""
    write_master(analysis.master, f"{folder}/customer_master")
    analysis.segment_summary.write.mode("overwrite").parquet(f"{folder}/segment_summary")
    analysis.kpis().write.mode("overwrite").parquet(f"{folder}/report_kpis")
    analysis.derived_kpis().write.mode("overwrite").parquet(f"{folder}/report_derived_kpis")
    for name, df in analysis.evaluation.items():
        df.write.mode("overwrite").parquet(f"{folder}/evaluation/{name}")


def model_checks(w: Workspace) -> DataFrame:
    """(subject, customers, agreeing): what must hold of fitted models, whatever their scores are.

    ``customers`` counts those with a value in its range. ``agreeing`` counts those whose derived value follows from the fitted one:
    a label that is the only one of its cluster, a tier from the score or from the quartiles; for a classifier the
    held-out churned customers.
    """
    analysis = run_analysis(w, cross_validate=False)
    master = analysis.master
    named = master.select("cluster_id", "segment_label").distinct().groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_labels"))
    parts = [
        master.join(F.broadcast(named), "cluster_id").agg(  # one row a cluster
            F.lit("segments").alias("subject"),
            F.count(F.when(F.col("cluster_id").between(0, w.p.n_clusters - 1), 1)).alias("customers"),
            F.count(F.when(F.col("_labels") == 1, F.col("segment_label"))).alias("agreeing"),
        ),
        master.agg(
            F.lit("churn_scored"),
            F.count(F.when(F.col("churn_prob").between(0, 1), 1)),
            F.count(F.when(F.col("churn_risk_tier") == churn.risk_tier(F.col("churn_prob"), w.p), 1)),
        ),
        ltv.ltv_tiers(master, "ltv_predicted", "_again").agg(
            F.lit("ltv_scored"),
            F.count(F.when(F.col("ltv_predicted") >= 0, 1)),
            F.count(F.when(F.col("ltv_tier") == F.col("_again"), 1)),
        ),
    ]
    cells = analysis.evaluation["confusion_matrix"]
    churned = F.coalesce(F.sum(F.when(F.col("actual") == 1, F.col("customers"))), F.lit(0))
    parts.append(cells.groupBy("model_name").agg(F.sum("customers"), churned))
    return reduce(DataFrame.union, parts)
