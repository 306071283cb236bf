"""The registered queries: every operator over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import round_half_up
from tidemark.operators import (
    churn,
    cleaning,
    cohorts,
    customers,
    distribution,
    features,
    kpis,
    ltv,
    metrics,
    rfm,
    segments,
)
from tidemark.params import Params
from tidemark.plans.oracle import all_relations, statement
from tidemark.plans.pipeline import model_checks, run_analysis
from tidemark.plans.workspace import Workspace
from tidemark.sources.master import coerce_numeric
from tidemark.sources.star import dirty_tables, star_tables

# The analysis calendar of the test tables and their product categories.
TEST_PARAMS = Params(
    ref_date=dt.date(2001, 6, 30),
    window_start=dt.date(1995, 1, 1),
    window_end=dt.date(2001, 6, 30),
    categories=("economy", "large", "medium", "promo", "small", "standard"),
)

# Model sizes of the tests only; queries run the documented ones of Params.
QUICK_PARAMS = replace(
    TEST_PARAMS, kmeans_restarts=2, kmeans_iterations=100, forest_trees=40, churn_rounds=15, ltv_rounds=30
)

Query = Callable[[SparkSession, str], DataFrame]


def workspace(spark: SparkSession, sf_dir: str, dirty: bool = False, p: Params = TEST_PARAMS) -> Workspace:
    tables = star_tables(spark, sf_dir)
    return Workspace(dirty_tables(tables) if dirty else tables, p)


def _sources() -> dict[str, Callable[[Workspace], DataFrame]]:
    return {
        "src_customers": lambda w: w.raw.customers,
        "src_orders": lambda w: w.raw.orders,
        "src_order_items": lambda w: w.raw.items,
        "src_products": lambda w: w.raw.products,
    }


def _cleaning() -> dict[str, Callable[[Workspace], DataFrame]]:
    """Run over the defective tables: the test tables themselves have nothing to clean."""
    dedup = cleaning.dedup_orders
    fixed = lambda w: cleaning.fix_discount_pct(dedup(w.raw.orders))
    synced = lambda w: cleaning.sync_discount_flag(fixed(w))
    return {
        "dedup_orders": lambda w: dedup(w.raw.orders),
        "fix_discount_pct": fixed,
        "sync_discount_flag": synced,
        "drop_nonpositive_orders": lambda w: cleaning.drop_nonpositive_orders(synced(w)),
        "drop_orphan_items": lambda w: cleaning.drop_orphan_items(w.raw.items, w.base.orders),
        "drop_bad_items": lambda w: cleaning.drop_bad_items(w.raw.items),
        "active_customers": lambda w: cleaning.active_customers(w.raw.customers, w.base.orders),
        "inactive_customers": lambda w: cleaning.inactive_customers(w.raw.customers, w.base.orders),
        "clean_city": lambda w: w.customers,
        "flag_order_dates": lambda w: w.base.orders,
        "flagged_orders": lambda w: cleaning.flagged_orders(w.base.orders),
        "orphan_order_count": lambda w: cleaning.orphan_order_count(w.base.orders, w.raw.customers),
        "orders_clean": lambda w: w.clean,
        "items_clean": lambda w: cleaning.items_clean(w.raw.items, w.clean),
    }


def _analysis() -> dict[str, Callable[[Workspace], DataFrame]]:
    return {
        "customer_stats": lambda w: w.customer_stats,
        "order_gaps": lambda w: customers.order_gaps(w.clean),
        "purchase_intervals": lambda w: w.purchase_intervals,
        "product_mix": lambda w: customers.product_mix(w.raw.items, w.clean, w.raw.products),
        "pareto_quintiles": lambda w: customers.pareto_quintiles(w.customer_stats),
        "rfm_raw": lambda w: w.rfm_raw,
        "rfm_scores": lambda w: rfm.rfm_scores(w.rfm_raw),
        "rfm_segments": lambda w: w.rfm_segments,
        "rfm_segment_summary": lambda w: rfm.rfm_segment_summary(w.rfm_segments),
        "cohort_base": lambda w: cohorts.cohort_base(w.clean),
        "cohort_activity": lambda w: cohorts.cohort_activity(w.clean),
        "cohort_sizes": lambda w: cohorts.cohort_sizes(w.clean),
        "cohort_retention": lambda w: w.retention,
        "avg_retention_curve": lambda w: cohorts.avg_retention_curve(w.retention),
        "avg_retention_curve_first_year": lambda w: cohorts.retention_curve_first_year(w.retention),
        "cohort_revenue": lambda w: cohorts.cohort_revenue(w.clean, w.p),
        "retention_matrix": lambda w: cohorts.retention_matrix(w.retention),
        "cohort_retention_alt": lambda w: cohorts.cohort_retention(w.base.orders, w.p),
    }


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Engines differ in the last bit of exp, variance and float sums; compare less than that."""
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in digits.items()})


def _features() -> dict[str, Callable[[Workspace], DataFrame]]:
    tables = lambda w: (w.raw.items, w.clean, w.raw.products, w.p)
    return {
        "feat_base": lambda w: features.feat_base(w.clean, w.p),
        "feat_velocity": lambda w: features.feat_velocity(w.clean, w.p),
        "feat_category_share": lambda w: features.feat_category_share(*tables(w)),
        "feat_spend_trend": lambda w: features.feat_spend_trend(w.clean, w.p),
        "feat_meta": lambda w: features.feat_meta(w.customers, w.p),
        "ml_features": lambda w: w.features,
        "ml_features_alt": lambda w: features.ml_features_alt(
            w.base.orders, w.base.items, w.raw.products, w.customers, w.p
        ),
        "rfm_percentile_scores": lambda w: rfm.rfm_percentile_scores(
            w.feature_table.select("customer_id", "recency_days", "frequency", "monetary")
        ),
        "scaled_features": lambda w: _rounded(
            segments.scaled_features(w.features), **{segments.z_name(c): 6 for c in segments.CLUSTER_FEATURES}
        ),
        "pareto_curve": lambda w: segments.pareto_curve(w.features),
        "pareto_at_20": lambda w: segments.pareto_at_20(segments.pareto_curve(w.features)),
        "encode_categoricals": lambda w: churn.encode_categoricals(
            w.feature_table.select("customer_id", "city", "channel")
        ),
        "churn_matrix": lambda w: churn.churn_matrix(w.feature_table, w.p),
        "stratified_split": lambda w: churn.stratified_split(w.features.select("customer_id", "is_churned"), w.p),
        "ltv_heuristic": lambda w: _rounded(ltv.ltv_heuristic(w.features, w.p), retention_factor=9).select(
            "customer_id",
            "active_days",
            "daily_purchase_rate",
            "retention_factor",
            "discount_ltv_haircut",
            "ltv_heuristic",
        ),
    }


def _text_master(w: Workspace) -> DataFrame:
    """The master as it comes out of a CSV file, with bad and missing numbers."""
    text = w.rule_master.select("customer_id", *[F.col(c).cast("string") for c in MASTER_NUMBERS])
    return text.withColumn(
        "monetary", F.when(F.col("customer_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("monetary"))
    ).withColumn("frequency", F.when(F.col("customer_id") % 11 != 0, F.col("frequency")))


def _line(df: DataFrame) -> DataFrame:
    return df.withColumn("slope", F.round("slope", 4)).withColumn("intercept", F.round("intercept", 2))


def _master() -> dict[str, Callable[[Workspace], DataFrame]]:
    """Over the rule-based master, so that SQL can check them."""
    label, score = "is_churned", "churn_prob"
    bands = lambda w: w.rule_master.withColumn("cluster_id", F.col("r_score") - 1)
    summary = lambda w: segments.segment_summary(w.rule_master)
    trend = distribution.linear_trend
    tiers = lambda w: ltv.ltv_tiers(w.rule_master.select("customer_id", "ltv_heuristic"), "ltv_heuristic")
    return {
        "cluster_profiles": lambda w: segments.cluster_profiles(bands(w)),
        "segment_summary": summary,
        "segment_counts_revenue": lambda w: segments.segment_counts_revenue(w.rule_master),
        "rfm_scatter_data": lambda w: segments.rfm_scatter_data(w.rule_master),
        "discount_box_stats": lambda w: distribution.box_stats(w.rule_master, "discount_usage_rate", "segment_label"),
        "discount_revenue_trend": lambda w: _line(trend(w.rule_master, "monetary", "discount_usage_rate")),
        "discount_revenue_trend_by_segment": lambda w: _line(
            trend(w.rule_master, "monetary", "discount_usage_rate", by="segment_label")
        ),
        "roc_auc": lambda w: metrics.roc_auc(w.rule_master, label, score),
        "average_precision": lambda w: _rounded(
            metrics.average_precision(w.rule_master, label, score), average_precision=9
        ),
        "roc_points": lambda w: metrics.roc_points(w.rule_master, label, score),
        "confusion_matrix": lambda w: metrics.confusion_matrix(w.rule_master, label, "prediction"),
        "classification_report": lambda w: metrics.classification_report(w.rule_master, label, "prediction"),
        "churn_risk_tiers": lambda w: churn.churn_risk_tiers(w.rule_master),
        "churn_prob_histogram": lambda w: churn.churn_prob_histogram(w.rule_master),
        "regression_metrics": lambda w: _rounded(
            metrics.regression_metrics(w.rule_master, "ltv_heuristic", "ltv_predicted"), mae=2, r2=6
        ),
        "ltv_tiers": tiers,
        "ltv_tier_summary": lambda w: ltv.ltv_tier_summary(tiers(w), value="ltv_heuristic"),
        "ltv_box_stats": lambda w: distribution.box_stats(
            w.rule_master, "ltv_heuristic", "segment_label", descending=True
        ),
        "ltv_axis_limit": lambda w: ltv.ltv_axis_limit(w.rule_master),
        "report_kpis": lambda w: kpis.report_kpis(w.rule_master, w.retention),
        "report_derived_kpis": lambda w: kpis.report_derived_kpis(w.rule_master, w.retention),
        "report_segment_table": lambda w: kpis.report_segment_table(summary(w)),
        "customer_filter": lambda w: kpis.customer_filter(
            w.rule_master,
            city="All",
            segment="Loyal Customers",
            risk="Medium Risk",
            min_revenue=1_000_000,
            max_revenue=4_000_000,
        ).select(*kpis.EXPLORER_COLUMNS),
        "filter_domains": lambda w: kpis.filter_domains(w.rule_master),
        "dashboard_kpis": lambda w: kpis.dashboard_kpis(w.rule_master),
        "segment_revenue_share": lambda w: kpis.segment_revenue_share(w.rule_master),
        "rfm_sample": lambda w: kpis.rfm_sample(w.rule_master),
        "discount_sample": lambda w: kpis.discount_sample(w.rule_master),
        "median_ltv_by_segment": lambda w: kpis.median_ltv_by_segment(w.rule_master),
        "discount_by_segment": lambda w: kpis.discount_by_segment(w.rule_master),
        "customer_explorer": lambda w: kpis.customer_explorer(w.rule_master),
        "dashboard_segment_table": lambda w: kpis.dashboard_segment_table(w.rule_master),
        "dataset_summary": lambda w: kpis.dataset_summary(w.datasets()),
        "load_master": lambda w: coerce_numeric(_text_master(w)),
    }


# A statement over the registered views, as an analyst would write it.
CITY_SEGMENTS = """
SELECT c.city, s.rfm_segment, COUNT(*) AS customers, SUM(s.frequency) AS orders, MAX(s.recency_days) AS longest_recency,
       COUNT(f.customer_id) AS with_features
FROM v_rfm_segments s
JOIN customers c ON c.customer_id = s.customer_id
LEFT JOIN v_ml_features f ON f.customer_id = s.customer_id
GROUP BY c.city, s.rfm_segment
"""


def _statements() -> dict[str, Callable[[Workspace], DataFrame]]:
    """Through ``spark.sql`` over the temporary views, and what must hold of the fitted models."""
    return {"city_segments_view": lambda w: w.sql(CITY_SEGMENTS), "model_checks": model_checks}


def _models() -> dict[str, Callable[[Workspace], DataFrame]]:
    """Fitted models: no SQL twin. Documented sizes, over all customers."""
    fit = churn.train_models

    def prepared(w: Workspace) -> churn.ChurnData:
        return churn.prepare(w.feature_table, w.p)

    def predictions(w: Workspace, name: str) -> DataFrame:
        data = prepared(w)
        return churn.test_predictions(data, fit(data, w.p, [name])[name])

    def scored(w: Workspace) -> DataFrame:
        data = prepared(w)
        models = fit(data, w.p)
        return churn.churn_scored(data, models[churn.model_scores(data, models)[0][0]], w.p)

    def with_models(w: Workspace, report: Callable) -> DataFrame:
        data = prepared(w)
        return report(data, fit(data, w.p))

    valued = lambda w: ltv.ltv_heuristic(w.feature_table, w.p)
    return {
        "kmeans_k_sweep": lambda w: segments.kmeans_k_sweep(w.feature_table, w.p),
        "kmeans_segments": lambda w: segments.kmeans_segments(w.feature_table, w.p),
        "churn_lr": lambda w: predictions(w, churn.LOGISTIC),
        "churn_rf": lambda w: predictions(w, churn.FOREST),
        "churn_gbt": lambda w: predictions(w, churn.BOOSTED),
        "churn_cv": lambda w: churn.churn_cv(prepared(w), w.p),
        "feature_importance": lambda w: with_models(w, churn.feature_importance),
        "best_model": lambda w: with_models(w, churn.best_model),
        "churn_scored": scored,
        "ltv_model": lambda w: ltv.ltv_model(valued(w), w.p),
        "ltv_scored": lambda w: ltv.ltv_scored(valued(w), w.p),
        "customer_master": lambda w: run_analysis(w, cross_validate=False).master,
    }


# Queries that are also run over the defective tables, as <key>_dirty.
ALSO_DIRTY = [
    "customer_stats",
    "order_gaps",
    "purchase_intervals",
    "product_mix",
    "rfm_raw",
    "rfm_segments",
    "cohort_activity",
    "cohort_retention",
    "cohort_revenue",
    "cohort_retention_alt",
    "feat_category_share",
    "ml_features",
    "ml_features_alt",
]
MASTER_NUMBERS = ["recency_days", "frequency", "monetary", "churn_prob", "ltv_predicted"]
# Registered key -> relation of the SQL twin, where the names differ.
TWIN = {"flag_order_dates": "base_orders"}


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}

    def register(key: str, build: Callable[[Workspace], DataFrame], dirty: bool, p: Params = TEST_PARAMS) -> None:
        registered[key] = lambda spark, sf_dir: build(workspace(spark, sf_dir, dirty, p))

    for key, build in _sources().items():
        register(key, build, dirty=False)
    for key, build in _cleaning().items():
        register(key, build, dirty=True)
    analysis = {**_analysis(), **_features(), **_master(), **_statements()}
    for key, build in analysis.items():
        register(key, build, dirty=False)
    for key in ALSO_DIRTY:
        register(f"{key}_dirty", analysis[key], dirty=True)
    for key, build in _models().items():
        register(key, build, dirty=False)
    return registered


def oracle_sql() -> dict[str, str]:
    plain, dirty = all_relations(TEST_PARAMS, dirty=False), all_relations(TEST_PARAMS, dirty=True)
    statements: dict[str, str] = {}
    for key in queries():
        if key in _models():
            continue
        on_dirty = key in _cleaning() or key.endswith("_dirty")
        name = key.removesuffix("_dirty")
        relation = TWIN.get(name, name)
        relations = dirty if on_dirty else plain
        if relation in relations:
            statements[key] = statement(relations, relation)
    return statements
