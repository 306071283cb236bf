"""Quality and determinism of fitted models, and invariants of the customer master."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.operators import churn, features, kpis, ltv, metrics, segments
from tidemark.plans.pipeline import model_checks, run_analysis, save
from tidemark.sources.master import load_master, write_master


@pytest.fixture(scope="module")
def data(work):
    return churn.prepare(work.feature_table, work.p)


@pytest.fixture(scope="module")
def models(work, data):
    return churn.train_models(data, work.p)


@pytest.fixture(scope="module")
def analysis(work):
    return run_analysis(work, cross_validate=False)


def test_label_leak_makes_trees_near_perfect(data, models):
    scores = dict(churn.model_scores(data, models))
    assert max(scores.values()) > 0.99
    assert all(score > 0.8 for score in scores.values())


def test_leaky_feature_can_be_left_out(work):
    names = churn.churn_feature_names(work.p, exclude_leaky=True)
    assert "recency_days" not in names and "tenure_days" in names


def test_exact_auc_equals_evaluator(data, models):
    scored = churn.test_predictions(data, models[churn.BOOSTED])
    vectors = models[churn.BOOSTED].transform(data.table.filter("is_test = 1")).drop("rawPrediction")
    judge = BinaryClassificationEvaluator(numBins=0, rawPredictionCol="probability")
    assert metrics.roc_auc(scored, "label", "churn_prob").first()[0] == pytest.approx(judge.evaluate(vectors), abs=1e-9)


def test_feature_importance_is_sorted_and_named(data, models):
    rows = churn.feature_importance(data, models).collect()
    for name in models:
        own = [r.importance for r in rows if r.model_name == name]
        assert own == sorted(own, reverse=True) and len(own) > 15


def test_kmeans_is_reproducible(work):
    first = segments.kmeans_segments(work.feature_table, work.p).select("customer_id", "segment_label")
    second = segments.kmeans_segments(work.feature_table, work.p).select("customer_id", "segment_label")
    assert sorted(first.collect()) == sorted(second.collect())


def test_master_invariants(work, analysis):
    master = analysis.master
    n = work.feature_table.count()
    assert master.count() == n == master.select("customer_id").distinct().count()
    added = [
        *("r_score", "f_score", "m_score", "rfm_total", "rfm_avg", "cluster_id", "segment_label", "segment_color"),
        *("churn_prob", "churn_risk_tier", "active_days", "daily_purchase_rate", "retention_factor"),
        *("discount_ltv_haircut", "ltv_heuristic", "ltv_predicted", "ltv_tier"),
    ]
    assert master.columns == [*features.feature_columns(work.p), *added]
    assert master.filter("churn_prob < 0 OR churn_prob > 1 OR ltv_predicted < 0 OR ltv_heuristic < 0").count() == 0
    assert master.filter("churn_risk_tier IS NULL OR ltv_tier IS NULL OR segment_label IS NULL").count() == 0
    tiers = {r.ltv_tier: r.customers for r in ltv.ltv_tier_summary(master).collect()}
    assert sum(tiers.values()) == n
    summary = analysis.segment_summary
    assert summary.agg(F.sum("customer_count")).first()[0] == n
    assert summary.agg(F.sum("revenue_share_pct")).first()[0] == pytest.approx(100, abs=0.5)


def test_report_and_files(spark, analysis, tmp_path):
    row = analysis.kpis().first()
    assert row.total_customers == analysis.master.count()
    assert 20 <= row.top20_share_pct <= 100
    save(analysis, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/customer_master").count() == row.total_customers
    assert spark.read.parquet(f"{tmp_path}/report_derived_kpis").count() == 1
    report = spark.read.parquet(f"{tmp_path}/evaluation/classification_report")
    assert report.groupBy("model_name").count().count() == 3
    cells = spark.read.parquet(f"{tmp_path}/evaluation/confusion_matrix").groupBy("model_name").agg(F.sum("customers").alias("n"))
    assert len({r.n for r in cells.collect()}) == 1
    table = kpis.report_segment_table(analysis.segment_summary).orderBy("position").collect()
    assert [r.position for r in table] == list(range(1, len(table) + 1))


def test_master_from_csv(spark, analysis, tmp_path):
    path = str(tmp_path / "master")
    write_master(analysis.master, path, "csv")
    again = load_master(spark, path, analysis.master.schema, "csv")
    assert again.columns == analysis.master.columns
    key = ["customer_id", "monetary", "ltv_predicted", "segment_label", "is_churned"]
    assert sorted(again.select(*key).collect()) == sorted(analysis.master.select(*key).collect())


def test_bad_numbers_become_zero(spark, analysis, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    names = analysis.master.columns
    values = {"customer_id": "1", "monetary": "n/a", "recency_days": "", "churn_prob": "0.5", "city": "x"}
    (folder / "part.csv").write_text(",".join(names) + "\n" + ",".join(values.get(c, "") for c in names) + "\n")
    row = load_master(spark, str(folder), analysis.master.schema, "csv").first()
    assert (row.monetary, row.recency_days, row.frequency, row.ltv_predicted) == (0.0, 0.0, 0.0, 0.0)
    assert (row.churn_prob, row.customer_id, row.is_churned) == (0.5, 1, None)


def test_alternative_features_agree_where_they_must(spark, sf_dir):
    from tidemark.plans import registry

    w = registry.workspace(spark, sf_dir)
    clean_only = w.clean  # same orders in, so the two rule sets must agree on these columns
    alt = features.ml_features_alt(clean_only, w.raw.items, w.raw.products, w.customers, w.p)
    shared = ["customer_id", "recency_days", "frequency", "is_churned", "distinct_products_bought"]
    assert sorted(alt.select(*shared).collect()) == sorted(w.features.select(*shared).collect())


def test_checks_of_fitted_models(work):
    found = {r.subject: r for r in model_checks(work).collect()}
    customers = work.features.count()
    assert {"segments", "churn_scored", "ltv_scored"} < set(found) and len(found) == 6
    for subject in ("segments", "churn_scored", "ltv_scored"):
        assert (found[subject].customers, found[subject].agreeing) == (customers, customers)
