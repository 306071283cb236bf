"""Hand-made rows at the edges of the rules."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import churn, cleaning, cohorts, customers, distribution, features, ltv, rfm, segments
from tidemark.params import Params

P = Params()
ORDER = (
    "order_id string, customer_id string, order_date date, total_amount double, "
    "discount_applied string, discount_percentage double"
)


def day(text):
    return dt.date.fromisoformat(text)


def orders(spark, rows):
    """rows: (order_id, customer_id, date text or None, amount[, flag, pct])"""
    full = [(r[0], r[1], r[2] and day(r[2]), *r[3:], *(["No", 0.0] if len(r) == 4 else [])) for r in rows]
    return spark.createDataFrame(full, ORDER)


def column(df, name, key="customer_id"):
    return {row[key]: row[name] for row in df.collect()}


def test_copies_collapse_and_conflicts_stay(spark):
    found = cleaning.dedup_orders(
        orders(
            spark,
            [
                ("o1", "c", "2023-01-01", 10.0, "Yes", 5.0),
                ("o1", "c", "2023-01-01", 10.0, "No", 0.0),
                ("o1", "c", "2023-01-01", 11.0, "No", 0.0),
                ("o2", None, None, None, None, None),
                ("o2", None, None, None, "Yes", 5.0),
            ],
        )
    ).collect()
    assert len(found) == 3
    kept = {(r.order_id, r.total_amount): r.discount_applied for r in found}
    assert kept == {("o1", 10.0): "No", ("o1", 11.0): "No", ("o2", None): None}


def test_discount_rules(spark):
    rows = [
        ("a", -1.0, "Yes"),
        ("b", 101.0, "No"),
        ("c", 0.0, "Yes"),
        ("d", 5.0, "No"),
        ("e", None, "Yes"),
        ("f", 100.0, "Yes"),
    ]
    df = orders(spark, [(k, "c", "2023-01-01", 1.0, flag, pct) for k, pct, flag in rows])
    fixed = cleaning.sync_discount_flag(cleaning.fix_discount_pct(df)).collect()
    assert {r.order_id: (r.discount_applied, r.discount_percentage) for r in fixed} == {
        "a": ("No", 0.0),
        "b": ("No", 0.0),
        "c": ("No", 0.0),
        "d": ("Yes", 5.0),
        "e": ("Yes", None),
        "f": ("Yes", 100.0),
    }


def test_amounts_and_dates(spark):
    df = orders(
        spark,
        [
            ("neg", "c", "2023-01-01", -1.0),
            ("zero", "c", "2023-01-01", 0.0),
            ("null", "c", "2023-01-01", None),
            ("first", "c", "2022-01-01", 1.0),
            ("last", "c", "2024-06-30", 1.0),
            ("early", "c", "2021-12-31", 1.0),
            ("late", "c", "2024-07-01", 1.0),
            ("nodate", "c", None, 1.0),
        ],
    )
    base = cleaning.base_orders(df, P)
    assert {r.order_id for r in base.collect()} == {"null", "first", "last", "early", "late", "nodate"}
    assert {r.order_id for r in cleaning.flagged_orders(base).collect()} == {"early", "late"}
    clean = cleaning.orders_clean(df, P)
    assert {r.order_id for r in clean.collect()} == {"first", "last", "nodate"}
    assert clean.columns == base.columns


def test_items_without_a_key_are_kept(spark):
    items = spark.createDataFrame(
        [("o1", "p", 1, 1.0), ("x", "p", 1, 1.0), (None, "p", 1, 1.0)],
        "order_id string, product_id string, quantity int, price double",
    )
    base = cleaning.base_orders(orders(spark, [("o1", "c", "2023-01-01", 5.0)]), P)
    assert {r.order_id for r in cleaning.drop_orphan_items(items, base).collect()} == {"o1", None}
    keyless = orders(spark, [("o1", "c", "2023-01-01", 5.0), (None, "c", "2023-01-01", 5.0)])
    kept = cleaning.drop_orphan_items(items, cleaning.base_orders(keyless, P)).collect()
    assert {r.order_id for r in kept} == {"o1", "x", None}  # nothing is NOT IN a list with a NULL


def test_amounts_below_a_cent_add_up(spark):
    clean = cleaning.orders_clean(orders(spark, [(f"o{i}", "c", "2023-01-01", 0.004) for i in range(1000)]), P)
    totals = customers.order_totals(clean, P).first()
    assert totals.spend_cents == 400 and totals.max_cents == 0


def test_customer_without_a_dated_order_has_no_monthly_rate(spark):
    rows = [("o1", "undated", None, 5.0), ("o2", "dated", "2023-01-01", 5.0), ("o3", "partly", None, 5.0), ("o4", "partly", "2023-01-01", 5.0)]
    clean = cleaning.orders_clean(orders(spark, rows), P)
    items = spark.createDataFrame([("o1", "p", 2, 3.0)], "order_id string, product_id string, quantity int, price double")
    products = spark.createDataFrame([("p", "mayo")], "product_id string, category string")
    people = spark.createDataFrame([], "customer_id string, city string, signup_date date, channel string")
    table = features.ml_features(clean, items, products, people, P)
    assert column(table, "orders_per_month") == {"undated": None, "dated": 1.0, "partly": 2.0}
    assert column(table, "lifespan_days") == {"undated": None, "dated": 0, "partly": 0}
    assert column(features.feat_velocity(clean, P), "orders_per_month")["undated"] == 1.0


def test_repeated_order_ids_multiply_items(spark):
    clean = cleaning.orders_clean(
        orders(spark, [("o", "a", "2023-01-01", 5.0), ("o", "a", "2023-01-02", 6.0), ("o", "b", "2023-01-02", 7.0)]), P
    )
    items = spark.createDataFrame(
        [("o", "p", 2, 3.0)], "order_id string, product_id string, quantity int, price double"
    )
    products = spark.createDataFrame([("p", "mayo")], "product_id string, category string")
    assert cleaning.items_clean(items, clean).count() == 3
    mix = {r.customer_id: (r.total_units, r.category_revenue, r.distinct_products)
           for r in customers.product_mix(items, clean, products).collect()}
    assert mix == {"a": (2 * 3 * 2, 6.0 * 3 * 2, 1), "b": (2 * 3, 6.0 * 3, 1)}


def test_title_case_is_optional(spark):
    df = spark.createDataFrame([("c", "  new delhi ")], "customer_id string, city string")
    assert cleaning.clean_city(df).first().city == "new delhi"
    assert cleaning.clean_city(df, title_case=True).first().city == "New Delhi"


def test_gaps(spark):
    rows = [
        ("1", "one", "2023-01-01", 1.0),
        ("2", "same", "2023-01-01", 1.0),
        ("3", "same", "2023-01-01", 2.0),
        ("4", "three", "2023-01-01", 1.0),
        ("5", "three", "2023-01-04", 1.0),
        ("6", "three", "2023-01-14", 1.0),
        ("7", "nodate", None, 1.0),
        ("8", "nodate", None, 2.0),
    ]
    clean = cleaning.orders_clean(orders(spark, rows), P)
    gaps = sorted((r.customer_id, r.days_gap) for r in customers.order_gaps(clean).collect())
    assert gaps == [("same", 0), ("three", 3), ("three", 10)]
    found = {r.customer_id: tuple(r)[1:] for r in customers.purchase_intervals(clean).collect()}
    assert found == {"same": (0.0, 0.0, 0.0), "three": (6.5, 3.0, 10.0)}


def test_a_hot_day_is_expanded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(customers, "EXPAND_CHUNK", 10)
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 35)], "k string, n bigint")
    found = {r.k: r["count"] for r in customers.repeat_rows(df, "n").groupBy("k").count().collect()}
    assert found == {"a": 1, "b": 10, "c": 11, "d": 35}


def test_no_discounted_order(spark):
    clean = cleaning.orders_clean(orders(spark, [("1", "c", "2023-01-01", 10.0)]), P)
    people = spark.createDataFrame(
        [("c", "x", day("2022-01-01"), "web")], "customer_id string, city string, signup_date date, channel string"
    )
    items = spark.createDataFrame([], "order_id string, product_id string, quantity int, price double")
    products = spark.createDataFrame([], "product_id string, category string")
    assert customers.customer_stats(clean, people, P).first().avg_discount_pct is None
    row = features.ml_features(clean, items, products, people, P).first()
    assert (row.avg_discount_pct, row.mayo_spend_share, row.distinct_products_bought) == (0.0, 0.0, 0)


@pytest.mark.parametrize(
    "days, score", [(30, 5), (31, 4), (60, 4), (61, 3), (120, 3), (121, 2), (180, 2), (181, 1), (None, 1)]
)
def test_recency_bands(spark, days, score):
    df = spark.createDataFrame([(days,)], "days int")
    assert df.select(rfm.recency_score("days").alias("s")).first().s == score


@pytest.mark.parametrize("n, score", [(1, 1), (2, 2), (5, 2), (6, 3), (11, 3), (12, 4), (19, 4), (20, 5)])
def test_frequency_bands(spark, n, score):
    df = spark.createDataFrame([(n,)], "n int")
    assert df.select(rfm.frequency_score("n").alias("s")).first().s == score


def test_segment_truth_table(spark):
    scores = spark.range(125).selectExpr(
        "CAST(id DIV 25 + 1 AS INT) AS r", "CAST(id DIV 5 % 5 + 1 AS INT) AS f", "CAST(id % 5 + 1 AS INT) AS m"
    )

    def expected(r, f, m):
        if min(r, f, m) >= 4:
            return "Champions"
        if min(r, f, m) >= 3:
            return "Loyal Customers"
        if r >= 4 and f <= 2:
            return "Promising"
        if r >= 3 and f >= 3:
            return "Potential Loyalists"
        if r <= 2 and f >= 4:
            return "At Risk"
        if r <= 2 and f <= 2:
            return "Hibernating High Value" if m >= 3 else "Lost"
        return "Need Attention"

    rows = scores.withColumn("label", rfm.segment_label("r", "f", "m")).collect()
    assert len(rows) == 125
    assert all(row.label == expected(row.r, row.f, row.m) for row in rows)


def test_cohort_periods(spark):
    rows = [
        ("1", "a", "2023-11-20", 10.0),
        ("2", "a", "2024-02-01", 20.0),
        ("3", "b", "2022-01-31", 1.0),
        ("4", "b", "2023-07-01", 1.0),
        ("5", "b", "2023-08-01", 1.0),
        ("6", "c", None, 1.0),
    ]
    clean = cleaning.orders_clean(orders(spark, rows), P)
    activity = {(r.customer_id, r.order_month): r.period_number for r in cohorts.cohort_activity(clean).collect()}
    assert activity == {
        ("a", "2023-11"): 0,
        ("a", "2024-02"): 3,
        ("b", "2022-01"): 0,
        ("b", "2023-07"): 18,
        ("b", "2023-08"): 19,
        ("c", None): None,
    }
    kept = {(r.cohort_month, r.period_number): r.retention_rate_pct for r in cohorts.cohort_retention(clean, P).collect()}
    assert kept == {("2023-11", 0): 100.0, ("2023-11", 3): 100.0, ("2022-01", 0): 100.0, ("2022-01", 18): 100.0}


def test_churn_recent_spend_and_velocity(spark):
    rows = [
        ("1", "d60", "2024-05-01", 10.0),
        ("2", "d61", "2024-04-30", 10.0),
        ("3", "d90", "2024-04-01", 10.0),
        ("4", "d91", "2024-03-31", 10.0),
        *[(f"x{n}", "fast", f"2024-01-{1 + n:02d}", 1.0) for n in (0, 1, 2, 3, 4, 29)],
        *[(f"y{n}", "month", f"2024-01-{1 + n:02d}", 1.0) for n in (0, 1, 2, 3, 4, 30)],
        *[(f"z{n}", "slow", d, 1.0) for n, d in enumerate(
            ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "2024-03-01"])],
    ]
    clean = cleaning.orders_clean(orders(spark, rows), P)
    people = spark.createDataFrame([], "customer_id string, city string, signup_date date, channel string")
    items = spark.createDataFrame([], "order_id string, product_id string, quantity int, price double")
    products = spark.createDataFrame([], "product_id string, category string")
    table = features.ml_features(clean, items, products, people, P)
    assert table.columns == features.feature_columns(P)
    found = {r.customer_id: r for r in table.collect()}
    assert (found["d60"].is_churned, found["d61"].is_churned) == (0, 1)
    assert (found["d90"].recent_spend_ratio, found["d91"].recent_spend_ratio) == (1.0, 0.0)
    # lifespans of 29, 30 and 60 days with six orders each
    assert [found[c].orders_per_month for c in ("fast", "month", "slow")] == [6.0, 6.0, 3.0]


def test_risk_tiers(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.30, 0.300001, 0.60, 0.600001, 1.0, None)], "x double")
    tiers = [r.t for r in df.select(churn.risk_tier(F.col("x"), P).alias("t")).collect()]
    low, medium, high = churn.RISK_TIERS
    assert tiers == [low, low, medium, medium, high, high, None]


def test_tied_quantiles_still_score(spark):
    df = spark.range(20).selectExpr("id AS customer_id", "CAST(id AS INT) AS recency_days", "1L AS frequency", "2D AS monetary")
    rows = rfm.rfm_percentile_scores(df).collect()
    assert {r.f_score for r in rows} == {1} and {r.m_score for r in rows} == {1}
    assert sorted({r.r_score for r in rows}) == [1, 2, 3, 4, 5]


def test_cluster_labels_with_a_constant_metric(spark):
    rows = [(0, 10, 5, 100.0, 50.0), (1, 20, 3, 80.0, 50.0), (2, 30, 1, 10.0, 50.0)]
    df = spark.createDataFrame(
        rows, "cluster_id int, recency_days int, frequency bigint, monetary double, discount_usage_rate double"
    )
    found = {r.cluster_id: (r.segment_label, r.score) for r in segments.cluster_profiles(df).collect()}
    assert [found[n][0] for n in range(3)] == ["Champions", "Loyal Customers", "Promising"]
    # the discount rate is equal everywhere and stays 50: 0.85 + (1 - 50) * 0.15
    assert found[0][1] == pytest.approx(0.85 - 49 * 0.15)


def test_tied_clusters_share_the_mean_rank_rounded_down(spark):
    rows = [(n, 10, 5, 100.0, 50.0) for n in range(2)] + [(2, 30, 1, 10.0, 60.0)]
    df = spark.createDataFrame(
        rows, "cluster_id int, recency_days int, frequency bigint, monetary double, discount_usage_rate double"
    )
    ranks = {r.cluster_id: r.cluster_rank for r in segments.cluster_profiles(df).collect()}
    assert ranks == {0: 1, 1: 1, 2: 3}  # mean rank 1.5 becomes 1


def test_ltv_formula(spark):
    df = spark.createDataFrame(
        [("a", 100.0, 10, 100, 90, 40.0), ("b", 100.0, 1, 0, 0, 0.0)],
        "customer_id string, avg_order_value double, frequency bigint, lifespan_days int, recency_days int, "
        "discount_usage_rate double",
    )
    found = {r.customer_id: r for r in ltv.ltv_heuristic(df, P).collect()}
    assert found["a"].ltv_heuristic == 1642.50
    assert (found["b"].active_days, found["b"].ltv_heuristic) == (1, 36500.0)


def test_empty_ltv_tiers_are_listed(spark):
    df = spark.range(8).selectExpr("id AS customer_id", "5D AS ltv_predicted")
    summary = {r.ltv_tier: (r.customers, r.avg_ltv, r.total_ltv)
               for r in ltv.ltv_tier_summary(ltv.ltv_tiers(df, "ltv_predicted")).collect()}
    empty = (0, None, 0.0)
    assert summary == {"Bronze": (8, 5.0, 40.0), "Silver": empty, "Gold": empty, "Platinum": empty}


def test_histogram_of_a_single_value(spark):
    df = spark.createDataFrame([(0, 0.5)] * 3 + [(1, 0.0), (1, 1.0)], "label int, x double")
    rows = distribution.histogram(df, "x", "label", 4).collect()
    counts = {(r.label, r.bin): r.customers for r in rows}
    assert len(rows) == 8
    assert counts[(0, 2)] == 3 and counts[(1, 0)] == 1 and counts[(1, 3)] == 1


def test_box_whiskers_and_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "label string, x double")
    row = distribution.box_stats(df, "x", "label").first()
    assert (row.q1, row.median, row.q3) == (2.25, 3.5, 4.75)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 5.0, 1)


def test_missing_category_becomes_none(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "A"), (4, "b")], "customer_id bigint, city string")
    codes = column(churn.encode_categoricals(df, ["city"]), "city_enc")
    assert codes == {3: 0.0, 2: 1.0, 1: 2.0, 4: 2.0}


def test_split_is_exact_per_class(spark):
    df = spark.range(1000).selectExpr("id AS customer_id", "CAST(id % 10 < 3 AS INT) AS is_churned")
    rows = churn.stratified_split(df, replace(P, cv_folds=5)).groupBy("is_churned", "is_test").count().collect()
    assert {(r.is_churned, r.is_test): r["count"] for r in rows} == {(0, 0): 560, (0, 1): 140, (1, 0): 240, (1, 1): 60}
