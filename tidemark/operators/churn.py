"""Churn: feature matrix, stratified split, three classifiers and the risk view."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from statistics import fmean, pstdev
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lookup import join_lookup
from tidemark.functions.sizing import cached_for_training
from tidemark.operators.distribution import histogram
from tidemark.operators.features import share_column
from tidemark.operators.ranking import with_positions
from tidemark.operators.segments import z_name, z_scores
from tidemark.params import Params
from tidemark.session import materialise

# Model inputs, model names and settings, tier names.
NUMERIC_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "discount_usage_rate",
    "avg_discount_pct",
    "orders_per_month",
    "lifespan_days",
    "recent_spend_ratio",
]
LATER_FEATURES = ["distinct_products_bought", "tenure_days"]
CATEGORICAL_FEATURES = ["city", "channel"]
LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Gradient Boosting"
RISK_TIERS = ("Low Risk", "Medium Risk", "High Risk")
HISTOGRAM_BINS = 40
INVERSE_REGULARISATION = 0.5
TRAINING_COLUMNS = ["raw_point", "scaled_point", "label", "is_test", "fold"]


def encode_categoricals(features: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Add ``<column>_enc``: the 0-based alphabetical position of the value (NULL as 'None')."""
    encoded = features
    for c in columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("_text")
        codes = with_positions(features.select(text).distinct(), [F.col("_text")])
        codes = codes.select("_text", (F.col("rank") - 1).cast("double").alias(f"{c}_enc"))
        encoded = join_lookup(encoded.withColumn("_text", text), codes, ["_text"]).drop("_text")
    return encoded


def churn_feature_names(p: Params, exclude_leaky: bool = False) -> list[str]:
    """``recency_days`` also defines the label; leaving it out gives an honest model."""
    numeric = [*NUMERIC_FEATURES, *[share_column(c) for c in p.categories], *LATER_FEATURES]
    if exclude_leaky:
        numeric = [c for c in numeric if c not in ("recency_days", "recent_spend_ratio")]
    return [*numeric, *[f"{c}_enc" for c in CATEGORICAL_FEATURES]]


def churn_matrix(features: DataFrame, p: Params, exclude_leaky: bool = False) -> DataFrame:
    """customer_id, the model inputs as doubles without NULLs, and the label."""
    encoded = encode_categoricals(features)
    return encoded.select(
        "customer_id",
        *[
            F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c)
            for c in churn_feature_names(p, exclude_leaky)
        ],
        F.col("is_churned").cast("int").alias("is_churned"),
    )


def stratified_split(df: DataFrame, p: Params, label: str = "is_churned") -> DataFrame:
    """Add ``is_test`` (the test fraction of every class, exactly) and ``fold``.

    Customers are ordered by a seeded hash within their class, so the split depends on
    nothing but the ids.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.col("customer_id").cast("string")))
    placed = with_positions(
        df.withColumn("_draw", draw), [F.col(label), F.col("_draw"), F.col("customer_id")]
    )
    classes = placed.groupBy(label).agg(F.min("rank").alias("_first"), F.count(F.lit(1)).alias("_size"))
    position = F.col("rank") - F.col("_first")
    drawn = F.floor(F.col("_size") * F.lit(p.test_fraction) + F.lit(0.5))
    return (
        placed.join(F.broadcast(classes), label)  # one row per class
        .withColumn("is_test", F.when(position < drawn, 1).otherwise(0))
        .withColumn("fold", (position % p.cv_folds).cast("int"))
        .drop("_draw", "rank", "n_rows", "_first", "_size")
    )


class ChurnData(NamedTuple):
    """``table``: all input columns plus the two vectors, label, is_test and fold.

    ``training`` holds the latter only, cached: every fit and fold filters it, and the
    estimators keep what they derive from it themselves.
    """

    table: DataFrame
    training: DataFrame
    names: list[str]


def prepare(features: DataFrame, p: Params, exclude_leaky: bool = False) -> ChurnData:
    """The training table. The scaler is fitted on its training part.

    The columns of ``features`` stay in the table, so that scoring all customers later is
    a projection and needs no join back.
    """
    names = churn_feature_names(p, exclude_leaky)
    inputs = [f"_x_{c}" for c in names]
    filled = encode_categoricals(features).withColumns(
        {x: F.coalesce(F.col(c), F.lit(0)).cast("double") for x, c in zip(inputs, names)}
    )
    split = materialise(stratified_split(filled, p))
    plain = VectorAssembler(inputCols=inputs, outputCol="raw_point")
    standard = VectorAssembler(inputCols=[z_name(x) for x in inputs], outputCol="scaled_point")
    table = standard.transform(plain.transform(z_scores(split, inputs, fit_on=split.filter("is_test = 0"))))
    table = table.withColumn("label", F.col("is_churned").cast("double")).select(*features.columns, *TRAINING_COLUMNS)
    training = cached_for_training(table.select("customer_id", *TRAINING_COLUMNS), split.count(), "customer_id")
    return ChurnData(table, training, names)


def _balanced(train: DataFrame) -> DataFrame:
    """Weight n / (2 * n_class): both classes count the same."""
    sizes = train.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("label").alias("churned")).alias("sizes")
    ).scalar()
    own = F.when(F.col("label") == 1, F.col("_sizes.churned")).otherwise(F.col("_sizes.n") - F.col("_sizes.churned"))
    return train.withColumn("_sizes", sizes).withColumn("weight", F.col("_sizes.n") / (own * 2)).drop("_sizes")


def _point(name: str) -> str:
    return "scaled_point" if name == LOGISTIC else "raw_point"


def _fit(name: str, train: DataFrame, rows: int, p: Params) -> Model:
    if name == LOGISTIC:
        trainer = LogisticRegression(
            featuresCol=_point(name),
            regParam=1.0 / (INVERSE_REGULARISATION * rows),
            elasticNetParam=0.0,
            maxIter=1000,
            weightCol="weight",
            standardization=False,
        )
    elif name == FOREST:
        trainer = RandomForestClassifier(
            featuresCol=_point(name),
            numTrees=p.forest_trees,
            maxDepth=8,
            minInstancesPerNode=10,
            weightCol="weight",
            seed=p.seed,
        )
    else:
        trainer = GBTClassifier(
            featuresCol=_point(name),
            maxIter=p.churn_rounds,
            stepSize=0.08,
            maxDepth=4,
            subsamplingRate=0.8,
            seed=p.seed,
        )
    return trainer.fit(train)


def _fit_on(name: str, part: DataFrame, p: Params) -> Model:
    return _fit(name, _balanced(part), part.count(), p)


def train_models(data: ChurnData, p: Params, only: list[str] | None = None) -> dict[str, Model]:
    part = data.training.filter("is_test = 0")
    names = only or [LOGISTIC, FOREST, BOOSTED]
    with ThreadPoolExecutor(len(names)) as pool:  # independent fits share the cluster
        return dict(zip(names, pool.map(lambda name: _fit_on(name, part, p), names)))


def _scored(model: Model, table: DataFrame) -> DataFrame:
    return model.transform(table).withColumn("churn_prob", vector_to_array("probability")[1])


def _auc(model: Model, table: DataFrame) -> float:
    return BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(table))


def churn_cv(data: ChurnData, p: Params, only: list[str] | None = None) -> DataFrame:
    """Mean and deviation of the AUC over stratified folds, one row per model."""
    names = only or [LOGISTIC, FOREST, BOOSTED]
    fold = F.col("fold")

    def one(task: tuple[str, int]) -> float:
        name, number = task
        model = _fit_on(name, data.training.filter(fold != number), p)
        return _auc(model, data.training.filter(fold == number))

    tasks = [(name, number) for name in reversed(names) for number in range(p.cv_folds)]  # the longest first
    with ThreadPoolExecutor(p.parallel_fits) as pool:
        scores = list(pool.map(one, tasks))
    rows = []
    for name in names:
        own = [score for (task, _), score in zip(tasks, scores) if task == name]
        rows.append((name, fmean(own), pstdev(own)))
    return data.table.sparkSession.createDataFrame(rows, "model_name string, mean_auc double, std_auc double")


def model_scores(data: ChurnData, models: dict[str, Model]) -> list[tuple[str, float]]:
    """(model, AUC on the held-out customers), best first; the earlier model wins a tie."""
    held_out = data.training.filter("is_test = 1")
    return sorted(((name, _auc(model, held_out)) for name, model in models.items()), key=lambda s: -s[1])


def best_model(data: ChurnData, models: dict[str, Model]) -> DataFrame:
    rows = [(name, auc, position == 0) for position, (name, auc) in enumerate(model_scores(data, models))]
    return data.table.sparkSession.createDataFrame(rows, "model_name string, roc_auc double, is_best boolean")


def test_predictions(data: ChurnData, model: Model) -> DataFrame:
    """customer_id, label, prediction and churn_prob of the held-out customers."""
    return _scored(model, data.table.filter("is_test = 1")).select(
        "customer_id", F.col("label").cast("int"), F.col("prediction").cast("int"), "churn_prob"
    )


def feature_importance(data: ChurnData, models: dict[str, Model]) -> DataFrame:
    """Every input of each model, the strongest first: impurity importance, or the size of the coefficient."""
    rows = []
    for name, model in models.items():
        values = model.coefficients if name == LOGISTIC else model.featureImportances
        pairs = sorted(zip(data.names, (abs(float(v)) for v in values.toArray())), key=lambda pair: -pair[1])
        rows += [(name, n + 1, feature, weight) for n, (feature, weight) in enumerate(pairs)]
    return data.table.sparkSession.createDataFrame(
        rows, "model_name string, position int, feature string, importance double"
    )


def risk_tier(score: Column, p: Params) -> Column:
    low, high = p.risk_bins
    return F.when(score <= low, RISK_TIERS[0]).when(score <= high, RISK_TIERS[1]).when(score > high, RISK_TIERS[2])


def churn_scored(data: ChurnData, model: Model, p: Params) -> DataFrame:
    """The input columns plus churn_prob and churn_risk_tier for every customer."""
    kept = [c for c in data.table.columns if c not in TRAINING_COLUMNS]
    return _scored(model, data.table).select(*kept, "churn_prob").withColumn(
        "churn_risk_tier", risk_tier(F.col("churn_prob"), p)
    )


def churn_risk_tiers(df: DataFrame, tier: str = "churn_risk_tier") -> DataFrame:
    return df.groupBy(tier).agg(F.count(F.lit(1)).alias("customers"))


def churn_prob_histogram(df: DataFrame, score: str = "churn_prob", label: str = "is_churned") -> DataFrame:
    return histogram(df, score, label, HISTOGRAM_BINS)
