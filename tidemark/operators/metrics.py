"""Exact quality metrics of scores, class predictions and regressions.

Rows are collapsed to one per distinct score before anything is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import quotient
from tidemark.operators.ranking import with_positions

CLASS_NAMES = {0: "Active", 1: "Churned"}


def _thresholds(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: positives, rows and their running totals."""
    points = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("_positives"), F.count(F.lit(1)).alias("_rows")
    )
    return with_positions(points, [F.col("threshold").desc()], {"tp": "_positives", "all": "_rows"})


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half."""
    points = _thresholds(df, label, score)
    negatives = F.col("_rows") - F.col("_positives")
    total_negatives = F.col("total_all") - F.col("total_tp")
    below = total_negatives - (F.col("cum_all") - F.col("cum_tp"))
    twice = F.col("_positives").cast("decimal(38,0)") * (below * 2 + negatives).cast("decimal(38,0)")
    return points.agg(
        quotient(
            F.sum(twice),
            F.max(F.col("total_tp")).cast("double") * F.max(total_negatives).cast("double") * 2,
        ).alias("roc_auc")
    )


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision at each threshold weighted by the recall gained there (no interpolation)."""
    points = _thresholds(df, label, score)
    gained = quotient(F.col("_positives"), F.col("total_tp"))
    precision = quotient(F.col("cum_tp"), F.col("cum_all"))
    return points.agg(F.sum(gained * precision).alias("average_precision"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate per threshold, starting at the origin."""
    points = _thresholds(df, label, score)
    curve = points.select(
        "threshold",
        quotient(F.col("cum_all") - F.col("cum_tp"), F.col("total_all") - F.col("total_tp")).alias("fpr"),
        quotient(F.col("cum_tp"), F.col("total_tp")).alias("tpr"),
    )
    origin = points.agg(F.max("threshold").alias("threshold")).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(curve)


def _cells(label: str, prediction: str) -> dict[tuple[int, int], Column]:
    return {
        (actual, predicted): F.count(F.when((F.col(label) == actual) & (F.col(prediction) == predicted), 1))
        for actual in (0, 1)
        for predicted in (0, 1)
    }


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    cells = _cells(label, prediction)
    one_row = df.agg(*[cell.alias(f"_{a}{b}") for (a, b), cell in cells.items()])
    listed = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"_{a}{b}").alias("customers"))
            for a, b in cells
        ]
    )
    return one_row.select(F.explode(listed).alias("_cell")).select("_cell.*")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    A ratio without a denominator is 0. Accuracy has only the F1 column and the support.
    """
    c = df.agg(*[cell.alias(f"_{a}{b}") for (a, b), cell in _cells(label, prediction).items()])

    def part(top: Column, bottom: Column) -> Column:
        return F.coalesce(quotient(top, bottom), F.lit(0.0))

    for k in (0, 1):
        hit, missed, wrong = F.col(f"_{k}{k}"), F.col(f"_{k}{1 - k}"), F.col(f"_{1 - k}{k}")
        c = (
            c.withColumn(f"p{k}", part(hit, hit + wrong))
            .withColumn(f"r{k}", part(hit, hit + missed))
            .withColumn(f"f{k}", part(hit * 2, hit * 2 + wrong + missed))
            .withColumn(f"s{k}", hit + missed)
        )
    n = F.col("s0") + F.col("s1")
    none = F.lit(None).cast("double")

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    def mean(metric: str) -> Column:
        return (F.col(f"{metric}0") + F.col(f"{metric}1")) / 2

    def weighted(metric: str) -> Column:
        return part(F.col(f"{metric}0") * F.col("s0") + F.col(f"{metric}1") * F.col("s1"), n)

    rows = [row(name, *[F.col(f"{m}{k}") for m in "prfs"]) for k, name in CLASS_NAMES.items()]
    rows.append(row("accuracy", none, none, part(F.col("_00") + F.col("_11"), n), n))
    rows.append(row("macro avg", mean("p"), mean("r"), mean("f"), n))
    rows.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), n))
    return c.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error and R squared."""
    y, d = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.agg(
        F.avg(F.abs(d)).alias("mae"),
        (F.lit(1.0) - quotient(F.sum(d * d), F.var_pop(y) * F.count(y))).alias("r2"),
    )
