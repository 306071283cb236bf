"""The distributed order against single-task windows, numpy and hot values."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import column_quantiles, quantiles, with_ntile, with_positions


def skewed(spark, rows=3000):
    """A third of all rows share one value."""
    return spark.range(rows).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7L ELSE (id * 7919) % 101 END AS value")


def test_rank_and_running_total(spark):
    df = skewed(spark)
    order = [F.col("value").desc(), F.col("id")]
    window = Window.orderBy(*order)
    expected = df.select(
        "id",
        F.row_number().over(window).cast("bigint").alias("rank"),
        F.sum("value").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
    )
    actual = with_positions(df, order, {"value": "value"}).select(
        "id", "rank", F.col("cum_value").cast("bigint").alias("cum")
    )
    assert sorted(actual.collect()) == sorted(expected.collect())
    totals = with_positions(df, order, {"value": "value"}).agg(F.max("n_rows"), F.max("total_value")).first()
    assert totals[0] == 3000 and totals[1] == df.agg(F.sum("value")).first()[0]


def test_hot_value_is_spread_over_partitions(spark):
    df = skewed(spark, 20_000).repartitionByRange(8, "value", "id")
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 20_000 / 3


@pytest.mark.parametrize("rows", [1, 3, 4, 5, 6, 99, 1000])
def test_ntile(spark, rows):
    df = spark.range(rows).selectExpr("id", "(id * 37) % 11 AS value")
    expected = df.select("id", F.ntile(5).over(Window.orderBy("value", "id")).alias("tile"))
    assert sorted(with_ntile(df, [F.col("value"), F.col("id")], 5, "tile").select("id", "tile").collect()) == sorted(
        expected.collect()
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_like_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = {"a": 0.0, "b": 0.2, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    row = quantiles(df, "x", probs).first()
    assert row.n_values == len(values)
    for name, prob in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, prob), abs=1e-9)


def test_quantiles_per_label_and_per_column(spark):
    df = spark.range(101).selectExpr(
        "IF(id < 60, 'a', 'b') AS label", "CAST(id * id AS DOUBLE) AS x", "IF(id % 2 = 0, CAST(id AS DOUBLE), NULL) AS y"
    )
    pdf = df.toPandas()
    for row in quantiles(df, "x", {"q": 0.3}, by=["label"]).collect():
        assert row.q == pytest.approx(pdf[pdf.label == row.label].x.quantile(0.3))
    both = column_quantiles(df, ["x", "y"], {"q": 0.4}).first()
    assert both.x.q == pytest.approx(pdf.x.quantile(0.4)) and both.y.q == pytest.approx(pdf.y.quantile(0.4))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id bigint, value bigint")
    assert with_positions(empty, [F.col("value"), F.col("id")], {"v": "value"}).collect() == []
    assert quantiles(empty, "value", {"q": 0.5}).first().q is None
