"""Bucketed tables: no exchange below the item join, the same rows, and no buckets for a hot key."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning
from tidemark.plans import registry
from tidemark.sources import bucketed


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sold(tables):
    return cleaning.items_clean(tables.items, cleaning.orders_clean(tables.orders, registry.TEST_PARAMS))


def test_item_join_without_an_exchange(spark, sf_dir, tmp_path, without_broadcast):
    raw = registry.workspace(spark, sf_dir).raw
    bucketed.write_bucketed(raw, "bucketed_test", str(tmp_path), 8)
    stored = bucketed.read_bucketed(spark, "bucketed_test")
    plan = plan_of(sold(stored))
    assert "Exchange" not in plan and "Join" in plan
    assert "Exchange" in plan_of(sold(raw))
    assert sorted(map(str, sold(stored).collect())) == sorted(map(str, sold(raw).collect()))
    # A second write replaces the first.
    bucketed.write_bucketed(raw._replace(products=raw.products.limit(0)), "bucketed_test", str(tmp_path), 4)
    again = bucketed.read_bucketed(spark, "bucketed_test")
    assert again.products.isEmpty() and again.items.count() == raw.items.count()


def test_a_hot_order_is_shuffled_by_the_join(spark, sf_dir, tmp_path, without_broadcast):
    raw = registry.workspace(spark, sf_dir).raw
    hot = raw._replace(items=raw.items.withColumn("order_id", F.when(F.rand(1) < 0.4, 1).otherwise(F.col("order_id")).cast("long")))
    assert bucketed.has_hot_key(hot.items, "order_id", 64) and not bucketed.has_hot_key(hot.orders, "order_id", 64)
    assert not bucketed.has_hot_key(raw.items.limit(0), "order_id", 64)
    bucketed.write_bucketed(hot, "bucketed_hot", str(tmp_path), 64)
    plan = plan_of(sold(bucketed.read_bucketed(spark, "bucketed_hot")))
    assert "Exchange hashpartitioning(order_id" in plan
