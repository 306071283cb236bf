"""The physical plans are the ones wanted: pruned, pushed down and free of single tasks."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, cohorts, customers, features
from tidemark.plans import registry
from tidemark.sources.tables import Tables, read_parquet_tables


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def w(spark, sf_dir):
    return registry.workspace(spark, sf_dir)


@pytest.fixture(scope="module")
def lake(spark, w, tmp_path_factory):
    """The model tables as Parquet files with DATE columns."""
    folder = str(tmp_path_factory.mktemp("lake"))
    text = ["order_id", "customer_id", "product_id"]
    shapes = {
        "customers": w.raw.customers.withColumn("age", F.lit(30)),
        "orders": w.raw.orders,
        "order_items": w.raw.items,
        "products": w.raw.products.withColumn("margin_pct", F.lit(0.5)),
    }
    for name, df in shapes.items():
        df.withColumns({c: F.col(c).cast("string") for c in text if c in df.columns}).write.parquet(f"{folder}/{name}")
    return read_parquet_tables(spark, folder)


def test_date_range_and_amount_reach_the_scan(lake):
    plan = plan_of(cleaning.orders_clean(lake.orders, registry.TEST_PARAMS))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "GreaterThan(total_amount,0.0)" in pushed
    assert "GreaterThanOrEqual(order_date,1995-01-01)" in pushed and "LessThanOrEqual(order_date,2001-06-30)" in pushed


def test_only_needed_columns_are_read(lake):
    clean = cleaning.orders_clean(lake.orders, registry.TEST_PARAMS)
    plan = plan_of(cohorts.cohort_base(clean))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "discount" not in schema


def test_unused_discounts_remove_the_item_join(w):
    assert "lineitem" not in plan_of(customers.order_gaps(w.clean), "simple")


@pytest.mark.parametrize(
    "build",
    [
        lambda w: customers.customer_stats(w.clean, w.customers, w.p),
        lambda w: customers.order_gaps(w.clean),
        lambda w: customers.product_mix(w.raw.items, w.clean, w.raw.products),
        lambda w: cohorts.cohort_retention(w.clean, w.p),
        lambda w: features.ml_features(w.clean, w.raw.items, w.raw.products, w.customers, w.p),
        lambda w: features.ml_features_alt(w.base.orders, w.base.items, w.raw.products, w.customers, w.p),
        lambda w: cleaning.items_clean(w.raw.items, w.clean),
    ],
)
def test_no_single_partition_and_no_cartesian(w, build):
    plan = plan_of(build(w), "simple")
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    # Only what an aggregate without keys leaves, one row a task, may be gathered.
    assert all(lines[i + 1].startswith("HashAggregate(keys=[], functions=[partial_") for i, x in enumerate(lines) if "SinglePartition" in x)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def exchanges(spark, df):
    """Hash exchanges of the plan with broadcasting off, subqueries included; a reused one is none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(df, "simple").count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_are_found_in_one_join(spark, w):
    orders = w.raw.orders
    found = cleaning.base_items(w.raw.items, orders)
    plan = plan_of(found, "simple")
    assert len(re.findall(r"\w*Join \[?order_id", plan)) <= 1
    source = exchanges(spark, cleaning.drop_nonpositive_orders(orders).select("order_id"))
    assert exchanges(spark, found) <= 2 * source + 3


def test_without_broadcast_the_big_join_can_be_split(spark, w):
    """Both inputs of the item join are exchanges of the join itself, as AQE needs for skew."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(customers.customer_products(w.raw.items, w.clean), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    join = next(i for i, line in enumerate(lines) if line.startswith("SortMergeJoin"))
    sides = [i for i, line in enumerate(lines) if line.startswith("Sort [order_id") and i > join]
    assert len(sides) >= 2
    assert all(lines[i + 1].startswith("Exchange hashpartitioning(order_id") for i in sides[:2])


def test_global_order_is_range_partitioned(spark, w):
    plan = plan_of(w.rfm_segments, "simple")
    assert "Window" not in plan or "_slice" in plan


def test_queries_work_without_broadcast(spark, sf_dir):
    """Results do not depend on a side being small."""
    run = registry.queries()["ml_features"]
    normal = sorted(run(spark, sf_dir).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(run(spark, sf_dir).collect()) == normal
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_type():
    assert Tables._fields == ("customers", "orders", "items", "products")
