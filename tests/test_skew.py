"""Whole and exact results when single keys hold a third of all rows."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.operators import cleaning, customers, features
from tidemark.plans import registry

HOT = [
    "orders_clean",
    "items_clean",
    "customer_stats",
    "order_gaps",
    "purchase_intervals",
    "product_mix",
    "rfm_segments",
    "cohort_activity",
    "cohort_retention_alt",
    "ml_features",
    "ml_features_alt",
]


@pytest.fixture(scope="module")
def hot_tables(sf_dir, tmp_path_factory):
    """A third of the orders by one customer, a third of the lines of one order and one
    part, and one order repeated until its copies are a third of all orders."""
    folder = str(tmp_path_factory.mktemp("hot"))
    connection = duckdb.connect()
    changed = {
        "orders": """
            SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM source
            UNION ALL
            SELECT o.* FROM (SELECT * FROM source WHERE o_orderkey = 5) o,
                            range((SELECT count(*) // 2 FROM source)) r""",
        "lineitem": """
            SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 7 ELSE l_orderkey END AS l_orderkey,
                              CASE WHEN l_orderkey % 3 = 2 THEN 3 ELSE l_partkey END AS l_partkey)
            FROM source""",
    }
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        query = changed.get(name)
        if query is None:
            os.symlink(f"{sf_dir}/{file}", f"{folder}/{file}")
        else:
            source = f"WITH source AS (SELECT * FROM '{sf_dir}/{file}') {query}"
            connection.execute(f"COPY ({source}) TO '{folder}/{file}' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return folder, connection


@pytest.mark.parametrize("key", HOT)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_keys(key, broadcast, spark, hot_tables):
    folder, database = hot_tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    try:
        result = contract.queries()[key](spark, folder)
        names = sorted(result.columns)
        actual = [tuple(row) for row in result.select(*names).collect()]
    finally:
        for name in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        ):
            spark.conf.unset(name)
    expected = database.execute(f"SELECT {', '.join(names)} FROM ({contract.oracle_sql()[key]})").fetchall()
    by_text = lambda row: tuple((value is None, str(value)) for value in row)
    assert sorted(actual, key=by_text) == sorted(expected, key=by_text)


@pytest.mark.parametrize("joins, build", [
    (1, lambda w, items: customers.customer_products(items, w.clean)),
    (1, lambda w, items: cleaning.items_clean(items, w.clean)),
    (1, lambda w, items: cleaning.drop_orphan_items(items, w.base.orders)),
    (1, lambda w, items: features.feat_category_share(items, w.clean, w.raw.products, w.p)),
])
def test_aqe_splits_the_hot_order(joins, build, spark, hot_tables):
    """With broadcasting off, the join of items to orders runs as a skewed join."""
    folder, _ = hot_tables
    w = registry.workspace(spark, folder)
    w.raw.items.repartition(8).write.mode("overwrite").parquet(f"{folder}/eight_files")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        items = spark.read.parquet(f"{folder}/eight_files")
        df = build(w, items)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert plan.count("skew=true") >= joins
