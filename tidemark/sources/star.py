"""Adapter: the star-schema test tables seen as the four model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, scaled
from tidemark.sources.tables import Tables


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _scan(spark, sf_dir, "customer")
    nation = _scan(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("channel"),
    )


def star_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_cents = cents(F.col("l_extendedprice"))
    discounts = (
        _scan(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(line_cents * scaled(F.col("l_discount"), 2)).alias("wsum"),
            F.sum(line_cents).alias("cents"),
        )
    )
    orders = _scan(spark, sf_dir, "orders")
    discounted = F.col("wsum") > F.col("cents") * 5
    return orders.join(discounts, orders.o_orderkey == discounts.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(discounted, "Yes").otherwise("No").alias("discount_applied"),
        F.when(discounted, F.col("wsum").cast("double") / F.col("cents").cast("double"))
        .otherwise(F.lit(0.0))
        .alias("discount_percentage"),
    )


def star_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_extendedprice").alias("line_total"),
    )


def star_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.lower("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"),
    )


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        star_customers(spark, sf_dir),
        star_orders(spark, sf_dir),
        star_items(spark, sf_dir),
        star_products(spark, sf_dir),
    )


def dirty_tables(tables: Tables) -> Tables:
    """The same tables with every defect the cleaning rules look for."""
    rest = F.col("order_id") % 97

    def broken(rules: dict[int, Column], column: str, kind: str) -> Column:
        value = F.col(column)
        for remainder, bad in rules.items():
            value = F.when(rest == remainder, bad.cast(kind)).otherwise(value)
        return value.alias(column)

    source = tables.orders
    total = F.col("total_amount")
    finer = F.when(rest >= 20, total + F.lit(0.004)).otherwise(total)  # less than a cent, but not in a sum
    changed = source.withColumn("total_amount", finer).select(
        "order_id",
        broken({9: -F.col("order_id")}, "customer_id", "bigint"),
        broken({8: F.lit(None)}, "order_date", "date"),
        broken({5: -total, 6: F.lit(0.0), 7: F.lit(None)}, "total_amount", "double"),
        broken({3: F.lit("Yes"), 4: F.lit("No")}, "discount_applied", "string"),
        broken({1: F.lit(-5.0), 2: F.lit(130.0), 3: F.lit(0.0), 4: F.lit(10.0)}, "discount_percentage", "double"),
    )
    copies = source.filter(rest == 10)
    conflicting = source.filter(rest == 11).withColumn("total_amount", total + F.lit(1))
    orders = changed.unionByName(copies).unionByName(conflicting)

    item_rest = F.col("order_id") % 89
    items = tables.items.select(
        F.when(item_rest == 3, -F.col("order_id")).otherwise(F.col("order_id")).alias("order_id"),
        "product_id",
        F.when(item_rest == 1, F.lit(0)).otherwise(F.col("quantity")).alias("quantity"),
        F.when(item_rest == 2, -F.col("price"))
        .when(item_rest == 4, F.lit(None).cast("double"))
        .otherwise(F.col("price"))
        .alias("price"),
    )

    padded = tables.customers.withColumn(
        "city",
        F.when(F.col("customer_id") % 5 == 0, F.concat(F.lit("  "), "city", F.lit(" "))).otherwise(F.col("city")),
    )
    silent = tables.customers.filter(F.col("customer_id") % 50 == 0).withColumn(
        "customer_id", F.col("customer_id") + F.lit(1_000_000)
    )
    return Tables(padded.unionByName(silent), orders, items, tables.products)
