"""Cleaning rules as pure transforms; nothing is mutated in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.params import Params
from tidemark.sources import Tables

ORDER_IDENTITY = ["order_id", "customer_id", "order_date", "total_amount"]


def dedup_orders(orders: DataFrame) -> DataFrame:
    """One row per order identity; NULL keys compare equal.

    A distributed table has no first-loaded row, so the survivor is the smallest
    (discount_applied, discount_percentage). An aggregate rather than a window: copies
    collapse before the shuffle, however many of them there are.
    """
    details = [c for c in orders.columns if c not in ORDER_IDENTITY]
    survivor = orders.groupBy(*ORDER_IDENTITY).agg(F.min(F.struct(*details)).alias("_kept"))
    return survivor.select(*ORDER_IDENTITY, "_kept.*")


def fix_discount_pct(orders: DataFrame) -> DataFrame:
    pct = F.col("discount_percentage")
    return orders.withColumn("discount_percentage", F.when((pct < 0) | (pct > 100), F.lit(0.0)).otherwise(pct))


def sync_discount_flag(orders: DataFrame) -> DataFrame:
    """Make the flag agree with a percentage that :func:`fix_discount_pct` has corrected."""
    flag, pct = F.col("discount_applied"), F.col("discount_percentage")
    return orders.withColumn(
        "discount_applied",
        F.when((flag == "Yes") & (pct == 0), "No").when((flag == "No") & (pct > 0), "Yes").otherwise(flag),
    )


def drop_nonpositive_orders(orders: DataFrame) -> DataFrame:
    """A NULL amount is not "<= 0" and stays, as it does in a SQL DELETE."""
    amount = F.col("total_amount")
    return orders.filter(amount.isNull() | (amount > 0))


def flag_order_dates(orders: DataFrame, p: Params) -> DataFrame:
    day = F.col("order_date")
    outside = (day < F.lit(p.window_start)) | (day > F.lit(p.window_end))
    return orders.withColumn("date_flag", F.when(outside, 1).otherwise(0))


def base_orders(orders: DataFrame, p: Params) -> DataFrame:
    """The orders table after every order rule, flagged dates included."""
    return flag_order_dates(drop_nonpositive_orders(sync_discount_flag(fix_discount_pct(dedup_orders(orders)))), p)


def orders_clean(orders: DataFrame, p: Params) -> DataFrame:
    """Unflagged orders with a positive amount.

    Stated as a date range and not as ``date_flag = 0``: both filters are on order
    identity columns, so they pass below the deduplication into the scan.
    """
    day = F.col("order_date")
    in_window = day.isNull() | day.between(F.lit(p.window_start), F.lit(p.window_end))
    valid = orders.filter(in_window & (F.col("total_amount") > 0))
    return sync_discount_flag(fix_discount_pct(dedup_orders(valid))).withColumn("date_flag", F.lit(0))


def flagged_orders(base: DataFrame) -> DataFrame:
    return base.filter(F.col("date_flag") == 1)


def drop_orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """All but the items whose order key is NOT IN the orders.

    NOT IN is unknown, and the item stays, if its key is NULL or any order has a NULL key. An existence join: the items
    meet the distinct keys once, with a marker. The flag for NULL keys counts what the filter lets through; it reaches the
    scan, so that is usually nothing. ``orders`` may hold copies. The keys are made distinct under a derived key, so that
    the join shuffles both sides itself and AQE can split a hot order.
    """
    keys = orders.select("order_id")
    present = keys.filter(F.col("order_id").isNotNull())
    marked = present.groupBy(F.xxhash64("order_id"), "order_id").agg(F.lit(True).alias("_known")).select("order_id", "_known")
    any_null = keys.filter(F.col("order_id").isNull()).agg((F.count(F.lit(1)) > 0).alias("any_null")).scalar()
    met = items.join(marked, "order_id", "left")
    return met.filter(F.col("_known") | F.col("order_id").isNull() | any_null).select(*items.columns)


def drop_bad_items(items: DataFrame) -> DataFrame:
    """A NULL quantity or price stays until :func:`items_clean`."""
    keep = [F.col(c).isNull() | (F.col(c) > 0) for c in ("quantity", "price")]
    return items.filter(keep[0] & keep[1])


def base_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The items after every item rule. Which orders exist does not depend on their copies: raw ``orders`` will do."""
    return drop_orphan_items(drop_bad_items(items), drop_nonpositive_orders(orders))


def sellable(items: DataFrame) -> DataFrame:
    return items.filter((F.col("quantity") > 0) & (F.col("price") > 0))


def items_clean(items: DataFrame, clean: DataFrame) -> DataFrame:
    """One row per item and matching clean order: a repeated order_id repeats its items."""
    return sellable(items).join(clean.select("order_id"), "order_id").select(*items.columns)


def _buyers(base: DataFrame) -> DataFrame:
    return base.select("customer_id").distinct()  # collapses a hot customer before the shuffle


def active_customers(customers: DataFrame, base: DataFrame) -> DataFrame:
    return customers.join(_buyers(base), "customer_id", "left_semi")


def inactive_customers(customers: DataFrame, base: DataFrame) -> DataFrame:
    return customers.join(_buyers(base), "customer_id", "left_anti")


def clean_city(customers: DataFrame, title_case: bool = False) -> DataFrame:
    city = F.trim("city")
    return customers.withColumn("city", F.initcap(city) if title_case else city)


def orphan_order_count(base: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of unknown customers. Counted per customer first, so the join is one row per key."""
    per_customer = base.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_customer.join(customers.select("customer_id"), "customer_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphaned_orders"))


def clean_tables(tables: Tables, p: Params) -> Tables:
    """The model tables after all cleaning rules (flagged orders still present)."""
    orders = base_orders(tables.orders, p)
    return Tables(clean_city(tables.customers), orders, base_items(tables.items, tables.orders), tables.products)
