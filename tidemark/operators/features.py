"""The customer feature table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import from_cents, halves, quotient, ratio
from tidemark.operators.customers import (
    customer_products,
    line_micros,
    mean_cents,
    mean_discount,
    order_owners,
    order_totals,
    spend_of,
)
from tidemark.params import Params

DAYS_PER_MONTH = 30


def share_column(category: str) -> str:
    return re.sub(r"\W+", "_", category.lower()) + "_spend_share"


def feature_columns(p: Params) -> list[str]:
    return [
        "customer_id",
        "city",
        "channel",
        "tenure_days",
        "recency_days",
        "frequency",
        "monetary",
        "avg_order_value",
        "lifespan_days",
        "days_since_signup",
        "discount_usage_rate",
        "avg_discount_pct",
        "max_order_value",
        "min_order_value",
        "orders_per_month",
        *[share_column(c) for c in p.categories],
        "distinct_products_bought",
        "recent_spend_ratio",
        "is_churned",
    ]


def _base(clean: DataFrame, p: Params) -> DataFrame:
    """One aggregation serves the base values, the velocity and the spend trend."""
    ref = F.lit(p.ref_date)
    return order_totals(clean, p).select(
        "customer_id",
        F.col("order_count").alias("frequency"),
        from_cents(F.col("spend_cents")).alias("monetary"),
        from_cents(mean_cents(F.col("spend"), F.col("amounts"))).alias("avg_order_value"),
        F.datediff(ref, "last_order_date").alias("recency_days"),
        F.datediff("last_order_date", "first_order_date").alias("lifespan_days"),
        F.datediff(ref, "first_order_date").alias("days_since_signup"),
        ratio(F.col("discounted_orders") * 100, F.col("order_count"), 2).alias("discount_usage_rate"),
        mean_discount(F.col("discount_sum"), F.col("discounts")).alias("avg_discount_pct"),
        from_cents(F.col("max_cents")).alias("max_order_value"),
        from_cents(F.col("min_cents")).alias("min_order_value"),
        "recent_cents",
        "recent",
        "spend",
    )


def _velocity() -> Column:
    frequency, lifespan = F.col("frequency"), F.col("lifespan_days")
    return F.when(lifespan >= DAYS_PER_MONTH, ratio(frequency * DAYS_PER_MONTH, lifespan, 3)).otherwise(
        frequency.cast("double")
    )


def feat_base(clean: DataFrame, p: Params) -> DataFrame:
    return _base(clean, p).drop("recent_cents", "recent", "spend")


def feat_velocity(clean: DataFrame, p: Params) -> DataFrame:
    return _base(clean, p).select("customer_id", _velocity().alias("orders_per_month"))


def feat_spend_trend(clean: DataFrame, p: Params) -> DataFrame:
    return _base(clean, p).select(
        "customer_id",
        from_cents(F.col("recent_cents")).alias("revenue_last_90d"),
        F.col("monetary").alias("revenue_total"),
    )


def _category_listing(products: DataFrame, p: Params) -> DataFrame:
    """One row per product: how often it is listed, in all and in each category.

    Grouped under a derived key as well, so that the product join shuffles both sides
    itself and AQE can split a product that nearly every customer buys.
    """
    hits = [F.sum(F.when(F.col("category") == c, 1).otherwise(0)).alias(f"_in_{i}") for i, c in enumerate(p.categories)]
    listing = products.groupBy(F.xxhash64("product_id").alias("_slot"), "product_id").agg(
        F.count(F.lit(1)).alias("listed"), F.count("category").alias("categorised"), *hits
    )
    return listing.drop("_slot")


def feat_category_share(items: DataFrame, clean: DataFrame, products: DataFrame, p: Params) -> DataFrame:
    """Fraction of the spend per category, three decimals."""
    spend = spend_of("listed")
    return (
        customer_products(items, clean)
        .join(_category_listing(products, p), "product_id")
        .groupBy("customer_id")
        .agg(
            *[
                ratio(spend_of(f"_in_{i}"), spend, 3).alias(share_column(c))
                for i, c in enumerate(p.categories)
            ],
            F.count(F.lit(1)).alias("distinct_products_bought"),
        )
    )


def feat_meta(customers: DataFrame, p: Params) -> DataFrame:
    return customers.select(
        "customer_id", "city", "channel", F.datediff(F.lit(p.ref_date), "signup_date").alias("tenure_days")
    )


def _churned(p: Params) -> Column:
    return F.when(F.col("recency_days") > p.churn_days, 1).otherwise(0).alias("is_churned")


def ml_features(clean: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """All three inputs are one row per customer and hashed on customer_id before the joins.

    Of a customer without a dated order the monthly rate is unknown, as its dates are; :func:`feat_velocity` gives the order count.
    """
    joined = (
        _base(clean, p)
        .withColumn("orders_per_month", F.when(F.col("lifespan_days").isNotNull(), _velocity()))
        .join(feat_category_share(items, clean, products, p), "customer_id", "left")
        .join(feat_meta(customers, p), "customer_id", "left")
    )
    shares = [share_column(c) for c in p.categories]
    zero = F.lit(0.0)
    filled = joined.withColumns(
        {
            "avg_discount_pct": F.coalesce("avg_discount_pct", zero),
            **{c: F.coalesce(c, zero) for c in shares},
            "distinct_products_bought": F.coalesce("distinct_products_bought", F.lit(0)).cast("bigint"),
            "recent_spend_ratio": F.coalesce(ratio(F.col("recent"), F.col("spend"), 3), zero),
            "is_churned": _churned(p),
        }
    )
    return filled.select(*feature_columns(p))


def _alt_shares(items: DataFrame, orders: DataFrame, products: DataFrame, p: Params) -> DataFrame:
    """Shares of the alternative table: items of any base order; NULL prices count as 0."""
    lines = items.select("order_id", "product_id", F.coalesce(line_micros(items), F.lit(0)).alias("spend"))
    high, low = halves(F.col("spend") * F.col("copies"))
    bought = (
        lines.join(order_owners(orders), "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.sum(high).alias("spend_high"), F.sum(low).alias("spend_low"))
    )
    spend = spend_of("categorised")
    return (
        bought.join(_category_listing(products, p), "product_id", "left")
        .withColumn("categorised", F.coalesce("categorised", F.lit(0)))
        .groupBy("customer_id")
        .agg(
            *[
                ratio(spend_of(f"_in_{i}"), spend, 3).alias(share_column(c))
                for i, c in enumerate(p.categories)
            ],
            F.count("product_id").alias("distinct_products_bought"),
            F.sum("categorised").alias("_categorised"),
        )
        .filter(F.col("_categorised") > 0)
        .drop("_categorised")
    )


def ml_features_alt(
    orders: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame, p: Params
) -> DataFrame:
    """The alternative rules, over the base tables (flagged orders included).

    Lifespan is at least one day, the velocity has no 30-day rule but is capped at 30, the
    discount mean divides the percentages of all orders by the discounted ones, and
    whatever is missing becomes 0.
    """
    t = order_totals(orders, p).withColumns(
        {
            "lifespan_days": F.greatest(F.datediff("last_order_date", "first_order_date"), F.lit(1)),
            "recency_days": F.datediff(F.lit(p.ref_date), "last_order_date"),
        }
    )
    lifespan = F.when(F.col("last_order_date").isNotNull(), F.col("lifespan_days"))
    velocity = ratio(F.col("order_count") * DAYS_PER_MONTH, lifespan, 3)
    base = t.select(
        "customer_id",
        F.col("order_count").alias("frequency"),
        quotient(F.col("spend"), F.lit(1_000_000)).alias("monetary"),
        quotient(F.col("spend"), F.col("amounts") * 1_000_000).alias("avg_order_value"),
        quotient(F.col("most"), F.lit(1_000_000)).alias("max_order_value"),
        quotient(F.col("least"), F.lit(1_000_000)).alias("min_order_value"),
        "recency_days",
        lifespan.alias("lifespan_days"),
        ratio(F.col("discounted_orders") * 100, F.col("order_count"), 2).alias("discount_usage_rate"),
        mean_discount(F.col("all_discount_sum"), F.greatest("discounted_orders", F.lit(1))).alias("avg_discount_pct"),
        F.when(velocity.isNotNull(), F.least(velocity, F.lit(30.0))).alias("orders_per_month"),
        ratio(F.coalesce("recent", F.lit(0)), F.greatest("spend", F.lit(1_000_000).cast("decimal(30,0)")), 3).alias(
            "recent_spend_ratio"
        ),
        _churned(p),
    )
    joined = base.join(feat_meta(customers, p), "customer_id", "left").join(
        _alt_shares(items, orders, products, p), "customer_id", "left"
    )
    columns = joined.withColumn("days_since_signup", F.col("tenure_days")).select(*feature_columns(p))
    numeric = [c for c in columns.columns if c not in ("customer_id", "city", "channel")]
    return columns.na.fill(0, numeric).na.fill("0", ["city", "channel"])
