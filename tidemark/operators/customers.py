"""Per-customer aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixedpoint import cents, from_cents, halves, joined_halves, micros, ratio, scaled, whole_cents, wide_sum
from tidemark.operators.cleaning import sellable
from tidemark.operators.ranking import with_ntile
from tidemark.params import Params

EXPAND_CHUNK = 65_536


def order_totals(orders: DataFrame, p: Params) -> DataFrame:
    """Everything the customer-level operators need from orders, in one aggregation.

    Amounts are integers (millionths; billionths of a percent for the discount), so partial
    sums combine to the same result in any order. Cents are rounded from the sums, not from
    the rows. Unused columns are pruned.
    """
    amount = micros(F.col("total_amount"))
    discounted = F.col("discount_applied") == "Yes"
    pct = scaled(F.col("discount_percentage"), 9)
    recent = F.datediff(F.lit(p.ref_date), F.col("order_date")) <= p.recent_days
    totals = orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.count("total_amount").alias("amounts"),
        wide_sum(amount).alias("spend"),
        F.max(amount).alias("most"),
        F.min(amount).alias("least"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum(F.when(discounted, 1).otherwise(0)).alias("discounted_orders"),
        F.count(F.when(discounted, F.col("discount_percentage"))).alias("discounts"),
        wide_sum(F.when(discounted, pct)).alias("discount_sum"),
        wide_sum(pct).alias("all_discount_sum"),
        wide_sum(F.when(recent, amount).otherwise(0)).alias("recent"),
    )
    rounded = {"spend_cents": "spend", "max_cents": "most", "min_cents": "least", "recent_cents": "recent"}
    return totals.withColumns({name: whole_cents(F.col(total)) for name, total in rounded.items()})


def mean_cents(total: Column, n: Column) -> Column:
    """Mean of amounts summed in millionths, in whole cents."""
    return ratio(total, n * 10_000, 0)


def mean_discount(total: Column, n: Column) -> Column:
    """Mean of percentages summed in billionths, two decimals."""
    return ratio(total.cast("double") / F.lit(1e9), n, 2)


def customer_stats(clean: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Aggregated first, joined second: the join sees one row per customer on both sides."""
    totals = order_totals(clean, p)
    return totals.join(customers, "customer_id").select(
        "customer_id",
        "city",
        "signup_date",
        "channel",
        from_cents(F.col("spend_cents")).alias("total_revenue"),
        from_cents(mean_cents(F.col("spend"), F.col("amounts"))).alias("avg_order_value"),
        from_cents(F.col("max_cents")).alias("max_order_value"),
        "order_count",
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("lifespan_days"),
        F.datediff(F.lit(p.ref_date), "last_order_date").alias("days_since_last_purchase"),
        "discounted_orders",
        ratio(F.col("discounted_orders") * 100, F.col("order_count"), 2).alias("discount_usage_rate_pct"),
        mean_discount(F.col("discount_sum"), F.col("discounts")).alias("avg_discount_pct"),
    )


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Every row ``count`` times (``count`` is dropped).

    A row that stands for very many is first split into chunks that are shuffled, so a
    hot group is written out by many tasks.
    """
    n = F.col(count)
    few = df.filter(n <= EXPAND_CHUNK).withColumn("_copy", F.explode(F.sequence(F.lit(1), n.cast("int"))))
    chunks = (
        df.filter(n > EXPAND_CHUNK)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"CAST(({count} - 1) DIV {EXPAND_CHUNK} AS INT)"))))
        .repartition(*[c for c in df.columns if c != count], "_chunk")
    )
    in_chunk = F.least(F.lit(EXPAND_CHUNK), n - F.col("_chunk") * EXPAND_CHUNK).cast("int")
    many = chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), in_chunk))).drop("_chunk")
    return few.unionByName(many).drop("_copy", count)


def _dated_gaps(clean: DataFrame) -> DataFrame:
    """Per customer and order date: number of orders and days since the previous date.

    The window sees one row per calendar day at most, never all orders of a customer.
    """
    days = (
        clean.filter(F.col("order_date").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(F.count(F.lit(1)).alias("orders_that_day"))
    )
    previous = F.lag("order_date").over(Window.partitionBy("customer_id").orderBy("order_date"))
    return days.withColumn("days_gap", F.datediff("order_date", previous))


def order_gaps(clean: DataFrame) -> DataFrame:
    """Days since the previous order: the first order of a day has the gap, the others 0."""
    gaps = _dated_gaps(clean).withColumn(
        "_kind",
        F.explode(
            F.array(
                F.struct(F.col("days_gap").alias("gap"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(0).alias("gap"), (F.col("orders_that_day") - 1).alias("n")),
            )
        ),
    )
    rows = gaps.select("customer_id", "order_date", F.col("_kind.gap").alias("days_gap"), F.col("_kind.n").alias("_n"))
    return repeat_rows(rows.filter(F.col("days_gap").isNotNull() & (F.col("_n") > 0)), "_n")


def purchase_intervals(clean: DataFrame) -> DataFrame:
    """Mean, smallest and largest gap of customers with two orders or more.

    The gaps of a customer add up to the lifespan, so the mean needs no gap rows.
    """
    per_customer = (
        _dated_gaps(clean)
        .groupBy("customer_id")
        .agg(
            F.sum("orders_that_day").alias("n"),
            F.max("orders_that_day").alias("busiest"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("lifespan"),
            F.min("days_gap").alias("shortest"),
            F.max("days_gap").alias("longest"),
        )
        .filter(F.col("n") > 1)
    )
    same_day = F.col("busiest") > 1
    return per_customer.select(
        "customer_id",
        ratio(F.col("lifespan"), F.col("n") - 1, 1).alias("avg_purchase_interval_days"),
        F.when(same_day, F.lit(0.0)).otherwise(F.col("shortest").cast("double")).alias("min_purchase_interval_days"),
        F.coalesce(F.col("longest"), F.lit(0)).cast("double").alias("max_purchase_interval_days"),
    )


def line_micros(items: DataFrame) -> Column:
    return micros(F.col("quantity") * F.col("price"))


def order_owners(orders: DataFrame) -> DataFrame:
    """(order_id, customer_id, copies): normally one copy, more where an order_id repeats."""
    return orders.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("copies"))


def customer_products(items: DataFrame, clean: DataFrame) -> DataFrame:
    """Units and spend (millionths, in ``halves``) per customer and product.

    An order_id that occurs k times among the clean orders repeats its items k times, and
    joining them to the orders repeats them again. The repetition is applied as a weight
    instead of materialising k * k rows. The copy count is taken under a derived key so
    that the join shuffles both sides itself: then AQE can split an order holding a large
    share of all items.
    """
    same_order = Window.partitionBy(F.xxhash64("order_id"), "order_id")
    owners = order_owners(clean).select(
        "order_id", "customer_id", (F.col("copies") * F.sum("copies").over(same_order)).alias("weight")
    )
    lines = sellable(items).select("order_id", "product_id", "quantity", line_micros(items).alias("spend"))
    high, low = halves(F.col("spend") * F.col("weight"))
    return (
        lines.join(owners, "order_id")
        .groupBy("customer_id", "product_id")
        .agg(
            F.sum(F.col("quantity") * F.col("weight")).alias("units"),
            F.sum(high).alias("spend_high"),
            F.sum(low).alias("spend_low"),
        )
    )


def spend_of(listed: str) -> Column:
    """Sum of the spend of :func:`customer_products`, each row ``listed`` times."""
    return joined_halves(F.sum(F.col("spend_high") * F.col(listed)), F.sum(F.col("spend_low") * F.col(listed)))


def product_mix(items: DataFrame, clean: DataFrame, products: DataFrame) -> DataFrame:
    """Reduced to customer and product before the product join, so that
    COUNT(DISTINCT product) is a plain count afterwards."""
    categories = products.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("listed"))
    return (
        customer_products(items, clean)
        .join(categories, "product_id")
        .groupBy("customer_id", "category")
        .agg(
            F.sum(F.col("units") * F.col("listed")).alias("total_units"),
            from_cents(whole_cents(spend_of("listed"))).alias("category_revenue"),
            F.count(F.lit(1)).alias("distinct_products"),
        )
    )


def pareto_quintiles(stats: DataFrame) -> DataFrame:
    """Revenue share of each fifth of the customers, largest spenders first."""
    spend = stats.select("customer_id", cents(F.col("total_revenue")).alias("cents"))
    tiles = with_ntile(spend, [F.col("cents").desc(), F.col("customer_id")], 5, "quintile")
    sums = tiles.groupBy("quintile").agg(
        F.count(F.lit(1)).alias("customer_count"), wide_sum(F.col("cents")).alias("cents")
    )
    total = F.sum("cents").over(Window.partitionBy())  # five rows
    return sums.select(
        "quintile",
        "customer_count",
        ratio(F.col("cents"), F.lit(100), 0).alias("quintile_revenue"),
        ratio(F.col("cents").cast("double") * 100, total, 1).alias("revenue_share_pct"),
    )
