"""Sums without decimals, and training partitions that are even and always the same."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sizing
from tidemark.functions.fixedpoint import wide_sum
from tidemark.operators import customers


def test_wide_sum_is_exact_beyond_bigint(spark):
    values = [2**63 - 1, 2**63 - 1, 2**62 + 3, -5, None]
    one = spark.createDataFrame([(v,) for v in values], "v bigint").agg(wide_sum(F.col("v")).alias("s"))
    assert one.first().s == Decimal(sum(v for v in values if v is not None))
    assert dict(one.dtypes)["s"] == "decimal(30,0)"
    least = spark.createDataFrame([(-(2**63),), (-(2**63),), (-1,)], "v bigint")
    assert least.agg(wide_sum(F.col("v")).alias("s")).first().s == Decimal(-(2**64) - 1)
    assert spark.createDataFrame([(None,)], "v bigint").agg(wide_sum(F.col("v")).alias("s")).first().s is None


def test_items_are_summed_in_longs(work):
    bought = customers.customer_products(work.raw.items, work.clean)
    assert not [kind for _, kind in bought.dtypes if kind.startswith("decimal")]


@pytest.mark.parametrize("slices", [3, 8])
def test_training_partitions_are_even_and_fixed(spark, monkeypatch, slices):
    monkeypatch.setattr(sizing, "ROWS_PER_PARTITION", 500)
    uneven = spark.range(4000, numPartitions=slices).withColumn("x", F.col("id") * 2)
    uneven = uneven.filter("id < 3000").unionByName(uneven.filter("id >= 3000").coalesce(1))
    dealt = sizing.cached_for_training(uneven, 4000, "id")
    found = dealt.rdd.glom().map(lambda rows: [r.x for r in rows]).collect()
    dealt.unpersist()
    assert len(found) == 8 and max(map(len, found)) < 1.3 * 500 and sum(map(len, found)) == 4000
    again = sizing.cached_for_training(uneven.orderBy(F.col("id").desc()), 4000, "id")
    assert again.rdd.glom().map(lambda rows: [r.x for r in rows]).collect() == found
    again.unpersist()


def test_partitions_of_a_large_training_table_grow_in_size(spark, monkeypatch):
    assert [sizing.training_partitions(n) for n in (0, 25_000, 25_001, 600_000)] == [1, 1, 2, 24]
    assert [sizing.training_partitions(n) for n in (900_000, 5_400_000, 6_000_001)] == [24, 24, 25]
    monkeypatch.setattr(sizing, "ROWS_PER_PARTITION", 50)
    dealt = sizing.cached_for_training(spark.range(4000), 4000, "id")
    sizes = dealt.withColumn("x", F.lit(1)).rdd.glom().map(len).collect()
    dealt.unpersist()
    assert len(sizes) == 24 and sum(sizes) == 4000 and max(sizes) < 1.5 * 4000 / 24
