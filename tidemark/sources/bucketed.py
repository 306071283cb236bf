"""The model tables stored in buckets: orders and their items meet without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import SCHEMAS, Tables

BUCKET_KEYS = {"customers": "customer_id", "orders": "order_id", "order_items": "order_id"}
# A table is left as it is if one key holds more rows than so many buckets of equal size.
HOT_BUCKETS = 4


def has_hot_key(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether the rows of one key, NULL included, outweigh ``HOT_BUCKETS`` buckets. Counted map side first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg((F.max("n") * buckets > F.sum("n") * HOT_BUCKETS).alias("hot"), F.max("n").alias("most")).first()
    return bool(largest["hot"]) and largest["most"] > 1


def write_bucketed(tables: Tables, prefix: str, folder: str, buckets: int = 1024) -> None:
    """Store ``tables`` as ``<prefix>_orders`` and so on, their files below ``folder``.

    Orders and items are bucketed and sorted by order, customers by customer, so joins and deduplication by those keys read
    them in place. A bucket is read by one task, which AQE cannot split. A table with a hot key is therefore stored without
    buckets: its joins shuffle it, and the skew split applies. Existing tables are replaced.
    """
    for name, df in zip(SCHEMAS, tables):
        key = BUCKET_KEYS.get(name)
        if key is None or has_hot_key(df, key, buckets):
            writer = df.write
        else:
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(f"{prefix}_{name}")


def read_bucketed(spark: SparkSession, prefix: str) -> Tables:
    return Tables(*[spark.table(f"{prefix}_{name}") for name in SCHEMAS])
