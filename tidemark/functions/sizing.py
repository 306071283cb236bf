"""Partition sizes for iterative training."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

ROWS_PER_PARTITION = 25_000
PARTITIONS = 24  # as many at first; beyond them partitions grow
LARGEST_PARTITION = 250_000


def training_partitions(rows: int) -> int:
    """One for every ``ROWS_PER_PARTITION`` rows up to ``PARTITIONS``, then larger ones, and more only of the largest.

    Every level of a boosted tree is a job with as many tasks for its few sums as for its rows, so small partitions of a large
    table cost more than their rows do.
    """
    small = max(1, -(-rows // ROWS_PER_PARTITION))
    return small if small <= PARTITIONS else max(PARTITIONS, -(-rows // LARGEST_PARTITION))


def cached_for_training(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Cache ``df``, without ``key``, in equal partitions that are worth a task.

    Boosting runs thousands of short jobs over the same rows: on a small table the tasks cost more than their work, on a large
    one each job lasts as long as its largest task. Partitions that are only merged are as uneven as what they are merged
    from, so a table of more than one is dealt by the hash of ``key`` and sorted: as many partitions, with the same rows in the same order,
    wherever it is built. The caller unpersists.
    """
    partitions = training_partitions(rows)
    dealt = df.coalesce(1) if partitions == 1 else df.repartition(partitions, key).sortWithinPartitions(key)
    return dealt.drop(key).persist(StorageLevel.MEMORY_AND_DISK)
