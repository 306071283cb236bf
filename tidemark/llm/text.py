"""Helpers the operators share: words, lines, ASCII lower case, reading, lineage."""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

__all__ = ["WORD", "Tables", "ascii_lower", "collected", "delete", "drop", "let", "let_go", "lines", "materialise", "read", "row_key", "same_key", "ship", "small_batches", "whole_number", "words"]

# What the contracts call white space, a word, and a letter to fold.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Shuffle files of a finished write are of no use: what it read from them is in the table.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWNER: ContextVar[Tables | None] = ContextVar("owner of the tables written now", default=None)


class Tables:
    """Owner of the tables written while it is entered; on leaving it deletes those that were not kept.

    ``keep`` hands a table whose frame outlives the owner to the owner around it. Without one, the table
    belongs, like a checkpoint, to whoever owns the shared folder. A lost executor costs nothing: a
    table is deleted only when the last one built from it is written.
    """

    def __init__(self) -> None:
        self.held: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Tables:
        self.around = _OWNER.get()
        _OWNER.set(self)
        return self

    def __exit__(self, *error) -> None:
        _OWNER.set(self.around)
        self.drop(*(frame for frame, _ in self.held))

    def drop(self, *frames: DataFrame) -> None:
        for frame, path in [x for x in self.held if any(x[0] is f for f in frames)]:
            delete(frame.sparkSession, path)
            self.held.remove((frame, path))

    def keep(self, *frames: DataFrame) -> None:
        for item in [x for x in self.held if any(x[0] is f for f in frames)]:
            self.held.remove(item)
            if self.around is not None:
                self.around.held.append(item)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(*frames: DataFrame) -> None:
    """Delete tables that nothing reads any more, before their owner is left."""
    if (owner := _OWNER.get()) is not None:
        owner.drop(*frames)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    Columns are encoded and compressed, where a checkpoint writes whole rows, and the planner knows
    the table's size. The table belongs to the :class:`Tables` entered last.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    frame = spark.read.schema(df.schema).parquet(path)
    if (owner := _OWNER.get()) is not None:
        owner.held.append((frame, path))
    return frame


def collected(df: DataFrame) -> pa.Table:
    """The rows of a bounded ``df`` on the driver. They go through a table, so the shuffle files behind them are deleted at once."""
    held = materialise(df)
    found = held.toArrow()
    drop(held)
    return found


def let_go(spark: SparkSession) -> None:
    """Between passes: Spark's cleaner deletes the broadcasts and shuffle files whose frames are gone, and the driver's heap
    shrinks to what is used. Left alone, it does so only when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tables written meanwhile hand so many rows at a time to Python; fewer, if the session asks for fewer."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) < rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def words(text: Column) -> Column:
    """All words of a whole text, in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def ascii_lower(text: Column) -> Column:
    """A-Z only: every other letter keeps its case."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it.

    Catalyst may inline a projected column into a lambda, where it would be evaluated for
    every element; a variable bound by ``transform`` cannot be inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_number(key: Column) -> Column:
    """The whole number that an id of any type is; NULL for others."""
    return key.cast("string").try_cast("long")


def row_key(text: str = "text", key: str = "doc_id") -> list[Column]:
    """What tells rows apart where ``doc_id`` alone may be NULL or repeated."""
    return [F.col(key).alias("_td_id"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias("_td_hash")]


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["_td_id"].eqNullSafe(right["_td_id"]) & (left["_td_hash"] == right["_td_hash"])


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value: workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
