"""The four model tables: schemas and readers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables(NamedTuple):
    customers: DataFrame
    orders: DataFrame
    items: DataFrame
    products: DataFrame


CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("channel", T.StringType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("discount_applied", T.StringType()),
        T.StructField("discount_percentage", T.DoubleType()),
    ]
)
ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("line_total", T.DoubleType()),
    ]
)
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("margin_pct", T.DoubleType()),
    ]
)
SCHEMAS = {"customers": CUSTOMERS, "orders": ORDERS, "order_items": ORDER_ITEMS, "products": PRODUCTS}


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_tables(spark: SparkSession, folder: str) -> Tables:
    """``customers.csv``, ``orders.csv``, ``order_items.csv`` and ``products.csv`` of a folder.

    The schema is declared, so no pass over the data is spent on inference, and the
    header is checked against it.
    """
    return Tables(*[read_csv_table(spark, f"{folder}/{name}.csv", schema) for name, schema in SCHEMAS.items()])


def read_parquet_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(*[spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in SCHEMAS.items()])


# The whole line of a row that does not fit its schema.
REJECTED = "_rejected"


def _read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, with the line of those that do not fit."""
    wide = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    reader = spark.read.schema(wide).option("header", True).option("enforceSchema", False)
    read = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    # Always true, but it names every column: a field that a query doesn't need would not be parsed, and a bad one not seen.
    return read.filter(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names]) >= "")


def _line() -> Column:
    """The rejected line, else empty. A test for NULL would be pushed into the parser, which knows a line is bad only afterwards."""
    return F.coalesce(F.col(REJECTED), F.lit(""))


def read_csv_checked(spark: SparkSession, folder: str) -> Tables:
    """Like :func:`read_csv_tables`, without the rows that have an unparsable field, or too few or too many. An empty field is NULL and fits."""
    return Tables(
        *[_read_checked(spark, f"{folder}/{name}.csv", schema).filter(_line() == "").drop(REJECTED) for name, schema in SCHEMAS.items()]
    )


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, line): the rows that :func:`read_csv_checked` leaves out."""
    found = None
    for name, schema in SCHEMAS.items():
        read = _read_checked(spark, f"{folder}/{name}.csv", schema)
        lines = read.filter(_line() != "").select(F.lit(name).alias("table_name"), F.col(REJECTED).alias("line"))
        found = lines if found is None else found.unionByName(lines)
    return found


def write_rejected(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Write the rejected rows to a table of their own; (table_name, rejected) counts them there, without another pass over the files.

    (``DataFrame.observe`` could count them while the tables are read, but a session that has observed once can no longer
    serialise a fitted logistic regression.)
    """
    rejected_rows(spark, folder).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).groupBy("table_name").agg(F.count(F.lit(1)).alias("rejected"))
