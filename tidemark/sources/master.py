"""Sink and source of the customer master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that are coerced to numbers, a bad or missing value becoming 0.
COERCED = ["recency_days", "frequency", "monetary", "churn_prob", "ltv_predicted"]


def write_master(master: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the master at ``path`` (``parquet`` or ``csv`` with a header)."""
    master.write.mode("overwrite").format(fmt).option("header", True).save(path)


def coerce_numeric(df: DataFrame, columns: list[str] = COERCED) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in present})


def load_master(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a master written by :func:`write_master`.

    CSV is read as text first: a bad number must become 0 and not fail or null the row.
    """
    if fmt == "parquet":
        return coerce_numeric(spark.read.parquet(path))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = coerce_numeric(spark.read.schema(text).option("header", True).csv(path))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name not in COERCED}
    return rows.withColumns(typed)
