"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    AQE sizes reducers and splits skewed join partitions at run time; forcing the
    skew split lets it apply even where a later operator would reuse the partitioning.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Call sites in error messages cost two round trips to the JVM per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder is lost together with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, for tables written between steps."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
