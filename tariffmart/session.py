"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "tariffmart", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local[...] session for tests and the bench. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder, since a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tariffmart-")
        context.setCheckpointDir(named)
        named = context.getCheckpointDir()
    return f"{named.rstrip('/')}/tariffmart-{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; never reused, so a retry cannot read half of an old write."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to shared Parquet and read it back: later steps read the table, not its lineage."""
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
