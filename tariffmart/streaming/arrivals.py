"""Arrivals loaded as they come: a stream over the staging folders whose micro-batches are refreshes.

Each staging table is a folder that files are dropped into. Structured Streaming remembers in its checkpoint which files
it has seen, and every micro-batch runs one refresh with the rows of its new files. The refresh is logged with the name of
the batch, so a batch that is given again after a lost driver is not loaded twice. Late rows need no watermark: a refresh
sorts them into their place.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tariffmart.plans.store import MartStore
from tariffmart.schemas import SCHEMAS
from tariffmart.session import scratch_path
from tariffmart.sources.tables import empty_table, load_table

STAGING_OF_STREAM = ["stg_price_history", "stg_sales", "stg_discount_events"]


def arrivals(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of a staging table as a stream over the files of its folder, oldest first."""
    reader = spark.readStream.schema(SCHEMAS[name]).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def files_as_table(spark: SparkSession, files: list[str], folder: str, name: str) -> DataFrame:
    """The rows of Parquet files of a staging folder, named as in ``_metadata.file_path``."""
    if not files:
        return empty_table(spark, name)
    literal = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file)) for file in files]  # a path given to a reader is a pattern
    rows = spark.read.schema(SCHEMAS[name]).option("basePath", folder).parquet(*sorted(literal))
    return rows.select(*SCHEMAS[name].names)


def stream_refresh(
    store: MartStore,
    dims: Callable[[], dict[str, DataFrame]],
    folder: str,
    checkpoint: str,
    name: str,
    loaded_at: dt.datetime | None = None,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start loading one staging folder as files arrive; stops by itself when all that is there has been loaded.

    ``dims`` is asked anew for each batch, so dimensions may change between them. Ends of staged prices are left out of
    the comparison with stored ones, since the repair of an earlier batch may have moved those. Run one table's stream at
    a time, prices, sales and discounts in any order: refreshes of a mart do not overlap.
    """
    rows = arrivals(store.spark, f"{folder}/{name}", name, files_per_batch, fmt)
    in_place = fmt == "parquet" and not re.search(r"[*?\[{]", folder)  # a pattern has no base for the files below it
    if in_place:
        rows = rows.select("_metadata.file_path")  # a batch is its files; none of their columns is read for it

    def staged_rows(batch: DataFrame) -> DataFrame:
        if in_place:
            files = [row.file_path for row in batch.distinct().collect()]
            return files_as_table(store.spark, files, f"{folder}/{name}", name)
        path = scratch_path(store.spark, "arrivals")
        batch.write.parquet(path)  # read once from its files, as the format may be a slow one
        return load_table(store.spark, path, name)

    def load(batch: DataFrame, number: int) -> None:
        staged = staged_rows(batch)
        store.refresh({name: staged}, dims(), loaded_at, idempotent=True, batch=f"{name}-{number}")

    return (
        rows.writeStream.queryName(f"refresh {name}")
        .foreachBatch(load)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(availableNow=True)
        .start()
    )


def load_arrivals(store: MartStore, dims: Callable[[], dict[str, DataFrame]], folder: str, checkpoint: str, **settings) -> None:
    """Load all that has arrived in the folders of all staging tables."""
    for name in STAGING_OF_STREAM:
        stream_refresh(store, dims, folder, checkpoint, name, **settings).awaitTermination()
