"""Small helpers that the operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from tariffmart.session import written

__all__ = ["annotated", "argument", "by_bytes", "crc_fold", "given", "map_frames", "moved", "parts_for", "place_hash", "plain", "written"]


BATCH_BYTES = 1 << 21  # of texts that a task turns into Python objects at a time
SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this library to the executors through Spark, once an application, so their Python can import it."""
    if spark.sparkContext.applicationId not in SHIPPED:
        library = Path(__file__).parents[1]
        folder = tempfile.mkdtemp(prefix="code-")  # the driver's own; Spark serves the archive from there
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{library.name}", "zip", library.parent, library.name))
        SHIPPED.add(spark.sparkContext.applicationId)


def given(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """One of the given tables, read by Spark so that any store it knows will do."""
    ship_code(spark)
    return spark.read.parquet(f"{directory}/{table}.parquet")


def argument(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that other columns of the input cannot clash with those an operator adds."""
    return df.select(*[df[f"`{n}`"].alias(n) for n in names])


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % folds


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Text columns as plain objects: other text types may come in several chunks, which Arrow's structs refuse."""
    return frame.astype({c: object for c in frame.columns if isinstance(frame[c].dtype, pd.StringDtype)})


def map_frames(df: DataFrame, per_frame: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``mapInPandas`` for a function of one frame; frames without rows are skipped."""

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield plain(per_frame(frame))

    return df.mapInPandas(mapped, schema)


def annotated(
    df: DataFrame, inputs: list[str], per_rows: Callable[..., list[list]], schema: str, keep: list[str] | None = None, where: str | None = None
) -> DataFrame:
    """``df`` with further columns that ``per_rows`` finds from the lists of its input columns.

    ``keep`` names the columns of ``df`` that come back beside the new ones; without it all do. With ``where``, a condition
    on the new columns, the rows that meet it come back with the columns of ``df`` alone. Columns pass through as they
    are, so long ids beside nulls stay exact. They travel under numbers, so names that clash do no harm; the new ones come
    last. Batches are cut by the size of the first input, so few long texts are Python objects at a time.
    """
    added = StructType.fromDDL(schema)
    numbered = df.select(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(df.columns)])
    at = [df.columns.index(c) for c in inputs]
    back = [i for i, c in enumerate(df.columns) if keep is None or c in keep]
    out = StructType([StructField(f"c{i}", df.schema[i].dataType) for i in back] + list(added))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at[0], BATCH_BYTES):
            found = per_rows(*[batch.column(i).to_pylist() for i in at])
            new = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(found, added, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in back], *new], out.names)

    made = numbered.mapInArrow(mapped, out)
    old = [F.col(f"c{i}").alias(df.columns[i]) for i in back]
    return made.where(where).select(*old) if where else made.select(*old, *added.names)


def by_bytes(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut, in order, so that the values of ``column`` in one take about ``most`` bytes; a longer value is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        until = np.cumsum(sizes + 64)  # a row without text takes room as well
        at = 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def moved(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join whose rows move by key. The planner judges a written table by the size of its files and the
    types of the columns that are read, so it takes one beside wide empty columns for small and gathers it in the driver."""
    return df.hint("merge")


def place_hash() -> Column:
    """A hash of where a row of a written table lies: it tells rows apart that are equal in all they hold."""
    return F.xxhash64(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1), F.col("_metadata.row_index"))


def parts_for(rows: int, per_part: int) -> int:
    """How many parts of about ``per_part`` rows ``rows`` make, at least one."""
    return max(1, -(-rows // per_part))
