"""Typed scans of stored tables, and staging with lineage columns."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmart.functions.expressions import moment
from tariffmart.schemas import SCHEMAS


def load_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """One mart table with its declared schema; nothing is inferred."""
    return spark.read.format(fmt).options(**options).schema(SCHEMAS[name]).load(path)


def load_mart(spark: SparkSession, directory: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Typed scans of the tables stored below one directory."""
    return {name: load_table(spark, f"{directory}/{name}", name) for name in names or SCHEMAS}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A mart table without rows."""
    return spark.createDataFrame([], SCHEMAS[name])


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Columns of ``df`` in the order and types of a mart table; columns it lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[name].fields
        ]
    )


LINEAGE = ("source_file", "loaded_at")


def business_fields(name: str) -> list[T.StructField]:
    """The columns of a staging table that come from its source."""
    return [f for f in SCHEMAS[name].fields if f.name not in LINEAGE]


def file_rows(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The source columns of files, with the file each row came from; a folder with a file's name, as Spark writes
    them, is that file. Text formats are read as text, so that a value of a wrong type is still there to be reported;
    Parquet carries its types."""
    kind = (lambda f: f.dataType.simpleString()) if fmt == "parquet" else (lambda f: "string")
    fields = ", ".join(f"{f.name} {kind(f)}" for f in business_fields(name))
    raw = spark.read.format(fmt).options(**options).schema(fields).load(path)
    folder = F.nullif(F.regexp_extract("_metadata.file_path", r"([^/=]+\.(?:csv|json|orc|parquet|txt))/[^/]+$", 1), F.lit(""))
    columns = [f.name for f in business_fields(name)]
    return raw.select(*columns, F.coalesce(folder, F.col("_metadata.file_name")).alias("source_file"))


def broken_type(field: T.StructField) -> Column:
    """The text is not empty and cannot be read as the column's type."""
    value = F.col(field.name).cast("string")
    return value.isNotNull() & value.try_cast(field.dataType).isNull()


def malformed_rows(rows: DataFrame, name: str) -> DataFrame:
    """(table_name, source_file, columns, raw): rows with a value of a wrong type, kept as they came."""
    fields = business_fields(name)
    broken = F.array_compact(F.array(*[F.when(broken_type(f), F.lit(f.name)) for f in fields]))
    raw = F.to_json(F.struct(*[f.name for f in fields]))
    found = rows.select(F.lit(name).alias("table_name"), "source_file", broken.alias("columns"), raw.alias("raw"))
    return found.filter(F.size("columns") > 0)


def well_typed_rows(rows: DataFrame, name: str, loaded_at: dt.datetime | str | None = None) -> DataFrame:
    """The other rows as a staging table, with the time of the load."""
    when = F.current_timestamp() if loaded_at is None else moment(loaded_at)
    fields = business_fields(name)
    good = rows.filter(~reduce(lambda a, b: a | b, [broken_type(f) for f in fields]))
    typed = [F.col(f.name).cast("string").try_cast(f.dataType).alias(f.name) for f in fields]
    return as_table(good.select(*typed, "source_file", when.alias("loaded_at")), name)


def stage_files(
    spark: SparkSession,
    path: str,
    name: str,
    loaded_at: dt.datetime | str | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Files read as staging rows, with the file each row came from and the time of the load. Rows with a value of a
    wrong type are not among them; see :func:`malformed_rows`."""
    return well_typed_rows(file_rows(spark, path, name, fmt, **options), name, loaded_at)


def _counted_write(df: DataFrame, mode: str, path: str) -> int:
    """Write and count in one pass: the rows are observed as the last step before the write, so a task that is run
    again counts once."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get.get("n", 0)


def reload_staging(df: DataFrame, path: str) -> int:
    """Full reload: the staging table holds exactly these rows afterwards. Their number."""
    return _counted_write(df, "overwrite", path)


def append_rows(df: DataFrame, path: str) -> int:
    """Add rows to a stored table. Their number."""
    return _counted_write(df, "append", path)
