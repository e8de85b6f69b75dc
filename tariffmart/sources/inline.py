"""Rows stated in code, number series and calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmart.functions.expressions import day, moment
from tariffmart.schemas import KEY, SCHEMAS
from tariffmart.sources import seed_values
from tariffmart.sources.tables import as_table


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A VALUES table: a few literal rows with a declared schema."""
    return spark.createDataFrame(rows, schema)


def number_series(spark: SparkSession, n: int) -> DataFrame:
    """Numbers 0 .. n-1 in a column ``n``."""
    return spark.range(n).select(F.col("id").cast("int").alias("n"))


def last_days(as_of: dt.date | str | Column, days: int) -> Column:
    """Array of the last ``days`` days up to and including ``as_of``."""
    return F.sequence(F.date_sub(day(as_of), days - 1), day(as_of))


def date_series(spark: SparkSession, as_of: dt.date | str, days: int = 60) -> DataFrame:
    """Calendar of the last ``days`` days in a column ``as_of_date``."""
    return spark.range(1).select(F.explode(last_days(as_of, days)).alias("as_of_date"))


def seed_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The seed rows of the four dimensions, as upsert sources."""
    rules = [
        (name, kind, priority, _iso(first), _iso(last), active)
        for name, kind, priority, first, last, active in seed_values.PRICING_RULES
    ]
    return {
        "dim_product": inline_rows(
            spark,
            [(*row, True) for row in seed_values.PRODUCTS],
            "sku string, product_name string, category string, brand string, is_active boolean",
        ),
        "dim_region": spark.createDataFrame(seed_values.REGIONS, SCHEMAS["dim_region"]),
        "dim_channel": spark.createDataFrame(seed_values.CHANNELS, SCHEMAS["dim_channel"]),
        "dim_pricing_rule": inline_rows(
            spark,
            rules,
            "rule_name string, rule_type string, priority int, start_date date, end_date date, is_active boolean",
        ),
    }


def _iso(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def bad_sku_prices(spark: SparkSession, start: dt.date, loaded_at: dt.datetime) -> DataFrame:
    """Staged price rows with NULL, blank and unknown skus."""
    rows = inline_rows(
        spark, seed_values.BAD_SKU_PRICES, "sku string, region_code string, channel_code string, price string"
    )
    staged = rows.select(
        "*",
        F.lit("USD").alias("currency"),
        day(start).alias("effective_start"),
        F.lit("PRICING_SYS").alias("source_system"),
        moment(loaded_at).alias("loaded_at"),
    )
    return as_table(staged, "stg_price_history")


def overlapping_discounts(spark: SparkSession, day_zero: dt.date, loaded_at: dt.datetime) -> DataFrame:
    """Staged discounts of one key that overlap each other."""
    rows = inline_rows(
        spark,
        seed_values.OVERLAPPING_DISCOUNTS,
        "discount_type string, discount_value string, first_day int, last_day int",
    )
    staged = rows.select(
        *[F.lit(value).alias(name) for name, value in zip(KEY, seed_values.OVERLAP_KEY)],
        "discount_type",
        "discount_value",
        F.date_add(day(day_zero), F.col("first_day")).alias("start_date"),
        F.date_add(day(day_zero), F.col("last_day")).alias("end_date"),
        moment(loaded_at).alias("loaded_at"),
    )
    return as_table(staged, "stg_discount_events")
