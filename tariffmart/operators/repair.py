"""Repair of overlapping price ranges: every range ends the day before the next one of its key starts.

The order within a key is (effective_start, created_at, price_hist_id). The next start depends only on
the distinct start days of the key and on which row is the last of its day, so the window runs over
(key, day) aggregates, and no task ever holds all rows of a hot key. Whole tables are repaired by a window over the rows
of each key, which moves them once; skus are counted first, and those above a bound of rows still go by days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmart.schemas import KEY

# The keys of a sku with more rows do not go through one window each but by days.
HOT_ROWS = 200_000


def _arrival() -> Column:
    """(created_at, id) as one number of fixed width, which keeps the aggregate a hash aggregate."""
    micros = F.unix_micros("created_at").cast("decimal(19,0)")
    return (micros * F.expr("CAST(10000000000000000000 AS DECIMAL(20,0))")).cast("decimal(38,0)") + F.col(
        "price_hist_id"
    ).cast("decimal(19,0)")


def with_next_start(prices: DataFrame) -> DataFrame:
    """Adds next_effective_start: the start of the following row of the key, NULL for its last row."""
    days = prices.groupBy(*KEY, "effective_start").agg(F.max(_arrival()).alias("_last_arrival"))
    following = F.lead("effective_start").over(Window.partitionBy(*KEY).orderBy("effective_start"))
    days = days.withColumn("_next_day", following)
    next_start = F.when(_arrival() == F.col("_last_arrival"), F.col("_next_day")).otherwise(F.col("effective_start"))
    return prices.join(days, [*KEY, "effective_start"]).select(
        *prices.columns, next_start.alias("next_effective_start")
    )


def with_next_row_start(prices: DataFrame) -> DataFrame:
    """The same next_effective_start by one window over the rows of each key, for complete rows of keys of bounded size:
    the next row of the same day starts that day too."""
    spread = F.hash(*KEY)  # tells most keys apart before their texts are compared
    order = Window.partitionBy("_spread", *KEY).orderBy("effective_start", "created_at", "price_hist_id")
    rows = prices.withColumn("_spread", spread).withColumn("next_effective_start", F.lead("effective_start").over(order))
    return rows.drop("_spread")


def repaired_end() -> Column:
    """The end a row gets: the day before the next start, but not before its own start; open if last.

    A row that already ends the day before the next start is left as it is, even if that is before its
    own start.
    """
    day_before = F.date_sub("next_effective_start", 1)
    return (
        F.when(F.col("next_effective_start").isNull(), F.lit(None).cast("date"))
        .when(F.col("effective_end") == day_before, F.col("effective_end"))
        .otherwise(F.greatest(day_before, F.col("effective_start")))
    )


def touched_by_repair() -> Column:
    """Rows the repair writes. A same-day tie already cut to one day is written again with the same value."""
    day_before = F.date_sub("next_effective_start", 1)
    has_next = F.col("next_effective_start").isNotNull()
    off = F.col("effective_end").isNull() | (F.col("effective_end") != day_before)
    return (has_next & off) | (~has_next & F.col("effective_end").isNotNull())


def repair_ranges(prices: DataFrame) -> DataFrame:
    """All price rows with repaired ends."""
    columns = [repaired_end().alias(c) if c == "effective_end" else F.col(c) for c in prices.columns]
    return with_next_start(prices).select(*columns)


def repair_all(prices: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As ``repair_ranges``, for stored rows (no NULL in key, start or arrival), moving rows of most keys once.

    Rows of a sku are counted first, reduced on the map side; the skus that come to the driver, those that could make one
    window long, are at most one in ``hot_rows`` rows.
    """
    hot = [r[0] for r in prices.groupBy("sku").count().filter(F.col("count") > hot_rows).select("sku").collect()]
    columns = [repaired_end().alias(c) if c == "effective_end" else F.col(c) for c in prices.columns]
    if not hot:
        return with_next_row_start(prices).select(*columns)
    by_row = with_next_row_start(prices.filter(~F.col("sku").isin(hot))).select(*columns)
    return by_row.unionByName(repair_ranges(prices.filter(F.col("sku").isin(hot))))


def ranges_changed(prices: DataFrame) -> DataFrame:
    """The rows a repair would write, with old and new end."""
    return (
        with_next_start(prices)
        .filter(touched_by_repair())
        .select(
            "price_hist_id", *KEY, "effective_start", F.col("effective_end").alias("old_end"), repaired_end().alias("new_end")
        )
    )


def range_changes(prices: DataFrame, is_new: Column) -> DataFrame:
    """The rows that a repair leaves different or that are new, as repaired, with ``old_end`` and ``is_new``."""
    rows = with_next_start(prices).withColumn("is_new", is_new).withColumn("old_end", F.col("effective_end"))
    changed = rows.withColumn("effective_end", repaired_end())
    return changed.filter("is_new OR NOT effective_end <=> old_end").select(*prices.columns, "old_end", "is_new")
