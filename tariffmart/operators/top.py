"""Best row per group.

``row_number() = 1`` is planned with a group limit before the shuffle: each task sends at most one row per
group, so neither a hot key nor many candidates per day gather in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, by: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each group in the given total order."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_price_first() -> list[Column]:
    """Order of preference among prices that hold on the same day."""
    return [F.col("effective_start").desc(), F.col("created_at").desc(), F.col("price_hist_id").desc()]


def largest_discount_first() -> list[Column]:
    """Largest bare number first (percent and flat alike), then the older one; the id makes it total."""
    return [F.col("discount_value").desc(), F.col("start_date").asc(), F.col("discount_event_id").asc()]
