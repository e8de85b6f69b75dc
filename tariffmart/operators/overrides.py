"""Audit trail of manual price changes, from two snapshots of the price history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import moment
from tariffmart.schemas import KEY


def price_changed() -> Column:
    """The price differs and the row is the open one."""
    return (F.col("old_price") != F.col("new_price")) & F.col("effective_end").isNull()


def price_overrides(
    before: DataFrame,
    after: DataFrame,
    changed_by: str | Column | None = None,
    changed_at: dt.datetime | str | None = None,
    is_etl: bool = False,
) -> DataFrame:
    """Log rows for open prices that changed between two snapshots; none when the load itself wrote them."""
    if is_etl:
        after = after.limit(0)
    old = before.select("price_hist_id", F.col("price").alias("old_price"))
    new = after.select("price_hist_id", *KEY, F.col("price").alias("new_price"), "effective_end")
    who = F.current_user() if changed_by is None else changed_by if isinstance(changed_by, Column) else F.lit(changed_by)
    when = F.current_timestamp() if changed_at is None else moment(changed_at)
    return (
        new.join(old, "price_hist_id")
        .filter(price_changed())
        .select(
            "price_hist_id",
            *KEY,
            "old_price",
            "new_price",
            who.alias("changed_by"),
            when.alias("changed_at"),
            F.lit(None).cast("string").alias("reason"),
        )
    )
