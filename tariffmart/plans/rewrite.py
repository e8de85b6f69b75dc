"""The sales/price/discount report in its two forms, and the check whether they agree (they do not)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import day
from tariffmart.operators.intervals import active_on
from tariffmart.operators.merge import diff_summary, row_differences
from tariffmart.operators.top import first_per_group, largest_discount_first, latest_price_first
from tariffmart.session import written

REPORT = ["sku", "total_qty", "total_sales", "current_price", "active_discount_value"]


def sales_by_sku(sales: DataFrame, first: dt.date, last: dt.date, region: str, channel: str) -> DataFrame:
    """Quantity and net sales per sku in a period, region and channel."""
    return (
        sales.filter(F.col("sale_date").between(day(first), day(last)))
        .filter((F.col("region_code") == region) & (F.col("channel_code") == channel))
        .groupBy("sku")
        .agg(F.sum("qty").alias("total_qty"), F.sum("net_sales").cast("decimal(38,2)").alias("total_sales"))
    )


def _in_force(df: DataFrame, start: str, end: str, as_of: dt.date, region: str, channel: str) -> DataFrame:
    return df.filter(active_on(start, end, as_of)).filter(
        (F.col("region_code") == region) & (F.col("channel_code") == channel)
    )


def top_price_per_sku(prices: DataFrame, as_of: dt.date, region: str, channel: str) -> DataFrame:
    """The price in force per sku: latest start first."""
    held = _in_force(prices, "effective_start", "effective_end", as_of, region, channel)
    return first_per_group(held, ["sku"], latest_price_first()).select("sku", F.col("price").alias("current_price"))


def top_discount_per_sku(discounts: DataFrame, as_of: dt.date, region: str, channel: str) -> DataFrame:
    """The largest discount in force per sku."""
    held = _in_force(discounts, "start_date", "end_date", as_of, region, channel)
    return first_per_group(held, ["sku"], largest_discount_first()).select(
        "sku", F.col("discount_value").alias("active_discount_value")
    )


def tuned_report(
    facts: dict[str, DataFrame], first: dt.date, last: dt.date, as_of: dt.date, region: str, channel: str
) -> DataFrame:
    """Sales are aggregated first, then joined to the one best price and the one best discount per sku."""
    return (
        sales_by_sku(facts["fact_sales"], first, last, region, channel)
        .join(top_price_per_sku(facts["fact_price_history"], as_of, region, channel), "sku", "left")
        .join(top_discount_per_sku(facts["fact_discount_events"], as_of, region, channel), "sku", "left")
        .select(*REPORT)
    )


def fan_out_report(
    facts: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
    as_of: dt.date,
    region: str,
    channel: str,
) -> DataFrame:
    """The result of joining every sale to every price and discount in force, without those joined rows.

    In that join each sale appears once per (price, discount) of its sku, and skus without a price or a
    discount fall out. The sums are therefore the plain sums times both numbers of matches.
    """
    prices = (
        _in_force(facts["fact_price_history"], "effective_start", "effective_end", as_of, region, channel)
        .groupBy("sku")
        .agg(F.max("price").alias("current_price"), F.count("*").alias("n_prices"))
    )
    discounts = (
        _in_force(facts["fact_discount_events"], "start_date", "end_date", as_of, region, channel)
        .groupBy("sku")
        .agg(F.max("discount_value").alias("active_discount_value"), F.count("*").alias("n_discounts"))
    )
    matches = F.col("n_prices") * F.col("n_discounts")
    return (
        sales_by_sku(facts["fact_sales"], first, last, region, channel)
        .join(prices, "sku")
        .join(discounts, "sku")
        .join(dims["dim_product"].select("sku"), "sku", "left_semi")
        .select(
            "sku",
            (F.col("total_qty") * matches).alias("total_qty"),
            (F.col("total_sales") * matches).cast("decimal(38,2)").alias("total_sales"),
            "current_price",
            "active_discount_value",
        )
    )


def verify_rewrite(naive: DataFrame, tuned: DataFrame) -> DataFrame:
    """PASS only if both forms return the same rows. Each is computed once, into a scratch table."""
    return diff_summary(written(naive, "naive"), written(tuned, "tuned"))


def rewrite_samples(naive: DataFrame, tuned: DataFrame, n: int = 5) -> DataFrame:
    """Up to n differing rows per side."""
    diff = row_differences(naive, tuned)
    side = lambda name: diff.filter(F.col("only_in") == name).orderBy("sku", "total_qty").limit(n)
    return side("left").unionByName(side("right"))
