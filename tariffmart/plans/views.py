"""The serving views: daily sales, active discounts, best price and discount per day, the BI grid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import as_date, day, end_or_open
from tariffmart.operators.intervals import active_on, best_per_day, overlaps
from tariffmart.operators.top import largest_discount_first, latest_price_first
from tariffmart.schemas import KEY
from tariffmart.sources.inline import last_days

DAY_KEY = ["as_of_date", *KEY]
# Prices and discounts in the order in which they count.
PRICE_RANK = "struct<effective_start: date, created_at: timestamp, price_hist_id: bigint, price: decimal(18,4), currency: string>"
DISCOUNT_RANK = "struct<discount_value: decimal(18,4), older: int, earlier: bigint, discount_type: string>"


def sales_daily(sales: DataFrame) -> DataFrame:
    """Quantity and net sales per day and key."""
    return sales.groupBy("sale_date", *KEY).agg(
        F.sum("qty").alias("daily_sales_qty"), F.sum("net_sales").alias("daily_net_sales")
    )


def discount_active(discounts: DataFrame, as_of: dt.date) -> DataFrame:
    """Discounts that hold on the day."""
    return discounts.filter(active_on("start_date", "end_date", as_of)).select(
        *KEY, "discount_type", "discount_value", "start_date", "end_date"
    )


def price_as_of_daily(prices: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The price in force for each day of [first, last] and key."""
    rows = prices.select("price_hist_id", *KEY, "price", "currency", "effective_start", "effective_end", "created_at")
    best = best_per_day(rows, "effective_start", "effective_end", first, last, latest_price_first())
    return best.select(*DAY_KEY, F.col("price").alias("current_price"), "currency")


def discount_as_of_daily(discounts: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The largest discount in force for each day of [first, last] and key."""
    rows = discounts.select("discount_event_id", *KEY, "discount_type", "discount_value", "start_date", "end_date")
    best = best_per_day(rows, "start_date", "end_date", first, last, largest_discount_first())
    return best.select(
        *DAY_KEY,
        F.col("discount_type").alias("active_discount_type"),
        F.col("discount_value").alias("active_discount_value"),
    )


def recent_activity_keys(facts: dict[str, DataFrame], as_of: dt.date, days: int = 60) -> DataFrame:
    """Keys with a sale, price or discount in the last ``days`` days, reaching one day further back than a
    calendar of as many days. One distinct over the union; its partial step removes copies on the map side."""
    low = as_of - dt.timedelta(days=days)
    sold = facts["fact_sales"].filter(F.col("sale_date") >= day(low)).select(*KEY)
    priced = facts["fact_price_history"].filter(overlaps("effective_start", "effective_end", low, as_of)).select(*KEY)
    discounted = facts["fact_discount_events"].filter(overlaps("start_date", "end_date", low, as_of)).select(*KEY)
    return sold.unionByName(priced).unionByName(discounted).distinct()


def enrich_keys(keys: DataFrame, dims: dict[str, DataFrame], active_only: bool = True) -> DataFrame:
    """Keys with the attributes of their dimensions; unknown members and inactive products drop out."""
    products = dims["dim_product"]
    if active_only:
        products = products.filter("is_active")
    return (
        keys.join(products.select("sku", "product_name", "category", "brand"), "sku")
        .join(dims["dim_region"].select("region_code", "region_name"), "region_code")
        .join(dims["dim_channel"].select("channel_code", "channel_name"), "channel_code")
    )


def _events(facts: dict[str, DataFrame], low: dt.date, last: dt.date) -> DataFrame:
    """Sales, prices and discounts that touch [low, last] in one shape: key, first and last day, and what they bring.

    A price or discount that ends before it starts brings nothing but its key's activity.
    """

    def shaped(rows: DataFrame, start: Column, end: Column, **brought: Column) -> DataFrame:
        first, until = F.greatest(start, day(low)), F.least(end, day(last))
        kinds = {"qty": "bigint", "net": "decimal(28,2)", "price": PRICE_RANK, "discount": DISCOUNT_RANK}
        given = [brought.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]
        return rows.select(*KEY, first.alias("first"), until.alias("until"), *given)

    sales = facts["fact_sales"].filter(F.col("sale_date").between(day(low), day(last)))
    prices = facts["fact_price_history"].filter(overlaps("effective_start", "effective_end", low, last))
    discounts = facts["fact_discount_events"].filter(overlaps("start_date", "end_date", low, last))
    sold = shaped(sales, F.col("sale_date"), F.col("sale_date"), qty=F.col("qty"), net=F.col("net_sales"))
    ended = end_or_open("effective_end")
    # the greatest of these is the price or discount that counts; what it shows comes last
    price = F.when(F.col("effective_start") <= ended, F.struct("effective_start", "created_at", "price_hist_id", "price", "currency"))
    older = F.datediff(F.lit("0001-01-01").cast("date"), "start_date")
    discount = F.when(
        F.col("start_date") <= F.col("end_date"), F.struct("discount_value", older, -F.col("discount_event_id"), "discount_type")
    )
    return sold.unionByName(shaped(prices, F.col("effective_start"), ended, price=price)).unionByName(
        shaped(discounts, F.col("start_date"), F.col("end_date"), discount=discount)
    )


def pricing_bi_dataset(
    facts: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    as_of: dt.date,
    days: int = 60,
    on: dt.date | str | None = None,
    region: str | None = None,
    channel: str | None = None,
) -> DataFrame:
    """The dense grid of the last ``days`` days and all recently active keys, with price, discount and sales.

    ``on``, ``region`` and ``channel`` restrict every branch before it is expanded: Catalyst does not push a
    filter below the day expansion by itself. Facts of all kinds meet as events of a key and a stretch of days. They
    move twice: once reduced to one row for each key and stretch, which the map side does first however many rows a key
    has, then by key as one list, which the pairs of days of the calendar bound. The key is unrolled into days after
    its attributes are joined, and each day picks from that list, so nothing moves for the grid itself.
    """
    low, last = as_of - dt.timedelta(days=days), as_of
    if region is not None or channel is not None:
        facts = {name: _restricted(fact, region, channel) for name, fact in facts.items()}
    calendar = last_days(as_of, days)
    if on is not None:
        wanted = as_date(on)
        calendar = F.filter(calendar, lambda d: d == day(wanted))
    stretches = _events(facts, low, last).groupBy(*KEY, "first", "until").agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("net"), F.max("price").alias("price"), F.max("discount").alias("discount")
    )
    event = F.struct("first", "until", "qty", "net", "price", "discount")
    keys = enrich_keys(stretches.groupBy(*KEY).agg(F.collect_list(event).alias("events")), dims)
    return daily_rows(keys.withColumn("as_of_date", F.explode(calendar)))


def daily_rows(keys: DataFrame) -> DataFrame:
    """The rows of the grid from keys with their attributes, ``as_of_date`` and ``events``."""
    today = F.filter("events", lambda e: (e["first"] <= F.col("as_of_date")) & (F.col("as_of_date") <= e["until"]))
    picked = keys.withColumn("today", today).select(
        "*",
        F.array_max(F.transform("today", lambda e: e["price"])).alias("p"),
        F.array_max(F.transform("today", lambda e: e["discount"])).alias("x"),
        F.aggregate("today", F.lit(0).cast("long"), lambda n, e: n + F.coalesce(e["qty"], F.lit(0))).alias("daily_sales_qty"),
        F.aggregate("today", F.lit(0).cast("decimal(28,2)"), lambda n, e: (n + F.coalesce(e["net"], F.lit(0))).cast("decimal(28,2)")).alias("daily_net_sales"),
    )
    return picked.select(
        "as_of_date",
        "sku",
        "product_name",
        "category",
        "brand",
        "region_code",
        "region_name",
        "channel_code",
        "channel_name",
        F.coalesce("p.price", F.lit(0).cast("decimal(18,4)")).alias("current_price"),
        F.coalesce("p.currency", F.lit("USD")).alias("currency"),
        F.col("x.discount_type").alias("active_discount_type"),
        F.col("x.discount_value").alias("active_discount_value"),
        "daily_sales_qty",
        "daily_net_sales",
        F.when(F.col("p.price").isNull(), 1).otherwise(0).alias("dq_missing_price_flag"),
    )


def _restricted(fact: DataFrame, region: str | None, channel: str | None) -> DataFrame:
    if region is not None:
        fact = fact.filter(F.col("region_code") == region)
    if channel is not None:
        fact = fact.filter(F.col("channel_code") == channel)
    return fact
