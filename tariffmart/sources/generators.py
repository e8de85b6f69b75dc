"""Synthetic staging data. Random draws are hashes of a row's identity, so a lost task regenerates the
same rows, and rows are made where they are, without a loop."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import day, draw, moment, pick, sales_file_name, sku_label
from tariffmart.schemas import KEY, PRICE_COLUMNS, SALE_COLUMNS
from tariffmart.sources import seed_values
from tariffmart.sources.inline import bad_sku_prices, overlapping_discounts

REGION_CODES = [code for code, _ in seed_values.REGIONS]
CHANNEL_CODES = [code for code, _ in seed_values.CHANNELS]
SKU_COUNT = len(seed_values.PRODUCTS)
MOST_CODES = 1000


def _price(label: str, scale: int, *seeds: str | Column) -> Column:
    """10.00 to 509.99."""
    return ((draw(label, 50000, *seeds) + 1000).cast("decimal(18,0)") / 100).cast(f"decimal(18,{scale})")


def generate_sales(ids: DataFrame, as_of: dt.date, loaded_at: dt.datetime, sku_count: int = SKU_COUNT) -> DataFrame:
    """One staged sale per row of ``ids`` (column ``id``): within 61 days, any sku, region and channel."""
    rows = ids.select(
        "id",
        F.date_add(F.date_sub(day(as_of), 60), draw("date", 61, "id").cast("int")).alias("sale_date"),
        sku_label(draw("sku", sku_count, "id") + 1).alias("sku"),
        pick(REGION_CODES, draw("region", len(REGION_CODES), "id")).alias("region_code"),
        pick(CHANNEL_CODES, draw("channel", len(CHANNEL_CODES), "id")).alias("channel_code"),
        (draw("qty", 100, "id") + 1).cast("int").alias("qty"),
        _price("price", 2, "id").alias("unit_price"),
    )
    return rows.withColumn("net_sales", (F.col("qty") * F.col("unit_price")).cast("decimal(18,2)")).select(
        *SALE_COLUMNS, sales_file_name("sale_date").alias("source_file"), moment(loaded_at).alias("loaded_at")
    )


def generate_price_history(keys: DataFrame, as_of: dt.date, loaded_at: dt.datetime) -> DataFrame:
    """One to four consecutive price ranges for every key, the last one open.

    The first starts 90 to 61 days back; each closed one ends 1 to 30 days after its start. A range's
    start is the first start plus the lengths before it, so a key's rows come from one row without a window.
    """
    lengths = F.array(*[(draw(f"length{i}", 30, *KEY) + 1).cast("int") for i in range(3)])
    begun = keys.select(
        *KEY,
        (draw("ranges", 4, *KEY) + 1).cast("int").alias("ranges"),
        F.date_add(F.date_sub(day(as_of), 90), draw("first", 30, *KEY).cast("int")).alias("first_start"),
        lengths.alias("lengths"),
    )
    rows = begun.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("ranges"))))
    days_before = F.expr("aggregate(slice(lengths, 1, i - 1), 0, (total, days) -> total + days + 1)")
    rows = rows.withColumn("effective_start", F.date_add("first_start", days_before))
    end = F.when(F.col("i") < F.col("ranges"), F.date_add("effective_start", F.expr("try_element_at(lengths, i)")))
    return rows.select(
        *KEY,
        _price("price", 4, *KEY, F.col("i").cast("string")).alias("price"),
        F.lit("USD").alias("currency"),
        "effective_start",
        end.alias("effective_end"),
        F.lit("PRICING_SYS").alias("source_system"),
        moment(loaded_at).alias("loaded_at"),
    )


def generate_discounts(ids: DataFrame, as_of: dt.date, loaded_at: dt.datetime, sku_count: int = SKU_COUNT) -> DataFrame:
    """One staged discount per row of ``ids``: skus in turn, PERCENT 5..54 or FLAT 10..1009, 7 to 21 days."""
    rows = ids.select(
        "id",
        sku_label((F.col("id") - 1) % sku_count + 1).alias("sku"),
        pick(REGION_CODES, draw("region", len(REGION_CODES), "id")).alias("region_code"),
        pick(CHANNEL_CODES, draw("channel", len(CHANNEL_CODES), "id")).alias("channel_code"),
        pick(["PERCENT", "FLAT"], draw("type", 2, "id")).alias("discount_type"),
        F.date_add(F.date_sub(day(as_of), 30), draw("start", 30, "id").cast("int")).alias("start_date"),
    )
    value = F.when(F.col("discount_type") == "PERCENT", draw("percent", 50, "id") + 5).otherwise(
        draw("flat", 1000, "id") + 10
    )
    return rows.select(
        *KEY,
        "discount_type",
        value.cast("decimal(18,4)").alias("discount_value"),
        "start_date",
        F.date_add("start_date", (draw("length", 15, "id") + 7).cast("int")).alias("end_date"),
        moment(loaded_at).alias("loaded_at"),
    )


def random_rows(df: DataFrame, n: int, seeds: list[str], label: str = "sample") -> DataFrame:
    """n rows in an order that depends on the seed columns only: repeatable, and a bounded top-n per task."""
    text = F.concat_ws("|", F.lit(label), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in seeds])
    return df.orderBy(F.md5(text), *seeds).limit(n)


def shuffled_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n rows in random order."""
    return df.orderBy(F.rand(seed)).limit(n)


def bad_prices(staged: DataFrame, as_of: dt.date, loaded_at: dt.datetime) -> DataFrame:
    """Rows to add to the staged prices: 10 negated copies, bad skus, and 5 late arrivals."""
    spark = staged.sparkSession
    negated = random_rows(staged, 10, PRICE_COLUMNS, "negate").withColumn("price", (-F.abs("price")).cast("decimal(18,4)"))
    late = random_rows(staged, 5, PRICE_COLUMNS, "late").select(
        sku_label(draw("late_sku", SKU_COUNT, "region_code", "channel_code", F.col("effective_start").cast("string")) + 1).alias("sku"),
        "region_code",
        "channel_code",
        _price("late_price", 4, "region_code", "channel_code", F.col("effective_start").cast("string")).alias("price"),
        F.lit("USD").alias("currency"),
        F.date_sub(day(as_of), 45).alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"),
        F.lit("LATE_LOAD_SYS").alias("source_system"),
        moment(loaded_at).alias("loaded_at"),
    )
    return (
        negated.withColumn("loaded_at", moment(loaded_at))
        .unionByName(bad_sku_prices(spark, as_of - dt.timedelta(days=90), loaded_at))
        .unionByName(late)
    )


def bad_discounts(staged: DataFrame, as_of: dt.date, loaded_at: dt.datetime) -> DataFrame:
    """Rows to add to the staged discounts: five on one key that overlap each other."""
    return overlapping_discounts(staged.sparkSession, as_of - dt.timedelta(days=20), loaded_at)


def late_rows(keys: DataFrame, as_of: dt.date, loaded_at: dt.datetime, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """A late price (35 days) and a late sale (32 days) for each of n keys: (prices, sales)."""
    chosen = random_rows(keys.select(*KEY), n, KEY, "late_key")
    prices = chosen.select(
        *KEY,
        F.lit("99.99").cast("decimal(18,4)").alias("price"),
        F.lit("USD").alias("currency"),
        F.date_sub(day(as_of), 35).alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"),
        F.lit("LATE_LOAD_SYS").alias("source_system"),
        moment(loaded_at).alias("loaded_at"),
    )
    sales = chosen.select(
        F.date_sub(day(as_of), 32).alias("sale_date"),
        *KEY,
        F.lit(10).alias("qty"),
        F.lit("999.90").cast("decimal(18,2)").alias("net_sales"),
        sales_file_name(F.date_sub(day(as_of), 32)).alias("source_file"),
        moment(loaded_at).alias("loaded_at"),
    )
    return prices, sales


def _codes(dimension: DataFrame, code: str) -> Column:
    """The codes of a short dimension as one array; the limit keeps a long one from being gathered first."""
    codes = dimension.select(code).limit(MOST_CODES + 1).agg(F.collect_list(code).alias("codes"))
    short = F.assert_true(F.size("codes") <= MOST_CODES, F.lit(f"more than {MOST_CODES} values of {code}"))
    return codes.select(F.when(short.isNull(), F.col("codes"))).scalar()


def key_universe(dims: dict[str, DataFrame], active_only: bool = True) -> DataFrame:
    """Every product, region and channel combined.

    Regions and channels reach each product row as arrays and are unrolled in place: the products stay
    where they are, and a row holds no more than the rows it turns into. Both dimensions are short lists of
    codes; more than ``MOST_CODES`` of either raise an error, since each product row carries them all.
    """
    products = dims["dim_product"].filter("is_active") if active_only else dims["dim_product"]
    regions, channels = _codes(dims["dim_region"], "region_code"), _codes(dims["dim_channel"], "channel_code")
    return (
        products.select("sku", F.explode(regions).alias("region_code"))
        .select("sku", "region_code", F.explode(channels).alias("channel_code"))
    )
