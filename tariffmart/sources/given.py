"""Staging tables and dimensions derived from the given order tables (rules in FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmart.functions.expressions import moment, sales_file_name
from tariffmart.schemas import KEY
from tariffmart.sources.tables import as_table

# Fixed values of the derivation.
AS_OF = dt.date(2001, 8, 1)
LOADED_AT = dt.datetime(2001, 8, 1)
SECOND_LOAD_AT = dt.datetime(2001, 8, 2)
PRELOADED_BEFORE = dt.date(2000, 1, 1)
FAMILY = 10  # parts of one sku
UNKNOWN = 19  # of twenty families, the one that no product describes


def _read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def family_sku(partkey: str) -> Column:
    """The sku of a part: one for each family of parts with neighbouring keys."""
    return F.concat(F.lit("SKU-"), (F.floor(F.col(partkey) / FAMILY) + 10000).cast("string"))


def families(part: DataFrame) -> DataFrame:
    """One row per family over all parts, with the attributes of its least part key."""
    attributes = F.min(F.struct("p_partkey", "p_name", "p_type", "p_brand", "p_size")).alias("p")
    return part.groupBy(F.floor(F.col("p_partkey") / FAMILY).alias("family")).agg(attributes).select("family", "p.*")


def dimensions(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    part = families(_read(spark, directory, "part")).filter(F.col("family") % 20 != UNKNOWN)
    region = _read(spark, directory, "region")
    customer = _read(spark, directory, "customer")
    return {
        "dim_product": part.select(
            family_sku("p_partkey").alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            (F.col("p_size") <= 45).alias("is_active"),
            moment(LOADED_AT).alias("created_at"),
        ),
        "dim_region": region.select(
            F.upper(F.substring("r_name", 1, 2)).alias("region_code"), F.col("r_name").alias("region_name")
        ).distinct(),
        "dim_channel": customer.select(
            F.substring("c_mktsegment", 1, 4).alias("channel_code"), F.col("c_mktsegment").alias("channel_name")
        ).distinct(),
    }


def order_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines with their key. The small side of each join is built first; lines move once, and the text of their
    key is made afterwards."""
    places = _read(spark, directory, "nation").join(
        _read(spark, directory, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = _read(spark, directory, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = (
        _read(spark, directory, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.upper(F.substring("r_name", 1, 2)).alias("region_code"),
            F.substring("c_mktsegment", 1, 4).alias("channel_code"),
        )
    )
    # Some lines are staged twice: the copy is made in place instead of by a second scan.
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("l_orderkey") % 53 == 0, 2).otherwise(1))).alias("copy")
    lines = _read(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        "l_partkey",
    )
    copied = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("*", copies)
    return copied.withColumn("sku", family_sku("l_partkey")).drop("o_orderkey", "l_partkey", "copy")


def staged_sales(lines: DataFrame) -> DataFrame:
    sales = lines.select(
        F.col("order_date").alias("sale_date"),
        *KEY,
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("net_sales"),
    )
    return as_table(
        sales.select("*", sales_file_name("sale_date").alias("source_file"), moment(LOADED_AT).alias("loaded_at")),
        "stg_sales",
    )


def staged_prices(lines: DataFrame) -> DataFrame:
    odd = F.col("l_linenumber") % 2 == 1
    price = F.col("l_extendedprice").cast("decimal(18,4)")
    sku = (
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None))
        .when(F.col("l_orderkey") % 103 == 0, F.lit("  "))
        .otherwise(F.col("sku"))
    )
    return as_table(
        lines.select(
            sku.alias("sku"),
            "region_code",
            "channel_code",
            F.when(F.col("l_orderkey") % 97 == 0, -price).otherwise(price).alias("price"),
            F.lit("USD").alias("currency"),
            F.col("order_date").alias("effective_start"),
            F.when(odd, F.date_add("order_date", 30)).alias("effective_end"),
            F.when(odd, "PRICING_SYS").otherwise("LATE_LOAD_SYS").alias("source_system"),
            moment(LOADED_AT).alias("loaded_at"),
        ),
        "stg_price_history",
    )


def staged_discounts(lines: DataFrame) -> DataFrame:
    flat = (F.col("l_returnflag") == "R") | (F.col("l_discount") == 0)
    return as_table(
        lines.select(
            *KEY,
            F.when(flat, "FLAT").otherwise("PERCENT").alias("discount_type"),
            F.when(flat, F.col("l_quantity") * 10).otherwise(F.col("l_discount") * 100).cast("decimal(18,4)").alias("discount_value"),
            F.col("ship_date").alias("start_date"),
            F.date_add("ship_date", (F.col("l_suppkey") % 15 + 7).cast("int")).alias("end_date"),
            moment(LOADED_AT).alias("loaded_at"),
        ),
        "stg_discount_events",
    )
