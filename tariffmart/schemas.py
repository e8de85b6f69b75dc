"""Schemas, keys and constraints of the mart tables.

Parquet keeps neither widths, identities nor foreign keys, so they are stated here as data and checked
by ``operators.contract``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEY = ["sku", "region_code", "channel_code"]

SALE_COLUMNS = ["sale_date", *KEY, "qty", "net_sales"]
PRICE_COLUMNS = [*KEY, "price", "currency", "effective_start", "effective_end", "source_system"]
DISCOUNT_COLUMNS = [*KEY, "discount_type", "discount_value", "start_date", "end_date"]

# Total order of new rows for their ids; NULL sorts first. Files written in it are clustered the same way:
# sales by date, prices and discounts by key.
ID_ORDER = {
    "fact_sales": SALE_COLUMNS,
    "fact_price_history": [*KEY, "effective_start", "effective_end", "price", "currency", "source_system"],
    "fact_discount_events": [*KEY, "start_date", "end_date", "discount_type", "discount_value"],
}

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 4)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_KEY_FIELDS = [(name, T.StringType()) for name in KEY]

SCHEMAS: dict[str, T.StructType] = {
    "dim_product": _struct(
        ("sku", T.StringType()),
        ("product_name", T.StringType()),
        ("category", T.StringType()),
        ("brand", T.StringType()),
        ("is_active", T.BooleanType()),
        ("created_at", T.TimestampType()),
    ),
    "dim_region": _struct(("region_code", T.StringType()), ("region_name", T.StringType())),
    "dim_channel": _struct(("channel_code", T.StringType()), ("channel_name", T.StringType())),
    "dim_pricing_rule": _struct(
        ("rule_id", T.IntegerType()),
        ("rule_name", T.StringType()),
        ("rule_type", T.StringType()),
        ("priority", T.IntegerType()),
        ("start_date", T.DateType()),
        ("end_date", T.DateType()),
        ("is_active", T.BooleanType()),
    ),
    "fact_sales": _struct(
        ("sale_id", T.LongType()),
        ("sale_date", T.DateType()),
        *_KEY_FIELDS,
        ("qty", T.IntegerType()),
        ("net_sales", MONEY),
        ("created_at", T.TimestampType()),
    ),
    "fact_price_history": _struct(
        ("price_hist_id", T.LongType()),
        *_KEY_FIELDS,
        ("price", RATE),
        ("currency", T.StringType()),
        ("effective_start", T.DateType()),
        ("effective_end", T.DateType()),
        ("source_system", T.StringType()),
        ("created_at", T.TimestampType()),
    ),
    "fact_discount_events": _struct(
        ("discount_event_id", T.LongType()),
        *_KEY_FIELDS,
        ("discount_type", T.StringType()),
        ("discount_value", RATE),
        ("start_date", T.DateType()),
        ("end_date", T.DateType()),
        ("created_at", T.TimestampType()),
    ),
    "fact_margin_impact": _struct(
        ("impact_id", T.LongType()),
        *_KEY_FIELDS,
        ("as_of_date", T.DateType()),
        ("price", RATE),
        ("unit_cost", RATE),
        ("margin_pct", T.DecimalType(9, 4)),
        ("created_at", T.TimestampType()),
    ),
    "etl_run_history": _struct(
        ("run_id", T.LongType()),
        ("pipeline_name", T.StringType()),
        ("started_at", T.TimestampType()),
        ("finished_at", T.TimestampType()),
        ("status", T.StringType()),
        ("rows_loaded", T.LongType()),
        ("rows_rejected", T.LongType()),
        ("failure_reason", T.StringType()),
    ),
    "price_override_audit": _struct(
        ("audit_id", T.LongType()),
        *_KEY_FIELDS,
        ("old_price", RATE),
        ("new_price", RATE),
        ("changed_by", T.StringType()),
        ("changed_at", T.TimestampType()),
        ("reason", T.StringType()),
    ),
    "stg_sales": _struct(
        ("sale_date", T.DateType()),
        *_KEY_FIELDS,
        ("qty", T.IntegerType()),
        ("net_sales", MONEY),
        ("source_file", T.StringType()),
        ("loaded_at", T.TimestampType()),
    ),
    "stg_price_history": _struct(
        *_KEY_FIELDS,
        ("price", RATE),
        ("currency", T.StringType()),
        ("effective_start", T.DateType()),
        ("effective_end", T.DateType()),
        ("source_system", T.StringType()),
        ("loaded_at", T.TimestampType()),
    ),
    "stg_discount_events": _struct(
        *_KEY_FIELDS,
        ("discount_type", T.StringType()),
        ("discount_value", RATE),
        ("start_date", T.DateType()),
        ("end_date", T.DateType()),
        ("loaded_at", T.TimestampType()),
    ),
}

PRIMARY_KEYS: dict[str, str] = {
    "dim_product": "sku",
    "dim_region": "region_code",
    "dim_channel": "channel_code",
    "dim_pricing_rule": "rule_id",
    "fact_sales": "sale_id",
    "fact_price_history": "price_hist_id",
    "fact_discount_events": "discount_event_id",
    "fact_margin_impact": "impact_id",
    "etl_run_history": "run_id",
    "price_override_audit": "audit_id",
}

DIMENSION_OF: dict[str, str] = {
    "sku": "dim_product",
    "region_code": "dim_region",
    "channel_code": "dim_channel",
}


@dataclass(frozen=True)
class Contract:
    """What a fact demands of the rows loaded into it."""

    required: list[str]
    max_length: dict[str, int] = field(default_factory=dict)


_KEY_WIDTHS = {"sku": 255, "region_code": 10, "channel_code": 10}

CONTRACTS: dict[str, Contract] = {
    "fact_sales": Contract(required=SALE_COLUMNS, max_length=_KEY_WIDTHS),
    "fact_price_history": Contract(
        required=[*KEY, "price", "currency", "effective_start"],
        max_length={**_KEY_WIDTHS, "currency": 3, "source_system": 100},
    ),
    "fact_discount_events": Contract(
        required=[*KEY, "discount_value", "start_date", "end_date"],
        max_length={**_KEY_WIDTHS, "discount_type": 100},
    ),
}
