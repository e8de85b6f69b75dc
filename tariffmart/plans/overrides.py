"""The override demonstration: the same open price changed by the load and by hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.operators.overrides import price_overrides
from tariffmart.plans.lookups import open_prices
from tariffmart.schemas import PRIMARY_KEYS, SCHEMAS
from tariffmart.operators.surrogate import highest_id, with_surrogate_key
from tariffmart.sources.tables import as_table


def raise_first_open_price(prices: DataFrame, by: str) -> DataFrame:
    """The price history with the open row of the smallest id raised."""
    first_id = open_prices(prices).agg(F.min("price_hist_id")).scalar()
    raised = (F.col("price") + F.lit(by).cast("decimal(18,4)")).cast("decimal(18,4)")
    new = F.when(F.col("price_hist_id") == first_id, raised).otherwise(F.col("price"))
    return prices.withColumn("price", new)


def override_demo(prices: DataFrame, changed_by: str, changed_at: dt.datetime) -> DataFrame:
    """Raise a price once under the load's flag (not logged) and once by hand (logged)."""
    by_load = raise_first_open_price(prices, "1.00")
    by_hand = raise_first_open_price(by_load, "5.50")
    quiet = price_overrides(prices, by_load, changed_by, changed_at, is_etl=True)
    logged = price_overrides(by_load, by_hand, changed_by, changed_at)
    return quiet.unionByName(logged)


def append_to_audit(audit: DataFrame, overrides: DataFrame) -> DataFrame:
    """The audit log with new entries numbered after the last one, in the order of the price ids."""
    id_column = PRIMARY_KEYS["price_override_audit"]
    numbered = with_surrogate_key(overrides, id_column, ["price_hist_id"], highest_id(audit, id_column))
    return audit.unionByName(as_table(numbered, "price_override_audit"))


def audit_tail(audit: DataFrame, n: int = 5) -> DataFrame:
    """The last n audit entries, newest first."""
    return audit.orderBy(F.col("audit_id").desc()).limit(n).select(*SCHEMAS["price_override_audit"].names)
