"""The refresh: staged rows become facts, then price ranges are repaired."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import moment
from tariffmart.operators.dedup import beside_stored, distinct_rows, of_staged_months, unstored_in_place, unstored_prices
from tariffmart.operators.repair import range_changes, repair_ranges
from tariffmart.operators.surrogate import highest_id, with_surrogate_key
from tariffmart.operators.validate import (
    broken_rules,
    known_sku,
    load_profile,
    price_row_rules,
    rejected_price_count,
    required_not_null,
)
from tariffmart.schemas import CONTRACTS, DISCOUNT_COLUMNS, ID_ORDER, KEY, PRICE_COLUMNS, PRIMARY_KEYS, SALE_COLUMNS
from tariffmart.sources.tables import as_table

FACTS = ["fact_sales", "fact_discount_events", "fact_price_history"]
STAGING = ["stg_sales", "stg_discount_events", "stg_price_history"]


class LoadRejected(Exception):
    """New rows break a constraint of their table; nothing of the run may be published."""


@dataclass
class Load:
    """Numbered new rows, the price rows that are new or get another end, and the number of rejected staged prices."""

    new_rows: dict[str, DataFrame]
    changed_prices: DataFrame | None
    rows_rejected: int


def _numbered(rows: DataFrame, table: str, loaded_at: dt.datetime, after: int) -> DataFrame:
    """New rows with ids after the highest one, in the order of all business columns, NULL first. Of rows ``beside_stored``
    these are the ones without an equal fact, each once."""
    order = [F.col(c).asc_nulls_first() for c in ID_ORDER[table]]
    unstored = partial(unstored_in_place, columns=ID_ORDER[table]) if "_of" in rows.columns else None
    rows = with_surrogate_key(rows, PRIMARY_KEYS[table], order, after, in_range=unstored)
    return as_table(rows.withColumn("created_at", moment(loaded_at)), table)


def _last_id(facts: DataFrame, table: str, after: int | None) -> int:
    """A store knows its highest id; without ``after`` it is looked up in the facts."""
    return highest_id(facts, PRIMARY_KEYS[table]) if after is None else after


def refresh_sales(staged: DataFrame, facts: DataFrame, loaded_at: dt.datetime, after: int | None = None) -> DataFrame:
    """Rows to append to the sales facts. Facts of other months than the staged ones may be left out."""
    ready = required_not_null(staged, ["sale_date", *KEY])
    last = _last_id(facts, "fact_sales", after)
    return _numbered(beside_stored(ready, facts if last else None, SALE_COLUMNS), "fact_sales", loaded_at, last)


def refresh_discounts(staged: DataFrame, facts: DataFrame, loaded_at: dt.datetime, after: int | None = None) -> DataFrame:
    """Rows to append to the discount facts. Facts of other months than the staged ones may be left out."""
    ready = required_not_null(staged, [*KEY, "start_date", "end_date"])
    last = _last_id(facts, "fact_discount_events", after)
    return _numbered(beside_stored(ready, facts if last else None, DISCOUNT_COLUMNS), "fact_discount_events", loaded_at, last)


def append_prices(
    staged: DataFrame,
    facts: DataFrame,
    dim_product: DataFrame,
    loaded_at: dt.datetime,
    idempotent: bool = False,
    after: int | None = None,
) -> DataFrame:
    """Rows to append to the price facts, before repair. Facts of keys that are not staged may be left out."""
    last = _last_id(facts, "fact_price_history", after)
    valid = staged.filter(price_row_rules())
    if not last:
        return _numbered(beside_stored(known_sku(valid, dim_product), None, PRICE_COLUMNS), "fact_price_history", loaded_at, last)
    fresh = unstored_prices(known_sku(distinct_rows(valid, PRICE_COLUMNS), dim_product), facts, match_end=not idempotent)
    return _numbered(fresh, "fact_price_history", loaded_at, last)


def refresh_prices(
    staged: DataFrame, facts: DataFrame, dim_product: DataFrame, loaded_at: dt.datetime, idempotent: bool = False
) -> DataFrame:
    """All price facts after the new rows are appended and every range is repaired."""
    return repair_ranges(facts.unionByName(append_prices(staged, facts, dim_product, loaded_at, idempotent)))


def check_load(new_rows: dict[str, DataFrame], dims: dict[str, DataFrame]) -> dict[str, int]:
    """Raise if new rows miss a required value, exceed a length or point to no dimension row; else their numbers.

    All rules of all tables run as one job over the written rows; what returns is one row per table.
    """
    profiles = load_profile(new_rows, CONTRACTS, dims).collect()
    broken = [problem for row in profiles for problem in broken_rules(row, CONTRACTS[row.table_name])]
    if broken:
        raise LoadRejected("; ".join(sorted(broken)))
    return {table: 0 for table in new_rows} | {row.table_name: row.n for row in profiles}


def load_staging(
    staging: dict[str, DataFrame],
    facts: dict[str, DataFrame],
    products: DataFrame,
    loaded_at: dt.datetime,
    last_ids: dict[str, int],
    idempotent: bool = False,
) -> Load:
    """Number and write the new rows of all facts. Checks, repair and publication then read those written rows.

    ``facts`` holds what the staged rows can meet: their months of sales and discounts, their keys of prices. A stored
    price equals a staged one only if it starts in the same month. Stored prices are a fixed point of the repair, so only
    keys with new rows can change. The tables do not depend on each
    other, so their jobs are submitted together. Tables that ``staging`` leaves out get nothing.
    """
    fresh = {
        "fact_sales": lambda rows, known, after: refresh_sales(rows, known, loaded_at, after),
        "fact_discount_events": lambda rows, known, after: refresh_discounts(rows, known, loaded_at, after),
        "fact_price_history": lambda rows, known, after: append_prices(rows, known, products, loaded_at, idempotent, after),
    }
    prices = staging.get("stg_price_history")
    met = dict(facts)
    if prices is not None and last_ids["fact_price_history"]:
        met["fact_price_history"] = of_staged_months(facts["fact_price_history"], prices, "effective_start")
    with ThreadPoolExecutor(max_workers=4) as jobs:
        rejected = jobs.submit(lambda: rejected_price_count(prices, products).first()[0] if prices is not None else 0)
        loads = {
            table: jobs.submit(fresh[table], staging[stage], met[table], last_ids[table])
            for stage, table in zip(STAGING, FACTS, strict=True)
            if stage in staging
        }
        new_rows = {table: load.result() for table, load in loads.items()}
        changed = None
        if prices is not None:
            stored, added = facts["fact_price_history"], new_rows["fact_price_history"]
            touched = stored.join(added.select(*KEY).distinct(), KEY, "left_semi").select(*stored.columns)
            changed = range_changes(touched.unionByName(added), F.col("price_hist_id") > last_ids["fact_price_history"])
        return Load(new_rows, changed, rejected.result())
