"""Arrivals loaded as they come against one load of everything."""

from __future__ import annotations

import pytest
from conftest import T0

from tariffmart.operators.merge import diff_summary
from tariffmart.plans.store import MartStore
from tariffmart.session import scratch_path
from tariffmart.sources.tables import append_rows
from tariffmart.streaming import arrivals as ar
from tariffmart.streaming.arrivals import STAGING_OF_STREAM, load_arrivals, stream_refresh

SALES = [
    [("2024-01-01", "A", 1, 1), ("2024-02-01", "B", 2, 2), ("2024-02-01", "B", 2, 2)],
    [("2024-03-01", "A", 1, 1), ("2024-01-01", "A", 1, 1)],
    [("2023-11-05", "A", 9, 9)],  # late
]
PRICES = [
    [("A", 5, "2024-01-01", None), ("A", 6, "2024-02-01", "2024-02-10"), ("B", -1, "2024-01-01", None), ("B", 3, "2024-01-05", None)],
    [("A", 7, "2024-03-01", None), ("A", 5, "2024-01-01", None)],
    [("A", 4, "2024-01-15", None), ("B", 2, "2023-12-01", "2024-06-01")],  # late
]
DISCOUNTS = [
    [("A", "FLAT", 5, "2024-01-01", "2024-01-05")],
    [("A", None, 5, "2024-01-03", "2024-01-05"), ("A", "FLAT", 5, "2024-01-01", "2024-01-05")],
    [("B", "PERCENT", 9, "2023-12-01", "2023-12-05")],
]


def test_three_arrivals_equal_one_load_and_a_restart_loads_nothing(spark, frames):
    dims = frames.dims()
    made = {"stg_sales": frames.staged_sales, "stg_price_history": frames.staged_prices, "stg_discount_events": frames.staged_discounts}
    given = {"stg_sales": SALES, "stg_price_history": PRICES, "stg_discount_events": DISCOUNTS}
    folder, checkpoint = scratch_path(spark, "arrivals-test"), scratch_path(spark, "checkpoint")
    store = MartStore(spark, scratch_path(spark, "stream-mart"))
    for turn in range(3):
        for name in STAGING_OF_STREAM:
            append_rows(made[name](*given[name][turn]).coalesce(1), f"{folder}/{name}")
        load_arrivals(store, lambda: dims, folder, checkpoint, loaded_at=T0)
    batches = store.published().runs
    assert len(batches) == 9

    whole = MartStore(spark, scratch_path(spark, "whole-mart"))
    whole.refresh({name: made[name](*sum(given[name], [])) for name in given}, dims, T0)
    for name, key in (("fact_sales", "sale_id"), ("fact_price_history", "price_hist_id"), ("fact_discount_events", "discount_event_id")):
        streamed, once = store.table(name), whole.table(name)
        assert diff_summary(streamed.drop(key), once.drop(key)).first().result == "PASS", name
        ids = sorted(r[0] for r in streamed.select(key).collect())
        assert ids == list(range(1, len(ids) + 1))

    load_arrivals(store, lambda: dims, folder, checkpoint, loaded_at=T0)  # nothing new has come
    assert store.published().runs == batches
    load_arrivals(store, lambda: dims, folder, scratch_path(spark, "forgotten"), loaded_at=T0, files_per_batch=1)
    assert diff_summary(store.table("fact_sales"), store.table("fact_sales")).first().left_rows == 4  # batches already logged
    assert store.published().runs == batches


def test_parquet_arrivals_are_read_where_they_lie(spark, frames, monkeypatch):
    """Files below folders with a blank and a column in their names."""
    folder, store = f"{scratch_path(spark, 'in place')}/a b", MartStore(spark, scratch_path(spark, "in-place-mart"))
    rows = frames.staged_prices(("A", 5, "2024-01-01", None), ("B", 6, "2024-01-01", None))
    rows.coalesce(1).write.partitionBy("sku").parquet(f"{folder}/stg_price_history")
    monkeypatch.setattr(ar, "scratch_path", lambda *_: pytest.fail("copied before it is loaded"))
    stream_refresh(store, frames.dims, folder, scratch_path(spark, "checkpoint"), "stg_price_history", T0).awaitTermination()
    assert sorted((r.sku, r.price) for r in store.table("fact_price_history").collect()) == [("A", 5), ("B", 6)]
