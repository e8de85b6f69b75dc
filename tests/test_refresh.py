from __future__ import annotations

import os
import tempfile

import pytest
from conftest import T0, T1, d
from pyspark.sql import functions as F

from tariffmart.operators import dedup, validate
from tariffmart.operators.repair import repair_ranges
from tariffmart.plans import refresh
from tariffmart.plans import store as st
from tariffmart.plans.refresh import LoadRejected
from tariffmart.plans.store import MartStore, latest_run, recent_runs
from tariffmart.schemas import ID_ORDER
from tariffmart.session import scratch_path
from tariffmart.sources.tables import append_rows, reload_staging


@pytest.fixture
def load(spark):
    """A first load into a new store."""
    return lambda staging, dims: MartStore(spark, scratch_path(spark, "load-test")).refresh(staging, dims, T0)


def test_rejects_count_raw_rows_and_ignore_null_prices(spark, frames, load):
    staged = [
        ("A", -1, "2024-01-01", None), ("A", -1, "2024-01-01", None), (None, 5, "2024-01-01", None), ("  ", 5, "2024-01-01", None),
        ("ZZZ", 5, "2024-01-01", None), ("A", 5, None, None), ("A", None, "2024-01-01", None), ("A", 5, "2024-01-01", None),
    ]
    result = load(frames.staging(prices=staged), frames.dims())
    assert (result.rows_loaded, result.rows_rejected) == (1, 6)


def test_a_row_with_two_faults_counts_once(spark, frames):
    staged = frames.staged_prices((None, -1, None, None))
    assert validate.rejected_price_count(staged, frames.dims()["dim_product"]).first()[0] == 1


def test_incomplete_sales_and_discounts_are_dropped_uncounted(spark, frames, load):
    staging = frames.staging(
        sales=[(None, "A", 1, 1), ("2024-01-01", None, 1, 1), ("2024-01-01", "A", 1, 1), ("2024-01-01", "A", 1, 1)],
        discounts=[("A", "FLAT", 1, None, "2024-01-02"), ("A", None, 1, "2024-01-01", "2024-01-02")],
    )
    result = load(staging, frames.dims())
    assert (result.rows_loaded, result.rows_rejected) == (2, 0)


@pytest.mark.parametrize(
    "staged, reason",
    [
        (dict(sales=[("2024-01-01", "ZZZ", 1, 1)]), "fact_sales.sku without dimension row: 1"),
        (dict(sales=[("2024-01-01", "A", None, 1)]), "fact_sales.qty not_null: 1"),
        (dict(prices=[("A", 1, "2024-01-01", None, None)]), "fact_price_history.currency not_null: 1"),
        (dict(prices=[("A", 1, "2024-01-01", None, "USD", None)]), "fact_price_history.region_code not_null: 1"),
        (dict(sales=[("2024-01-01", "A", 1, 1, "DISTRIBUTOR")]), "fact_sales.region_code max_length_10: 1"),
        (dict(discounts=[("A", "FLAT", None, "2024-01-01", "2024-01-02")]), "fact_discount_events.discount_value not_null: 1"),
    ],
)
def test_broken_constraints_stop_the_load(spark, frames, load, staged, reason):
    with pytest.raises(LoadRejected, match=reason):
        load(frames.staging(**staged), frames.dims())


def test_null_type_is_loaded_again(spark, frames):
    facts = frames.discounts((1, "A", None, 5, "2024-01-01", "2024-01-02"), (2, "A", "FLAT", 5, "2024-01-01", "2024-01-02"))
    staged = frames.staged_discounts(("A", None, 5, "2024-01-01", "2024-01-02"), ("A", "FLAT", 5, "2024-01-01", "2024-01-02"))
    assert [r.discount_type for r in dedup.new_discounts(staged, facts).collect()] == [None]


def test_null_currency_matches_any(spark, frames):
    facts = frames.prices((1, "A", 5, "2024-01-01", None))
    staged = frames.staged_prices(("A", 5, "2024-01-01", None, None), ("A", 5, "2024-01-01", None, "EUR"))
    assert [r.currency for r in dedup.new_prices(staged, facts).collect()] == ["EUR"]


def test_open_end_equals_open_end_only(spark, frames):
    facts = frames.prices((1, "A", 5, "2024-01-01", None))
    staged = frames.staged_prices(("A", 5, "2024-01-01", None), ("A", 5, "2024-01-01", "2024-01-09"))
    assert [r.effective_end for r in dedup.new_prices(staged, facts).collect()] == [d("2024-01-09")]


def test_reload_adds_changed_rows_again_unless_idempotent(spark, frames):
    staged = frames.staging(prices=[("A", 5, "2024-01-01", None), ("A", 6, "2024-02-01", None)])
    for idempotent, more in [(False, 1), (True, 0)]:
        mart = MartStore(spark, scratch_path(spark, "reload-test"))
        assert mart.refresh(staged, frames.dims(), T0, idempotent).rows_loaded == 2
        assert mart.refresh(staged, frames.dims(), T1, idempotent).rows_loaded == more
        assert mart.table("fact_price_history").count() == 2 + more
        assert mart.table("fact_price_history").filter("effective_end IS NULL").count() == 1


def test_ids_continue_after_the_highest(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "ids-test"))
    mart.refresh(frames.staging(sales=[("2024-01-02", "A", 1, 1), ("2024-01-01", "B", 1, 1)]), frames.dims(), T0)
    mart.refresh(frames.staging(sales=[("2023-01-02", "A", 1, 1), ("2024-01-01", "B", 1, 1)]), frames.dims(), T1)
    rows = mart.table("fact_sales").orderBy("sale_id").collect()
    assert [(r.sale_id, r.sale_date, r.created_at) for r in rows] == [
        (1, d("2024-01-01"), T0), (2, d("2024-01-02"), T0), (3, d("2023-01-02"), T1),
    ]


def test_a_failed_run_leaves_facts_and_a_reason(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "failure-test"))
    assert mart.facts()["fact_sales"].count() == 0
    good = frames.staging(sales=[("2024-01-01", "A", 1, 1)], prices=[("A", 5, "2024-01-01", None), ("A", -5, "2024-01-01", None)])
    mart.refresh(good, frames.dims(), T0)
    with pytest.raises(LoadRejected):
        mart.refresh(frames.staging(sales=[("2024-01-05", "ZZZ", 1, 1)]), frames.dims(), T1)
    assert mart.published().runs == [1]
    assert mart.table("fact_sales").count() == 1
    runs = {r.run_id: r for r in mart.runs().collect()}
    assert (runs[1].status, runs[1].rows_loaded, runs[1].rows_rejected, runs[1].failure_reason) == ("SUCCESS", 2, 1, None)
    assert runs[2].status == "FAILED" and "without dimension row" in runs[2].failure_reason
    assert latest_run(mart.runs()).first().run_id == 2
    assert [r.run_id for r in recent_runs(mart.runs(), 1).collect()] == [2]


def test_a_rejected_load_stores_nothing(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "rejected-test"))
    with pytest.raises(LoadRejected):
        mart.refresh(frames.staging(sales=[("2024-01-05", "ZZZ", 1, 1)], prices=[("A", 5, "2024-01-01", None)]), frames.dims(), T0)
    for name in ("fact_sales", "fact_discount_events", "fact_price_history"):
        assert not os.path.exists(f"{mart.root.removeprefix('file:')}/{name}/run_id=1")


def test_a_run_that_dies_before_its_last_record_stays_invisible(spark, frames, monkeypatch):
    mart = MartStore(spark, scratch_path(spark, "crash-test"))
    staging = frames.staging(sales=[("2024-01-01", "A", 1, 1)])
    real = st.append_rows
    with monkeypatch.context() as patch:
        def crash(df, path):
            if df.filter("status = 'SUCCESS'").count():
                raise OSError("lost")
            real(df, path)

        patch.setattr(st, "append_rows", crash)
        with pytest.raises(OSError):
            mart.refresh(staging, frames.dims(), T0)
    assert mart.table("fact_sales").count() == 0
    assert [r.status for r in mart.runs().collect()] == ["RUNNING"]
    mart.refresh(staging, frames.dims(), T1)
    assert mart.table("fact_sales").count() == 1


def test_one_late_sale_adds_one_month_to_what_is_compared(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "months-test"))
    days = [f"2023-{m:02d}-05" for m in range(1, 13)]
    mart.refresh(frames.staging(sales=[(day, "A", 1, 1) for day in days]), frames.dims(), T0)
    published = mart.published()
    late = frames.staging(sales=[("2023-12-05", "A", 1, 1), ("2023-02-09", "A", 1, 1)])
    met = mart._met_by(late, published)["fact_sales"]
    assert sorted(r.sale_date.month for r in met.collect()) == [2, 12]
    plan = met._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in pruned and "2023-02" in pruned and "2023-12" in pruned and "run_id" in pruned  # no other folder is read
    assert mart.refresh(late, frames.dims(), T1).rows_loaded == 1


def test_one_late_price_leaves_other_months_alone(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "parts-test"))
    prices = [(sku, 5, f"2023-{m:02d}-05", None) for sku in ("A", "B") for m in range(1, 13)]
    mart.refresh(frames.staging(prices=prices), frames.dims(), T0)
    before = mart.published().price_runs
    whole = mart.table("fact_price_history").collect()
    mart.refresh(frames.staging(prices=[("A", 7, "2023-06-20", None)]), frames.dims(), T1)
    after = mart.published().price_runs
    assert {m for m in after if after[m] != before.get(m)} == {"2023-06", "2023-07"}
    got = mart.table("fact_price_history")
    assert got.count() == len(whole) + 1
    assert repair_ranges(got).exceptAll(got).count() == 0 and got.exceptAll(repair_ranges(got)).count() == 0


def test_a_run_that_dies_after_its_writes_is_not_read(spark, frames, monkeypatch):
    mart = MartStore(spark, scratch_path(spark, "late-crash-test"))
    staging = frames.staging(sales=[("2024-01-01", "A", 1, 1)], prices=[("A", 5, "2024-01-01", None)])
    mart.refresh(staging, frames.dims(), T0)
    more = frames.staging(sales=[("2024-01-02", "A", 1, 1)], prices=[("A", 6, "2024-01-09", None)])
    with monkeypatch.context() as patch:
        patch.setattr(mart, "log", lambda *row, **more: (_ for _ in ()).throw(OSError("lost")) if row[1] == "SUCCESS" else MartStore.log(mart, *row, **more))
        with pytest.raises(OSError):
            mart.refresh(more, frames.dims(), T1)
    assert mart.table("fact_sales").count() == 1 and mart.table("fact_price_history").count() == 1
    assert mart.refresh(more, frames.dims(), T1).run_id == 3
    assert [r.sale_id for r in mart.table("fact_sales").orderBy("sale_id").collect()] == [1, 2]
    assert mart.table("fact_price_history").count() == 2 and mart.published().runs == [1, 3]


def test_a_refresh_of_one_table_leaves_the_others(spark, frames):
    mart = MartStore(spark, scratch_path(spark, "one-table-test"))
    whole = frames.staging(sales=[("2024-01-01", "A", 1, 1)], prices=[("A", 5, "2024-01-01", None)])
    mart.refresh(whole, frames.dims(), T0)
    assert mart.refresh({"stg_sales": frames.staged_sales(("2024-01-02", "A", 1, 1))}, frames.dims(), T1, batch="b").rows_loaded == 1
    assert mart.refresh({"stg_sales": frames.staged_sales(("2024-01-03", "A", 1, 1))}, frames.dims(), T1, batch="b").rows_loaded == 0
    assert mart.table("fact_sales").count() == 2 and mart.table("fact_price_history").count() == 1


def test_writes_count_as_they_write(spark, frames):
    path = scratch_path(spark, "counted")
    rows = frames.staged_sales(*[("2024-01-01", "A", i, 1) for i in range(20)])
    assert append_rows(rows, path) == 20 and append_rows(rows.filter("qty < 5"), path) == 5 and append_rows(rows.limit(0), path) == 0
    assert append_rows(spark.createDataFrame([], rows.schema), path) == 0
    assert spark.read.parquet(path).count() == 25
    assert reload_staging(rows.repartition(3), path) == 20


def test_a_task_that_is_run_again_counts_once(spark):
    """The count sits behind the last shuffle, in the tasks that write; one of them fails at first."""
    path, marks = scratch_path(spark, "retried"), tempfile.mkdtemp()

    def once(batches):
        for batch in batches:
            try:
                os.mkdir(f"{marks}/failed")
            except FileExistsError:
                yield batch
            else:
                raise RuntimeError("lost")

    rows = spark.range(0, 1000, 1, 4).repartition(3).mapInArrow(once, "id long")
    try:
        counted = append_rows(rows, path)
    except Exception:  # a local session gives a task one try only; the job is then run again as a whole
        counted = append_rows(rows, path)
    assert counted == 1000 and spark.read.parquet(path).count() == 1000


def test_a_load_as_large_as_the_store_writes_it_anew_without_looking_for_changes(spark, frames, monkeypatch):
    mart, whole = (MartStore(spark, scratch_path(spark, label)) for label in ("many-test", "whole-test"))
    first = [("A", 5, "2024-01-01", None), ("A", 6, "2024-06-01", None), ("B", 1, "2024-03-01", "2024-03-02")]
    late = [("A", 7, "2024-02-01", None), ("A", 5, "2024-01-01", None), ("C", 2, "2024-06-01", None), ("B", 8, "2024-03-01", None)]
    whole.refresh(frames.staging(prices=first + late), frames.dims(), T0, idempotent=True)
    with monkeypatch.context() as patch:
        patch.setattr(MartStore, "_write_prices", lambda *_: pytest.fail("joined with what is stored to find the changed rows"))
        assert mart.refresh(frames.staging(prices=first), frames.dims(), T0, idempotent=True).rows_loaded == 3
        assert mart.refresh(frames.staging(prices=late), frames.dims(), T0, idempotent=True).rows_loaded == 3
    got = mart.table("fact_price_history")
    assert got.count() == 6 and set(mart.published().price_runs.values()) == {2}
    assert sorted(got.select("price_hist_id").collect()) == [(i,) for i in range(1, 7)]
    ranges = lambda df: sorted((r.sku, r.effective_start, str(r.effective_end), r.price) for r in df.filter("sku <> 'B'").collect())
    assert ranges(got) == ranges(whole.table("fact_price_history"))
    assert repair_ranges(got).exceptAll(got).count() == 0 and got.exceptAll(repair_ranges(got)).count() == 0


def test_only_prices_of_the_staged_months_are_compared(spark, frames):
    facts = frames.prices((1, "A", 5, "2023-12-31", None), (2, "A", 5, "2024-01-05", None), (3, "B", 5, "2024-02-01", None))
    staged = frames.staged_prices(("A", 5, "2024-01-31", None), ("A", 5, "2024-01-02", None), ("A", 5, None, None))
    assert [r.price_hist_id for r in dedup.of_staged_months(facts, staged, "effective_start").collect()] == [2]
    assert dedup.of_staged_months(facts, staged.limit(0), "effective_start").count() == 0


def test_a_load_moves_staged_and_stored_rows_once(spark, frames):
    staged = frames.staged_discounts(
        ("A", "FLAT", 1, "2024-01-01", "2024-01-05"), ("A", "FLAT", 1, "2024-01-01", "2024-01-05"), ("A", None, 1, "2024-01-01", "2024-01-05"),
        ("A", None, 1, "2024-01-01", "2024-01-05"), ("B", "FLAT", 2, "2024-01-01", "2024-01-05"), ("B", "FLAT", 2, "2024-01-01", "2024-01-05"),
    )
    facts = frames.discounts((7, "A", None, 1, "2024-01-01", "2024-01-05"), (9, "B", "FLAT", 2, "2024-01-01", "2024-01-05"))
    columns = ID_ORDER["fact_discount_events"]
    rows = dedup.unstored_in_place(dedup.beside_stored(staged, facts, columns).repartitionByRange(4, *[F.col(c).asc_nulls_first() for c in columns]), columns)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(str, rows.collect())) == sorted(map(str, dedup.new_discounts(staged, facts).select(*columns).collect()))
    added = refresh.refresh_discounts(staged, facts, T0).orderBy("discount_event_id")
    assert [(r.discount_event_id, r.sku, r.discount_type) for r in added.collect()] == [(10, "A", None), (11, "A", "FLAT")]
