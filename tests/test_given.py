"""Counts of the derived staging and of the first load, as listed in FIXTURES.md."""

from __future__ import annotations

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from tariffmart.operators import intervals, repair
from tariffmart.plans import quality, rewrite, views
from tariffmart.plans.workspace import Workspace, workspace
from tariffmart.registry import YEAR
from tariffmart.sources.given import AS_OF

EXPECTED = {
    SMALL: dict(
        sales=(6102, 6000), prices=6102, discounts=(6102, 6000), rejected=472, facts=(5697, 5536, 5697), changed=5336,
        before=16252, discount_pairs=386, active=43, unpriced=6, keys=474, grid=(28440, 0), qty=4538, net="9939924.73",
        with_discount=1546, reports=(18, 3), unknown=309, products=19,
    ),
    MEDIUM: dict(
        sales=(61179, 60000), prices=61179, discounts=(61179, 60000), rejected=4839, facts=(56894, 55239, 56894), changed=53082,
        before=143266, discount_pairs=4030, active=365, unpriced=36, keys=4750, grid=(249000, 0), qty=31173, net="64775892.24",
        with_discount=16818, reports=(159, 14), unknown=3150, products=190,
    ),
}


def _pairs(counts):
    return int(counts.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0])


@pytest.mark.parametrize("directory", [SMALL, MEDIUM])
def test_expected_counts(spark, directory):
    want = EXPECTED[directory]
    w = workspace(spark, directory)
    stage, facts = w.staging, w.facts
    assert (stage["stg_sales"].count(), stage["stg_sales"].distinct().count()) == want["sales"]
    assert stage["stg_price_history"].count() == want["prices"]
    assert (stage["stg_discount_events"].count(), stage["stg_discount_events"].distinct().count()) == want["discounts"]
    assert w.dims["dim_product"].count() == want["products"]
    assert w.loaded[1].rows_rejected == want["rejected"]
    counts = tuple(facts[t].count() for t in ("fact_sales", "fact_price_history", "fact_discount_events"))
    assert counts == want["facts"]
    assert w.loaded[1].rows_loaded == sum(want["facts"])
    assert repair.ranges_changed(w.unrepaired).count() == want["changed"]
    prices = facts["fact_price_history"]
    assert _pairs(intervals.overlap_counts(w.unrepaired, "effective_start", "effective_end", True)) == want["before"]
    assert _pairs(intervals.overlap_counts(prices, "effective_start", "effective_end", True)) == 0
    assert _pairs(intervals.overlap_counts(facts["fact_discount_events"], "start_date", "end_date", False)) == want["discount_pairs"]
    assert views.discount_active(stage["stg_discount_events"], AS_OF).count() == want["active"]
    assert quality.unpriced_keys(stage["stg_sales"], prices, AS_OF).count() == want["unpriced"]
    assert views.recent_activity_keys(facts, AS_OF).count() == want["keys"]
    grid = views.pricing_bi_dataset(facts, w.dims, AS_OF).agg(
        F.count("*"), F.sum("dq_missing_price_flag"), F.sum("daily_sales_qty"), F.sum("daily_net_sales"), F.count("active_discount_type")
    ).first()
    assert (grid[0], grid[1]) == want["grid"]
    assert (grid[2], str(grid[3]), grid[4]) == (want["qty"], want["net"], want["with_discount"])
    assert (
        rewrite.tuned_report(facts, *YEAR).count(),
        rewrite.fan_out_report(facts, w.dims, *YEAR).count(),
    ) == want["reports"]


def test_bounds_inside_the_branches_equal_a_filter_on_the_grid(spark):
    w = workspace(spark, SMALL)
    bounded = views.pricing_bi_dataset(w.facts, w.dims, AS_OF, on="2001-07-20", region="AS", channel="BUIL")
    whole = views.pricing_bi_dataset(w.facts, w.dims, AS_OF).filter(
        "as_of_date = DATE'2001-07-20' AND region_code = 'AS' AND channel_code = 'BUIL'"
    )
    assert bounded.count() == whole.count() > 0
    assert bounded.exceptAll(whole).count() == 0


def test_a_day_outside_the_calendar_is_empty(spark):
    w = workspace(spark, SMALL)
    assert views.pricing_bi_dataset(w.facts, w.dims, AS_OF, on="1999-01-01").count() == 0


def test_a_query_loads_only_the_tables_it_reads(spark):
    w = Workspace(spark, SMALL)
    begun = []
    fresh = w.fresh_store
    w.fresh_store = lambda: begun.append(fresh()) or begun[-1]
    assert w.staging["stg_price_history"].count() and not begun
    prices = w.facts["fact_price_history"].count()
    assert [{n: df.count() > 0 for n, df in store.facts().items()} for store in begun] == [
        {"fact_sales": False, "fact_discount_events": False, "fact_price_history": True}
    ]
    w.facts["fact_price_history"], w.unrepaired
    assert len(begun) == 1
    assert w.loaded[1].new_rows["fact_price_history"].count() == prices == w.unrepaired.count()
