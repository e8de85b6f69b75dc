from __future__ import annotations

import random

from conftest import T0, T1, d
from pyspark.sql import functions as F

from tariffmart.operators.intervals import overlap_counts
from tariffmart.operators import repair as rp
from tariffmart.operators.repair import ranges_changed, repair_ranges
from tariffmart.streaming.late import late_arrivals, late_repair


def ends(df):
    return {r.price_hist_id: r.effective_end for r in df.collect()}


def test_gaps_and_expiry_are_discarded(spark, frames):
    got = ends(repair_ranges(frames.prices((1, "A", 1, "2024-01-01", "2024-01-05"), (2, "A", 2, "2024-02-01", "2024-02-10"))))
    assert got == {1: d("2024-01-31"), 2: None}


def test_same_day_ties_keep_one_day_each(spark, frames):
    got = ends(
        repair_ranges(
            frames.prices(
                (1, "A", 1, "2024-01-01", None), (2, "A", 2, "2024-01-01", None), (3, "A", 3, "2024-01-01", None),
                (4, "A", 4, "2024-01-09", None),
            )
        )
    )
    assert got == {1: d("2024-01-01"), 2: d("2024-01-01"), 3: d("2024-01-08"), 4: None}


def test_ties_follow_arrival_before_id(spark, frames):
    got = ends(repair_ranges(frames.prices((9, "A", 1, "2024-01-01", None, T0), (1, "A", 2, "2024-01-01", None, T1))))
    assert got == {9: d("2024-01-01"), 1: None}


def test_an_end_one_day_before_the_next_start_is_left_alone(spark, frames):
    # Inverted before a tie: the end is already next start - 1, so the floor is not applied.
    prices = frames.prices((1, "A", 1, "2024-01-05", "2024-01-04"), (2, "A", 2, "2024-01-05", None))
    assert ends(repair_ranges(prices)) == {1: d("2024-01-04"), 2: None}
    assert ranges_changed(prices).count() == 0


def test_a_tie_is_touched_again_with_the_same_value(spark, frames):
    prices = frames.prices((1, "A", 1, "2024-01-05", "2024-01-05"), (2, "A", 2, "2024-01-05", None))
    row = ranges_changed(prices).first()
    assert (row.price_hist_id, row.old_end, row.new_end) == (1, d("2024-01-05"), d("2024-01-05"))


def test_random_histories_end_up_clean(spark, frames):
    rnd = random.Random(5)
    rows = [
        (i, rnd.choice("ABC"), 1, f"2024-{rnd.randrange(1, 7):02d}-{rnd.randrange(1, 28):02d}",
         rnd.choice([None, f"2024-{rnd.randrange(7, 12):02d}-01"]))
        for i in range(1, 60)
    ]
    fixed = repair_ranges(frames.prices(*rows)).cache()
    assert fixed.count() == len(rows)
    assert overlap_counts(fixed, "effective_start", "effective_end", strict=True).count() == 0
    open_rows = fixed.filter("effective_end IS NULL").groupBy("sku").count().collect()
    assert {r.sku: r["count"] for r in open_rows} == {"A": 1, "B": 1, "C": 1}
    assert repair_ranges(fixed).exceptAll(fixed).count() == 0
    fixed.unpersist()


def test_a_late_row_cuts_its_neighbours(spark, frames):
    base = frames.prices((1, "A", 1, "2024-01-01", None), (2, "A", 2, "2024-03-01", None))
    late = frames.prices((3, "A", 3, "2024-02-01", None, T1))
    got = late_repair(base, late).collect()
    assert [(r.price_hist_id, r.end_without_late, r.end_with_late) for r in got] == [(1, d("2024-02-29"), d("2024-01-31"))]


def test_late_arrivals(spark, frames):
    staged = frames.staged_prices(("A", 1, "2023-12-02", None), ("A", 1, "2023-12-03", None))
    got = late_arrivals(staged, "effective_start").collect()
    assert [(r.effective_start, r.days_late) for r in got] == [(d("2023-12-02"), 30)]


def test_a_hot_day_of_a_key_is_repaired(spark, frames):
    """20,000 rows on one key and day: all but the last end that day."""
    row = frames.prices((1, "A", 1, "2024-01-05", None))
    many = spark.range(1, 20_001).crossJoin(row.drop("price_hist_id")).withColumnRenamed("id", "price_hist_id")
    got = repair_ranges(many.select(row.columns))
    assert got.filter("effective_end IS NULL").select("price_hist_id").collect()[0][0] == 20_000
    assert got.filter(F.col("effective_end") == F.lit(d("2024-01-05"))).count() == 19_999


def test_repair_of_a_whole_table_by_rows_or_by_days(spark, frames):
    days = ["2024-01-01", "2024-01-01", "2024-01-09", "2024-02-01", "2024-02-01", "2024-02-01", "2024-03-05"]
    ends = [None, "2024-01-08", "2023-12-01", None, "2024-02-01", "2024-03-04", "2024-04-01"]
    rows = [(10 * k + i, sku, 5, day, end, T1 if i % 3 == 0 else T0) for k, sku in enumerate("AB") for i, (day, end) in enumerate(zip(days, ends))]
    prices = frames.prices(*rows, (99, "C", 5, "2024-01-01", "2024-01-05"))
    expected = sorted(repair_ranges(prices).collect())
    assert len(expected) == 15
    for hot_rows in (0, 1, 100):  # all skus by days, C by its rows, all by their rows
        assert sorted(rp.repair_all(prices, hot_rows).collect()) == expected
