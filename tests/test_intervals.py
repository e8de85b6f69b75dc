"""Interval operators against brute force, inverted and zero-length intervals included."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tariffmart.operators import intervals
from tariffmart.operators.intervals import one_row_per_day, overlap_counts, overlap_witnesses, overlapping_spans

DAY0 = dt.date(2024, 1, 1)
SCHEMA = "id bigint, sku string, region_code string, channel_code string, s date, e date"


def random_rows(seed: int, size: int = 60, span: int = 12):
    rnd = random.Random(seed)
    rows = []
    for i in range(size):
        start = DAY0 + dt.timedelta(days=rnd.randrange(span))
        kind = rnd.random()
        if kind < 0.2:
            end = None
        elif kind < 0.4:
            end = start
        elif kind < 0.6:
            end = start - dt.timedelta(days=rnd.randrange(1, 6))
        else:
            end = start + dt.timedelta(days=rnd.randrange(1, 8))
        rows.append((i, rnd.choice("AAAB"), "NE", "ONLINE", start, end))
    return rows


def closed(row):
    return row[4], row[5] or dt.date(9999, 12, 31)


def meets(a, b, strict):
    (s1, e1), (s2, e2) = closed(a), closed(b)
    return (s1 < e2 and s2 < e1) if strict else (s1 <= e2 and s2 <= e1)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("strict", [True, False])
def test_overlap_counts(spark, seed, strict):
    rows = random_rows(seed)
    want = Counter()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a[1] == b[1] and meets(a, b, strict):
                want[a[1]] += 1
    got = overlap_counts(spark.createDataFrame(rows, SCHEMA), "s", "e", strict).collect()
    assert {r.sku: int(r.pairs) for r in got} == dict(want)


@pytest.mark.parametrize("strict", [True, False])
def test_overlap_counts_without_inverted_rows(spark, strict):
    rows = [r for r in random_rows(9) if r[5] is None or r[5] >= r[4]]
    want = Counter(
        a[1] for i, a in enumerate(rows) for b in rows[i + 1 :] if a[1] == b[1] and meets(a, b, strict)
    )
    got = overlap_counts(spark.createDataFrame(rows, SCHEMA), "s", "e", strict).collect()
    assert {r.sku: int(r.pairs) for r in got} == dict(want)


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_spans(spark, seed):
    rows = [r for r in random_rows(seed, size=25, span=60) if r[5] is not None]
    spans = {(r[1], r[4], r[5]) for r in rows}
    want = {
        a for a in spans if any(a[0] == b[0] and a != b and a[1] <= b[2] and b[1] <= a[2] for b in spans)
    }
    got = overlapping_spans(spark.createDataFrame(rows, SCHEMA), "s", "e").collect()
    assert {(r.sku, r.s, r.e) for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("strict", [True, False])
def test_witnesses_are_real_and_cover_every_key(spark, seed, strict):
    rows = [r for r in random_rows(seed, size=30, span=40) if r[5] is None or r[5] >= r[4]]
    by_id = {r[0]: r for r in rows}
    got = overlap_witnesses(spark.createDataFrame(rows, SCHEMA), "id", "s", "e", strict).collect()
    for r in got:
        assert r.first_id != r.second_id
        assert by_id[r.first_id][1] == by_id[r.second_id][1]
        assert meets(by_id[r.first_id], by_id[r.second_id], strict)
    assert len({r.second_id for r in got}) == len(got)
    offending = {a[1] for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and meets(a, b, strict)}
    assert {r.sku for r in got} == offending


@pytest.mark.parametrize("seed", range(3))
def test_one_row_per_day_is_the_range_join(spark, seed):
    df = spark.createDataFrame(random_rows(seed), SCHEMA)
    first, last = DAY0 + dt.timedelta(days=3), DAY0 + dt.timedelta(days=9)
    days = spark.range(7).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("as_of_date"))
    joined = df.join(days, (F.col("s") <= F.col("as_of_date")) & (F.col("e").isNull() | (F.col("e") >= F.col("as_of_date"))))
    unrolled = one_row_per_day(df, "s", "e", first, last)
    assert unrolled.exceptAll(joined.select(unrolled.columns)).count() == 0
    assert unrolled.count() == joined.count()


def test_a_hot_key_is_counted_without_pairs(spark):
    """200,000 equal intervals on one key are 2 * 10**10 pairs."""
    df = spark.range(200_000).select(
        F.lit("A").alias("sku"), F.lit("NE").alias("region_code"), F.lit("ONLINE").alias("channel_code"),
        F.lit(DAY0).alias("s"), F.date_add(F.lit(DAY0), 5).alias("e"),
    )
    assert int(overlap_counts(df, "s", "e", False).first().pairs) == 200_000 * 199_999 // 2


def test_products_beyond_half_a_long_are_exact(spark, monkeypatch):
    rows = random_rows(5, size=80, span=4)
    df = spark.createDataFrame(rows, SCHEMA)
    for strict in (True, False):
        expected = Counter(a[1] for i, a in enumerate(rows) for b in rows[:i] if a[1] == b[1] and meets(a, b, strict))
        for half in (31, 3, 1):  # with few bits most products go by decimals, and sums have upper bits
            monkeypatch.setattr(intervals, "HALF", half)
            assert {r.sku: int(r.pairs) for r in overlap_counts(df, "s", "e", strict).collect()} == expected
