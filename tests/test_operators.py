from __future__ import annotations

import pytest
from conftest import T0, T1, d, n
from pyspark.sql import functions as F

from tariffmart.operators import merge, surrogate, validate
from tariffmart.operators.overrides import price_overrides
from tariffmart.plans import audit, lookups, quality, rewrite, views
from tariffmart.plans import overrides as demo
from tariffmart.schemas import CONTRACTS
from tariffmart.session import scratch_path
from tariffmart.sources import inline
from tariffmart.sources.tables import as_table, empty_table


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("hot").alias("k"))
    rows = surrogate.with_surrogate_key(df, "row_id", ["k", "x"], after=10).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(11, 5011))
    assert [r.x for r in rows] == sorted(r.x for r in rows)


def test_surrogate_keys_with_several_files_per_task(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 300)
    try:
        df = spark.range(2000).select(F.col("id").alias("x"))
        rows = surrogate.with_surrogate_key(df, "row_id", ["x"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert {r.row_id: r.x for r in rows} == {i + 1: i for i in range(2000)}


def test_surrogate_keys_of_no_rows(spark):
    assert surrogate.with_surrogate_key(spark.range(0), "row_id", ["id"]).count() == 0


def test_upsert_takes_null_from_the_source_and_keeps_the_rest(spark, frames):
    target = frames.dims(skus=("A", "B"))["dim_product"]
    source = spark.createDataFrame(
        [("B", None, "new", None, False), ("C", "c", "new", "x", True)],
        "sku string, product_name string, category string, brand string, is_active boolean",
    )
    got = {r.sku: r for r in merge.upsert(target, source, ["sku"], ["product_name", "category", "brand", "is_active"]).collect()}
    assert got["A"].product_name == "A" and got["A"].created_at == T0
    assert (got["B"].product_name, got["B"].category, got["B"].is_active, got["B"].created_at) == (None, "new", False, T0)
    assert (got["C"].product_name, got["C"].created_at) == ("c", None)


def test_seed_dimensions(spark):
    seeds = inline.seed_dimensions(spark)
    assert {n: df.count() for n, df in seeds.items()} == {
        "dim_product": 55, "dim_region": 6, "dim_channel": 4, "dim_pricing_rule": 10,
    }
    products = as_table(seeds["dim_product"], "dim_product")
    assert merge.upsert(products, seeds["dim_product"], ["sku"], ["brand"]).count() == 55


def test_update_from_changes_matched_rows_only(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame([(2, None)], "id int, w string")
    assert sorted(merge.update_from(target, changes, "id", {"v": "w"}).collect(), key=str) == [(1, "a"), (2, None)]


def test_diff_sees_copies_only_in_the_counts(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert merge.row_differences(a, b).count() == 0
    row = merge.diff_summary(a, b).first()
    assert (row.left_rows, row.right_rows, row.only_left, row.only_right, row.result) == (3, 2, 0, 0, "FAIL")
    assert merge.diff_summary(b, b).first().result == "PASS"
    empty = b.limit(0)
    assert merge.diff_summary(empty, empty).first().result == "PASS"


def test_contract_lists_every_rule(spark, frames):
    rows = {
        (r.column_name, r.rule): r.row_count
        for r in validate.contract_violations(frames.staged_prices((None, 1, None, None, "EURO")), CONTRACTS["fact_price_history"]).collect()
    }
    assert rows[("sku", "not_null")] == rows[("effective_start", "not_null")] == rows[("currency", "max_length_3")] == 1
    assert rows[("price", "not_null")] == 0


def test_orphans(spark, frames):
    sales = frames.sales((1, "2024-01-01", "A", 1, 1), (2, "2024-01-01", "X", 1, 1), (3, "2024-01-01", "X", 2, 1))
    prices = frames.prices((7, "Y", 1, "2024-01-01", None))
    assert quality.orphan_facts(sales, prices, frames.dims()).first().issue_count == 3
    rows = validate.orphan_rows(sales, frames.dims(), "fact_sales", "sale_id").collect()
    assert sorted(r.row_id for r in rows) == [2, 3]


def test_current_price_takes_the_latest_open_start_even_ahead(spark, frames):
    prices = frames.prices((1, "A", 1, "2024-01-01", None), (2, "A", 2, "2099-01-01", None), (3, "B", 3, "2024-01-01", "2024-02-01"))
    assert lookups.current_price(prices, "A", "NE", "ONLINE").first().current_price == n("2.0000")
    assert lookups.current_price(prices, "B", "NE", "ONLINE").count() == 0
    assert lookups.current_price_all(prices).count() == 1


def test_price_history_checks_dates_and_orders(spark, frames):
    prices = frames.prices(
        (1, "A", 1, "2024-01-01", "2024-01-31"), (2, "A", 2, "2024-02-01", None), (3, "A", 3, "2024-02-01", "2024-02-05")
    )
    got = lookups.price_history(prices, "A", "2024-01-31", "2024-02-01").collect()
    assert [(r.effective_start, r.effective_end) for r in got] == [
        (d("2024-02-01"), d("2024-02-05")), (d("2024-02-01"), None), (d("2024-01-01"), d("2024-01-31")),
    ]
    assert lookups.price_history(prices, "A", "2024-01-01", "2024-12-31", region_code="SE").count() == 0
    with pytest.raises(ValueError):
        lookups.price_history(prices, "A", "01/02/2024", "2024-12-31")


def test_snapshot_limit(spark, frames):
    facts = {"fact_sales": frames.sales(), "fact_price_history": frames.prices(), "fact_discount_events": frames.discounts()}
    with pytest.raises(ValueError):
        lookups.bi_snapshot(facts, frames.dims(), d("2024-03-01"), "2024-03-01", "NE", "ONLINE", limit=501)


def test_grid_reaches_one_day_further_for_keys_than_for_days(spark, frames):
    as_of = d("2024-03-01")
    facts = {
        "fact_sales": frames.sales((1, "2024-01-01", "A", 3, 9), (2, "2024-02-20", "C", 3, 9)),
        "fact_price_history": frames.prices((1, "B", 7, "2024-02-15", None)),
        "fact_discount_events": frames.discounts(
            (1, "B", "FLAT", 50, "2024-02-20", "2024-02-21"), (2, "B", "PERCENT", 15, "2024-02-20", "2024-02-20")
        ),
    }
    grid = views.pricing_bi_dataset(facts, frames.dims(inactive=("C",)), as_of)
    rows = grid.collect()
    assert len(rows) == 120
    a = [r for r in rows if r.sku == "A"]
    assert {r.daily_sales_qty for r in a} == {0} and {r.dq_missing_price_flag for r in a} == {1}
    assert {(r.current_price, r.currency) for r in a} == {(n("0.0000"), "USD")}
    b = {r.as_of_date: r for r in rows if r.sku == "B"}
    assert b[d("2024-02-14")].dq_missing_price_flag == 1 and b[d("2024-02-15")].current_price == n("7.0000")
    assert (b[d("2024-02-20")].active_discount_type, b[d("2024-02-20")].active_discount_value) == ("FLAT", n("50.0000"))
    assert b[d("2024-02-22")].active_discount_type is None


def test_quality_gate_and_report(spark, frames):
    as_of = d("2024-03-01")
    facts = {
        "fact_sales": frames.sales((1, "2024-02-20", "A", 1, 1), (2, "2024-02-20", "B", 1, 1), (3, "2024-02-21", "B", 1, 1)),
        "fact_price_history": frames.prices((1, "A", 7, "2024-02-15", None)),
        "fact_discount_events": frames.discounts(
            (1, "B", "FLAT", 50, "2024-02-20", "2024-02-21"), (2, "B", "PERCENT", 15, "2024-02-21", "2024-02-22")
        ),
    }
    checks = quality.run_checks(facts, frames.dims(), as_of)
    got = {r.check_no: (r.status, r.issue_count) for r in checks.collect()}
    assert got == {1: ("PASS", 0), 2: ("PASS", 0), 3: ("PASS", 0), 4: ("WARNING", 1), 5: ("FAIL", 1)}
    with pytest.raises(quality.QualityGateFailed, match="Missing Current Price Coverage: 1"):
        quality.enforce(checks)
    quality.enforce(checks.filter("check_no < 5"))

    assert quality.samples(facts, frames.dims(), as_of, []).count() == 0
    _, whole = quality.report(facts, frames.dims(), as_of, T1)
    assert [len(c.sample) for c in whole.first().checks] == [0, 0, 0, 1, 1]

    path = scratch_path(spark, "report-test")
    assert quality.latest_report(spark, path).count() == 0
    for moment, part in [(T1, checks), (T0, checks.filter("check_no < 5"))]:
        quality.write_report(quality.build_report(part, quality.samples(facts, frames.dims(), as_of, [4, 5]), moment), path)
    report = quality.latest_report(spark, path).first()
    assert (report.generated_at, report.overall_status, len(report.checks)) == ("2024-02-01T00:00:00", "FAIL", 5)
    assert report.checks[3].name == "Overlapping Active Discounts" and len(report.checks[3].sample) == 1
    assert '"sku":"B"' in report.checks[4].sample[0]


def test_strict_prices_and_inclusive_discounts(spark, frames):
    touching = [("2024-01-01", "2024-01-05"), ("2024-01-05", "2024-01-09")]
    prices = frames.prices(*[(i, "A", 1, s, e) for i, (s, e) in enumerate(touching)])
    discounts = frames.discounts(*[(i, "A", "FLAT", 1, s, e) for i, (s, e) in enumerate(touching)])
    assert quality.price_overlaps(prices).first().status == "PASS"
    assert quality.discount_overlaps(discounts).first().issue_count == 1


def test_staged_overlaps_need_a_difference(spark, frames):
    span = ("2024-01-01", "2024-01-05")
    count = lambda *rows: audit.staged_overlap_spans(frames.staged_discounts(*rows)).count()
    assert count(("A", "FLAT", 1, *span), ("A", "FLAT", 1, *span)) == 0
    assert count(("A", None, 1, *span), ("A", "", 1, *span)) == 0
    assert count(("A", "FLAT", None, *span), ("A", "FLAT", 1, *span)) == 0
    assert count(("A", "FLAT", 2, *span), ("A", "FLAT", 1, *span)) == 1
    assert count(("A", None, 1, *span), ("A", "FLAT", 1, *span)) == 1
    assert count(("A", "FLAT", 1, *span), ("A", "FLAT", 1, "2024-01-05", "2024-01-06")) == 2
    assert count(("A", "FLAT", 1, *span), ("B", "FLAT", 2, *span)) == 0


def test_thresholds(spark, frames):
    got = {r.measure: r.status for r in audit.staging_profile(frames.staging(prices=[("A", -1, "2024-01-01", None)] * 10)).collect()}
    assert got["negative_price"] == "PASS" and got["missing_sku"] == "FAIL" and got["overlapping_discounts"] == "FAIL"


def test_fan_out_equals_the_joined_rows(spark, frames):
    as_of = d("2024-03-01")
    facts = {
        "fact_sales": frames.sales((1, "2024-02-20", "A", 2, 10), (2, "2024-02-21", "A", 3, 10), (3, "2024-02-21", "B", 3, 10)),
        "fact_price_history": frames.prices((1, "A", 7, "2024-02-15", None), (2, "A", 9, "2024-02-16", None), (3, "B", 1, "2024-02-16", None)),
        "fact_discount_events": frames.discounts(
            *[(i, "A", "FLAT", i, "2024-02-20", "2024-03-02") for i in (1, 2, 3)]
        ),
    }
    args = (d("2024-02-01"), as_of, as_of, "NE", "ONLINE")
    naive = rewrite.fan_out_report(facts, frames.dims(), *args)
    assert [tuple(r) for r in naive.collect()] == [("A", 30, n("120.00"), n("9.0000"), n("3.0000"))]
    tuned = {r.sku: tuple(r)[1:] for r in rewrite.tuned_report(facts, *args).collect()}
    assert tuned == {"A": (5, n("20.00"), n("9.0000"), n("3.0000")), "B": (3, n("10.00"), n("1.0000"), None)}
    assert rewrite.verify_rewrite(naive, rewrite.tuned_report(facts, *args)).first().result == "FAIL"
    assert rewrite.rewrite_samples(naive, rewrite.tuned_report(facts, *args)).count() == 3


def test_overrides_log_open_changed_prices_made_by_hand(spark, frames):
    before = frames.prices((1, "A", 1, "2024-01-01", "2024-02-01"), (2, "A", 2, "2024-02-02", None), (3, "B", 3, "2024-01-01", None))
    after = frames.prices((1, "A", 9, "2024-01-01", "2024-02-01"), (2, "A", 9, "2024-02-02", None), (3, "B", 3, "2024-01-01", None))
    row = price_overrides(before, after, "me", T1).collect()
    assert [(r.price_hist_id, r.old_price, r.new_price, r.changed_by, r.changed_at) for r in row] == [(2, n("2.0000"), n("9.0000"), "me", T1)]
    assert price_overrides(before, after, "me", T1, is_etl=True).count() == 0
    shown = demo.override_demo(before, "me", T1).collect()
    assert [(r.price_hist_id, r.old_price, r.new_price) for r in shown] == [(2, n("3.0000"), n("8.5000"))]
    log = demo.append_to_audit(empty_table(spark, "price_override_audit"), demo.override_demo(before, "me", T1))
    assert [(r.audit_id, r.sku) for r in demo.audit_tail(log).collect()] == [(1, "A")]


def test_overlap_flags_answer_for_every_span_of_a_day(spark):
    from tariffmart.operators.intervals import with_overlaps

    spans = [("A", 1, 3), ("A", 3, 5), ("A", 7, 7), ("A", 9, 8), ("A", 8, 12), ("B", 1, 1), ("B", 2, 4), ("B", 2, 9), ("C", 5, 4), ("C", 6, 4)]
    date = lambda n: d(f"2024-01-{n:02d}")
    df = spark.createDataFrame([(k, date(s), date(e)) for k, s, e in spans], "k string, s date, e date")
    got = {(r.k, r.s.day, r.e.day) for r in with_overlaps(df, "s", "e", ["k"]).filter("overlaps").collect()}
    assert got == {("A", 1, 3), ("A", 3, 5), ("A", 9, 8), ("A", 8, 12), ("B", 2, 4), ("B", 2, 9)}
    plan = with_overlaps(df, "s", "e", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_equal_tables_move_no_rows_and_a_planted_difference_is_found(spark):
    from tariffmart.operators.merge import diff_summary, fingerprints, row_differences

    wide = ", ".join(f"CAST(id % {n} AS STRING) AS c{n}" for n in range(2, 14))
    left = spark.range(20_000).selectExpr("IF(id % 7 = 0, NULL, id) AS a", "IF(id % 11 = 0, NULL, id) AS b", *wide.split(", "), "id / 3 AS x")
    right = left.repartition(7, "a").orderBy("x")
    assert row_differences(left, right).count() == 0
    assert fingerprints(left, right).filter("NOT same").count() == 0
    row = diff_summary(left, right).first()
    assert (row.left_rows, row.right_rows, row.only_left, row.only_right, row.result) == (20_000, 20_000, 0, 0, "PASS")
    differ = row_differences(left, right)
    differ.collect()
    plan = differ._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "c13" not in " ".join(line for line in final.splitlines() if "Exchange hashpartitioning" in line)

    swapped = right.selectExpr("IF(a = 15, NULL, a) AS a", "IF(a = 15, 15, b) AS b", *[c for c in right.columns if c not in "ab"])
    found = {r.only_in: r for r in row_differences(left, swapped).collect()}
    assert set(found) == {"left", "right"} and found["left"].a == 15 and found["right"].a is None
    copied = diff_summary(left, right.unionByName(right.limit(1))).first()
    assert (copied.only_left, copied.only_right, copied.result) == (0, 0, "FAIL") and copied.right_rows == 20_001
    assert [r.result for r in diff_summary(left.limit(0), right.limit(0)).collect()] == ["PASS"]
    minus = spark.createDataFrame([(-0.0,)], "x double")
    assert row_differences(minus, spark.createDataFrame([(0.0,)], "x double")).count() == 0


def test_a_page_of_the_snapshot_equals_the_grids(spark, frames):
    import datetime as dt

    from tariffmart.plans.lookups import bi_snapshot
    from tariffmart.plans.views import pricing_bi_dataset

    as_of = dt.date(2024, 3, 1)
    facts = {
        "fact_sales": frames.sales((1, "2024-02-20", "B", 1, 5), (2, "2024-02-20", "B", 2, 5), (3, "2024-02-20", "A", 1, 0), (4, "2024-02-10", "C", 1, 9), (5, "2024-02-20", "D", 1, -3), (6, "2024-02-20", "Z", 1, 99)),
        "fact_price_history": frames.prices((1, "A", 5, "2024-01-01", None), (2, "E", 7, "2024-01-01", "2024-02-20"), (3, "F", 7, "2023-01-01", "2023-02-20"), (4, "B", 3, "2024-02-20", None), (5, "B", 4, "2024-02-20", "2024-02-20")),
        "fact_discount_events": frames.discounts((1, "B", "FLAT", 5, "2024-02-01", "2024-02-28"), (2, "B", None, 5, "2024-01-15", "2024-02-28"), (3, "G", "FLAT", 1, "2024-01-01", "2024-01-05")),
    }
    dims = frames.dims(skus=tuple("ABCDEFG"), inactive=("C",))
    for on in ("2024-02-20", "2024-02-25", "2024-01-02"):
        for limit in (1, 2, 3, 4, 500):
            grid = pricing_bi_dataset(facts, dims, as_of, on=on, region="NE", channel="ONLINE")
            want = grid.orderBy(F.col("daily_net_sales").desc(), "sku").limit(limit)
            page = bi_snapshot(facts, dims, as_of, on, "NE", "ONLINE", limit)
            assert page.schema.simpleString() == want.schema.simpleString() and page.collect() == want.collect()
    assert bi_snapshot(facts, dims, as_of, "2023-02-20", "NE", "ONLINE").count() == 0
    assert bi_snapshot(facts, dims, as_of, "2024-02-20", "SE", "ONLINE").count() == 0
