"""The whole life of a mart: seed, refresh, check, late rows, refresh again, audit."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import T0, T1
from pyspark.sql import functions as F

from tariffmart import jobs
from tariffmart.operators.intervals import overlap_counts
from tariffmart.plans import quality
from tariffmart.schemas import KEY
from tariffmart.session import scratch_path

AS_OF = dt.date(2025, 3, 19)


def test_life_of_a_mart(spark):
    folder = scratch_path(spark, "life")
    mart = jobs.Mart(spark, folder)
    jobs.seed(mart, AS_OF, T0, sales=6000)
    jobs.seed(mart, AS_OF, T1, sales=6000)
    assert {n: df.count() for n, df in mart.dims.items()} == {
        "dim_product": 55, "dim_region": 6, "dim_channel": 4, "dim_pricing_rule": 10,
    }
    assert mart.dims["dim_product"].select("created_at").distinct().first()[0] == T0
    assert sorted(r.rule_id for r in mart.dims["dim_pricing_rule"].collect()) == list(range(1, 11))

    first = jobs.refresh(mart, T0)
    assert first.rows_rejected == 10 + 18
    assert first.rows_loaded == mart.store.facts()["fact_sales"].count() + sum(
        mart.store.table(t).count() for t in ("fact_price_history", "fact_discount_events")
    )
    checks = {r.check_no: r.status for r in jobs.check(mart, AS_OF, T0).collect()}
    assert checks == {1: "PASS", 2: "PASS", 3: "PASS", 4: "WARNING", 5: "PASS"}
    assert quality.latest_report(spark, mart.reports).first().overall_status == "PASS"

    jobs.inject_late(mart, AS_OF, T1)
    jobs.refresh(mart, T1, idempotent=True)
    prices = mart.store.table("fact_price_history")
    assert prices.filter("source_system = 'LATE_LOAD_SYS' AND price = 99.99").count() == 5
    assert overlap_counts(prices, "effective_start", "effective_end", strict=True).count() == 0
    per_key = prices.groupBy(*KEY).agg(F.count_if(F.col("effective_end").isNull()).alias("n"))
    assert per_key.filter("n <> 1").count() == 0
    assert mart.store.table("fact_sales").filter("net_sales = 999.90 AND qty = 10").count() >= 5
    assert {r.section: r.status for r in jobs.audit_all(mart, AS_OF).collect()}["OVERALL"] == "PASS"


def test_a_dying_dimension_merge_leaves_the_old_version(spark, monkeypatch):
    mart = jobs.Mart(spark, scratch_path(spark, "versions"))
    source = spark.createDataFrame([("NE", "North")], "region_code string, region_name string")
    jobs.merge_dimension(mart, "dim_region", source, T0)

    def crash(df, label):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "written", crash)
        with pytest.raises(OSError):
            jobs.merge_dimension(mart, "dim_region", source.withColumn("region_name", F.lit("Other")), T1)
    assert [r.region_name for r in mart.dims["dim_region"].collect()] == ["North"]
    jobs.merge_dimension(mart, "dim_region", source.withColumn("region_name", F.lit("Other")), T1)
    assert [r.region_name for r in mart.dims["dim_region"].collect()] == ["Other"]


def test_command_line(spark, capsys, monkeypatch):
    folder = scratch_path(spark, "command")
    run = lambda job, *more: jobs.main([job, "--mart", folder, "--as-of", "2025-03-19", *more])
    assert run("seed", "--sales", "300") == 0
    assert run("refresh") == 0
    assert "rejected 28" in capsys.readouterr().out
    assert run("history") == 0
    assert run("audit") == 2  # 300 staged sales are below the threshold
    assert "[FAIL] Staging data checks" in capsys.readouterr().out
