from __future__ import annotations

import datetime as dt

import pytest
from conftest import T0, d
from pyspark.sql import Window
from pyspark.sql import functions as F

from tariffmart import jobs
from tariffmart.functions import expressions as X
from tariffmart.operators.intervals import overlap_counts
from tariffmart.operators.validate import type_violations
from tariffmart.plans.audit import staging_profile
from tariffmart.session import scratch_path
from tariffmart.sources import generators, inline, tables
from tariffmart.sources.given import AS_OF


def test_csv_files_are_staged_with_their_name(spark, tmp_path):
    (tmp_path / "sales_2024_01_02.csv").write_text("2024-01-02,A,NE,ONLINE,3,12.50\n2024-01-02,,NE,ONLINE,,1\n")
    rows = tables.stage_files(spark, str(tmp_path), "stg_sales", T0, fmt="csv").orderBy("net_sales").collect()
    assert [(r.sku, r.qty, str(r.net_sales), r.source_file, r.loaded_at) for r in rows] == [
        (None, None, "1.00", "sales_2024_01_02.csv", T0), ("A", 3, "12.50", "sales_2024_01_02.csv", T0),
    ]


def test_rows_of_a_wrong_type_are_kept_apart(spark, tmp_path):
    (tmp_path / "prices.csv").write_text(
        "A,NE,ONLINE,5.00,USD,2024-01-01,,SYS\nB,NE,ONLINE,five,USD,not-a-date,,SYS\nC,NE,ONLINE,,USD,2024-01-01,,SYS\n"
    )
    rows = tables.file_rows(spark, str(tmp_path), "stg_price_history", fmt="csv")
    bad = tables.malformed_rows(rows, "stg_price_history").collect()
    assert [(r.source_file, r.columns, '"price":"five"' in r.raw) for r in bad] == [("prices.csv", ["price", "effective_start"], True)]
    assert sorted(r.sku for r in tables.well_typed_rows(rows, "stg_price_history", T0).collect()) == ["A", "C"]
    counts = {r.column_name: r.row_count for r in type_violations(rows, "stg_price_history").collect()}
    assert counts == {"price": 1, "effective_start": 1, "effective_end": 0}


def test_the_stage_job_reloads_a_table_and_counts_what_it_kept_apart(spark, tmp_path):
    (tmp_path / "sales_2024_01_02.csv").write_text("2024-01-02,A,NE,ONLINE,3,12.50\n2024-13-02,A,NE,ONLINE,3,12.50\n")
    mart = jobs.Mart(spark, scratch_path(spark, "staged"))
    assert jobs.stage(mart, "stg_sales", str(tmp_path), "csv", T0) == 1
    assert [(r.sku, r.source_file) for r in mart.staging["stg_sales"].collect()] == [("A", "sales_2024_01_02.csv")]


def test_typed_scan_of_all_tables(spark):
    directory = scratch_path(spark, "typed")
    for name in tables.SCHEMAS:
        tables.empty_table(spark, name).write.parquet(f"{directory}/{name}")
    loaded = tables.load_mart(spark, directory)
    assert len(loaded) == 13
    assert all(df.schema == tables.SCHEMAS[name] for name, df in loaded.items())


def test_series(spark):
    assert [r.n for r in inline.number_series(spark, 3).orderBy("n").collect()] == [0, 1, 2]
    days = [r.as_of_date for r in inline.date_series(spark, "2024-03-01", 3).collect()]
    assert sorted(days) == [d("2024-02-28"), d("2024-02-29"), d("2024-03-01")]
    with pytest.raises(ValueError):
        inline.date_series(spark, "2024-3-1x", 3)


def test_generated_sales(spark):
    ids = spark.range(1, 3001)
    sales = generators.generate_sales(ids, AS_OF, T0)
    row = sales.agg(
        F.count("*"), F.min("sale_date"), F.max("sale_date"), F.min("qty"), F.max("qty"), F.countDistinct("sku"),
        F.countDistinct("region_code"), F.countDistinct("channel_code"),
    ).first()
    assert tuple(row) == (3000, AS_OF - dt.timedelta(days=60), AS_OF, 1, 100, 55, 6, 4)
    unit = sales.select((F.col("net_sales") / F.col("qty")).alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 10 <= unit[0] and unit[1] <= 509.99
    assert sales.exceptAll(generators.generate_sales(ids, AS_OF, T0)).count() == 0


def _dims(spark):
    return {n: tables.as_table(df, n) for n, df in inline.seed_dimensions(spark).items()}


def test_generated_prices_are_consecutive(spark):
    keys = generators.key_universe(_dims(spark))
    assert keys.count() == 55 * 6 * 4
    prices = generators.generate_price_history(keys, AS_OF, T0)
    w = Window.partitionBy(*X.KEY).orderBy("effective_start")
    linked = prices.withColumn("nx", F.lead("effective_start").over(w))
    assert linked.filter("nx IS NULL AND effective_end IS NOT NULL OR nx IS NOT NULL AND nx <> date_add(effective_end, 1)").count() == 0
    per_key = {r["count"] for r in prices.groupBy(*X.KEY).count().select("count").distinct().collect()}
    assert per_key == {1, 2, 3, 4}
    assert overlap_counts(prices, "effective_start", "effective_end", strict=False).count() == 0


def test_planted_bad_rows_meet_the_thresholds(spark):
    keys = generators.key_universe(_dims(spark))
    sales = generators.generate_sales(spark.range(1, 10_001), AS_OF, T0)
    prices = generators.generate_price_history(keys, AS_OF, T0)
    discounts = generators.generate_discounts(spark.range(1, 201), AS_OF, T0)
    bad = generators.bad_prices(prices, AS_OF, T0)
    assert bad.count() == 33
    late_prices, late_sales = generators.late_rows(keys, AS_OF, T0)
    staging = {
        "stg_sales": sales.unionByName(late_sales),
        "stg_price_history": prices.unionByName(bad).unionByName(late_prices),
        "stg_discount_events": discounts.unionByName(generators.bad_discounts(discounts, AS_OF, T0)),
    }
    profile = {r.measure: (r.actual, r.status) for r in staging_profile(staging).collect()}
    assert {status for _, status in profile.values()} == {"PASS"}
    assert profile["stg_sales"][0] == 10_005 and profile["stg_discount_events"][0] == 205
    assert profile["negative_price"][0] == 10 and profile["missing_sku"][0] == 12


def test_random_order_is_bounded(spark):
    assert generators.shuffled_rows(spark.range(100), 7, seed=3).count() == 7


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tariffmart import session

    class Cluster:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Fake:
        sparkContext = Cluster()
        conf = Conf(None)

    with pytest.raises(RuntimeError):
        session.scratch_root(Fake())
    Fake.conf = Conf("hdfs:///shared/")
    assert session.scratch_root(Fake()) == "hdfs:///shared/tariffmart-app"
