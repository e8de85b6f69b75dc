"""The registered queries: every operator applied to the mart of a folder of given tables.

Each takes a ``Workspace`` and returns a DataFrame. ``plain`` turns decimals into doubles and timestamps
into text at this boundary only, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmart.functions import expressions as X
from tariffmart.operators import dedup, intervals, merge, repair, surrogate, validate
from tariffmart.operators.overrides import price_changed, price_overrides
from tariffmart.plans import audit, lookups, overrides, quality, refresh, rewrite, store, views
from tariffmart.plans.workspace import Workspace, workspace
from tariffmart.schemas import CONTRACTS, DISCOUNT_COLUMNS, KEY, PRICE_COLUMNS, SALE_COLUMNS, SCHEMAS
from tariffmart.session import scratch_path, written
from tariffmart.sources import generators, given, inline, tables
from tariffmart.streaming import arrivals, late

AS_OF = given.AS_OF
LOADED_AT = given.LOADED_AT
SECOND = given.SECOND_LOAD_AT
YEAR = (AS_OF - dt.timedelta(days=365), AS_OF, AS_OF, "AS", "BUIL")
MONTH_START = AS_OF - dt.timedelta(days=30)
GRID_START = AS_OF - dt.timedelta(days=59)
PRICE_KEY_OUT = ["price_hist_id", *KEY, "effective_start", "effective_end"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, directory: plain(build(workspace(spark, directory)))
    return build


def _given(w: Workspace, name: str) -> DataFrame:
    return w.spark.read.parquet(f"{w.directory}/{name}.parquet")


def _ids(w: Workspace) -> DataFrame:
    return _given(w, "orders").select((F.col("o_orderkey") + 1).cast("long").alias("id"))


# --- sources ---------------------------------------------------------------------------------------


@query
def scan_tables(w: Workspace) -> DataFrame:
    directory = scratch_path(w.spark, "tables")
    rules = inline.seed_dimensions(w.spark)["dim_pricing_rule"]
    rules = surrogate.with_surrogate_key(rules, "rule_id", ["rule_name"])
    runs = w.loaded[0].runs()
    have = {**w.dims, **w.staging, **w.facts, "dim_pricing_rule": rules, "etl_run_history": runs}
    for name in SCHEMAS:
        df = tables.as_table(have[name], name) if name in have else tables.empty_table(w.spark, name)
        df.write.parquet(f"{directory}/{name}")
    return audit.row_counts(tables.load_mart(w.spark, directory))


@query
def stage_with_lineage(w: Workspace) -> DataFrame:
    """The staged sales written as one text file for each month, and staged again from there."""
    path = scratch_path(w.spark, "files")
    rows = w.staging["stg_sales"].select(*[f.name for f in tables.business_fields("stg_sales")])
    named = rows.withColumn("file", F.concat(F.lit("sales_"), F.date_format("sale_date", "yyyy_MM"), F.lit(".csv")))
    named.repartition("file").write.partitionBy("file").csv(path)
    return (
        tables.stage_files(w.spark, path, "stg_sales", LOADED_AT, fmt="csv")
        .groupBy("source_file", "loaded_at")
        .agg(F.count("*").alias("row_count"), F.sum("net_sales").alias("net_sales"))
    )


@query
def contract_check(w: Workspace) -> DataFrame:
    """Staged rows against the rules of their facts, and their text form, in which an amount below zero stands in
    brackets as bookkeepers write it, against the types."""
    parts = []
    for stage, fact in [
        ("stg_sales", "fact_sales"),
        ("stg_price_history", "fact_price_history"),
        ("stg_discount_events", "fact_discount_events"),
    ]:
        rows = w.staging[stage]
        text = rows.select(*[F.col(f.name).cast("string").alias(f.name) for f in tables.business_fields(stage)])
        if stage == "stg_price_history":
            text = text.withColumn("price", F.when(F.col("price").startswith("-"), F.format_string("(%s)", F.col("price").substr(2, 30))).otherwise(F.col("price")))
        for found in (validate.contract_violations(rows, CONTRACTS[fact]), validate.type_violations(text, stage)):
            parts.append(found.withColumn("table_name", F.lit(stage)))
    return reduce(DataFrame.unionByName, parts)


def _reports(w: Workspace) -> str:
    """A store with two reports, the newer one as of AS_OF."""
    path = scratch_path(w.spark, "reports")
    for day in (AS_OF - dt.timedelta(days=90), AS_OF):
        _, report = quality.report(w.facts, w.dims, day, dt.datetime(day.year, day.month, day.day))
        quality.write_report(report, path)
    return path


@query
def dq_report_read(w: Workspace) -> DataFrame:
    report = quality.latest_report(w.spark, _reports(w))
    return report.select("generated_at", "overall_status", F.explode("checks").alias("c")).select(
        "generated_at",
        "overall_status",
        F.col("c.name").alias("check_name"),
        F.col("c.status").alias("status"),
        F.col("c.count").alias("issue_count"),
    )


@query
def inline_rows(w: Workspace) -> DataFrame:
    units = inline.inline_rows(
        w.spark, [("PERCENT", "percent of price"), ("FLAT", "amount per unit")], "discount_type string, unit string"
    )
    return (
        w.staging["stg_discount_events"]
        .groupBy("discount_type")
        .agg(F.count("*").alias("row_count"))
        .join(units, "discount_type")
        .select("discount_type", "unit", "row_count")
    )


@query
def number_series(w: Workspace) -> DataFrame:
    per_day = w.facts["fact_sales"].groupBy("sale_date").agg(F.count("*").alias("sales"))
    back = inline.number_series(w.spark, 60).withColumn("sale_date", F.date_sub(X.day(AS_OF), F.col("n")))
    return back.join(per_day, "sale_date", "left").select("n", F.coalesce("sales", F.lit(0)).alias("sales"))


@query
def date_series(w: Workspace) -> DataFrame:
    per_day = w.facts["fact_sales"].groupBy(F.col("sale_date").alias("as_of_date")).agg(F.sum("qty").alias("qty"))
    return inline.date_series(w.spark, AS_OF).join(per_day, "as_of_date", "left").select(
        "as_of_date", F.coalesce("qty", F.lit(0)).alias("qty")
    )


@query
def gen_sales(w: Workspace) -> DataFrame:
    return generators.generate_sales(_ids(w), AS_OF, LOADED_AT).drop("loaded_at")


@query
def gen_price_history(w: Workspace) -> DataFrame:
    every_part = given.families(_given(w, "part")).select(
        given.family_sku("p_partkey").alias("sku"), F.lit(True).alias("is_active")
    )
    keys = generators.key_universe({**w.dims, "dim_product": every_part})
    rows = generators.generate_price_history(keys, AS_OF, LOADED_AT)
    return rows.groupBy("sku").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("effective_end").isNull()).alias("open_rows"),
        F.sum("price").alias("total_price"),
        F.min("effective_start").alias("first_start"),
        F.max("effective_start").alias("last_start"),
        F.sum(F.datediff("effective_end", "effective_start")).alias("closed_days"),
    )


@query
def gen_discounts(w: Workspace) -> DataFrame:
    return generators.generate_discounts(_ids(w), AS_OF, LOADED_AT).drop("loaded_at")


@query
def inject_bad_rows(w: Workspace) -> DataFrame:
    prices = generators.bad_prices(w.staging["stg_price_history"], AS_OF, LOADED_AT)
    discounts = generators.bad_discounts(w.staging["stg_discount_events"], AS_OF, LOADED_AT)
    return prices.select(
        F.lit("price").alias("kind"), *KEY, F.col("price").alias("amount"), F.col("source_system").alias("detail"),
        F.col("effective_start").alias("first_day"), F.col("effective_end").alias("last_day"),
    ).unionByName(
        discounts.select(
            F.lit("discount").alias("kind"), *KEY, F.col("discount_value").alias("amount"), F.col("discount_type").alias("detail"),
            F.col("start_date").alias("first_day"), F.col("end_date").alias("last_day"),
        )
    )


@query
def inject_late_rows(w: Workspace) -> DataFrame:
    prices, sales = generators.late_rows(generators.key_universe(w.dims), AS_OF, LOADED_AT)
    return prices.select(
        F.lit("price").alias("kind"), *KEY, F.col("effective_start").alias("on_date"), F.col("price").cast("double").alias("amount")
    ).unionByName(
        sales.select(
            F.lit("sale").alias("kind"), *KEY, F.col("sale_date").alias("on_date"), F.col("net_sales").cast("double").alias("amount")
        )
    )


# --- writes ----------------------------------------------------------------------------------------


@query
def staging_reload(w: Workspace) -> DataFrame:
    path = scratch_path(w.spark, "reload")
    staged = w.staging["stg_discount_events"]
    tables.reload_staging(staged.filter("discount_type = 'FLAT'"), path)
    tables.reload_staging(staged, path)
    stored = w.spark.read.schema(staged.schema).parquet(path)
    return stored.groupBy("discount_type").agg(
        F.count("*").alias("row_count"), F.sum("discount_value").alias("total_value")
    )


@query
def append_new(w: Workspace) -> DataFrame:
    path = scratch_path(w.spark, "append")
    facts = w.early_facts["fact_sales"]
    fresh = refresh.refresh_sales(w.loadable["stg_sales"], facts, SECOND)
    tables.append_rows(facts, path)
    tables.append_rows(fresh, path)
    stored = tables.load_table(w.spark, path, "fact_sales")
    return stored.groupBy("created_at").agg(F.count("*").alias("row_count"), F.max("sale_id").alias("last_id"))


@query
def upsert_dim(w: Workspace) -> DataFrame:
    source = given.families(_given(w, "part")).select(
        given.family_sku("p_partkey").alias("sku"),
        F.upper("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") <= 25, F.col("p_brand")).alias("brand"),
        (F.col("p_size") <= 40).alias("is_active"),
    )
    merged = merge.upsert(w.dims["dim_product"], source, ["sku"], ["product_name", "category", "brand", "is_active"])
    return merged.select(
        "sku", "product_name", "category", "brand", "is_active", F.col("created_at").isNotNull().alias("existed")
    )


@query
def update_from_join(w: Workspace) -> DataFrame:
    changes = repair.ranges_changed(w.unrepaired)
    return merge.update_from(w.unrepaired, changes, "price_hist_id", {"effective_end": "new_end"}).select(*PRICE_KEY_OUT)


@query
def surrogate_key(w: Workspace) -> DataFrame:
    return w.facts["fact_discount_events"].select("discount_event_id", *DISCOUNT_COLUMNS)


@query
def run_log(w: Workspace) -> DataFrame:
    return w.history[0].runs().select(
        "run_id",
        "status",
        "rows_loaded",
        "rows_rejected",
        F.col("finished_at").isNotNull().alias("finished"),
        F.col("failure_reason").isNotNull().alias("has_reason"),
    )


@query
def dq_report_write(w: Workspace) -> DataFrame:
    stored = w.spark.read.schema(quality.REPORT_SCHEMA).json(_reports(w))
    return stored.select("generated_at", "overall_status", F.explode("checks").alias("c")).select(
        "generated_at", "overall_status", F.col("c.name").alias("check_name"), F.col("c.count").alias("issue_count")
    )


@query
def atomic_publish(w: Workspace) -> DataFrame:
    now, after_failure = w.history[0].facts(), w.history[1]
    return audit.row_counts(after_failure).withColumn("seen", F.lit("after failed run")).unionByName(
        audit.row_counts(now).withColumn("seen", F.lit("after last run"))
    )


@query
def scratch_tables(w: Workspace) -> DataFrame:
    naive = written(rewrite.fan_out_report(w.facts, w.dims, *YEAR), "naive")
    tuned = written(rewrite.tuned_report(w.facts, *YEAR), "tuned")
    return naive.withColumn("form", F.lit("naive")).unionByName(tuned.withColumn("form", F.lit("tuned")))


# --- projections, filters, predicates --------------------------------------------------------------


@query
def project_alias(w: Workspace) -> DataFrame:
    return w.facts["fact_price_history"].select(*KEY, F.col("price").alias("current_price"), "currency", "effective_start")


@query
def required_not_null(w: Workspace) -> DataFrame:
    kept = validate.required_not_null(w.staging["stg_price_history"], [*KEY, "effective_start"])
    return kept.groupBy("region_code", "source_system").agg(F.count("*").alias("row_count"))


@query
def price_row_valid(w: Workspace) -> DataFrame:
    return validate.valid_price_rows(w.staging["stg_price_history"], w.dims["dim_product"]).select(*PRICE_COLUMNS)


@query
def price_row_rejected(w: Workspace) -> DataFrame:
    return validate.rejected_price_count(w.staging["stg_price_history"], w.dims["dim_product"])


@query
def reject_reasons(w: Workspace) -> DataFrame:
    return validate.reject_reasons(w.staging["stg_price_history"])


@query
def active_on_date(w: Workspace) -> DataFrame:
    return views.discount_active(w.facts["fact_discount_events"], AS_OF)


@query
def overlaps_range(w: Workspace) -> DataFrame:
    touching = intervals.overlaps("effective_start", "effective_end", "2001-01-01", "2001-03-31")
    return w.facts["fact_price_history"].filter(touching).select(*PRICE_KEY_OUT)


@query
def optional_filter(w: Workspace) -> DataFrame:
    prices = lookups.open_prices(w.facts["fact_price_history"])
    choices = [("none", None, None), ("region", "AS", None), ("channel", None, "BUIL"), ("both", "AS", "BUIL")]
    counts = [
        lookups.optional_equals(prices, region_code=region, channel_code=channel).agg(
            F.lit(label).alias("given"), F.count("*").alias("row_count")
        )
        for label, region, channel in choices
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query
def current_rows(w: Workspace) -> DataFrame:
    return lookups.open_prices(w.facts["fact_price_history"]).select("price_hist_id", *KEY, "price", "effective_start")


@query
def recent_window(w: Workspace) -> DataFrame:
    return w.facts["fact_sales"].filter(F.col("sale_date") >= X.day(MONTH_START)).select("sale_id", *SALE_COLUMNS)


@query
def string_date_between(w: Workspace) -> DataFrame:
    text = F.col("sale_date").cast("string")
    return (
        w.facts["fact_sales"]
        .filter(text.between(MONTH_START.isoformat(), AS_OF.isoformat()))
        .groupBy(text.alias("sale_day"))
        .agg(F.count("*").alias("row_count"))
    )


@query
def null_sentinel_equal(w: Workspace) -> DataFrame:
    old = w.unrepaired.select("price_hist_id", "source_system", F.col("effective_end").alias("old_end"))
    new = w.facts["fact_price_history"].select("price_hist_id", F.col("effective_end").alias("new_end"))
    return (
        old.join(new, "price_hist_id")
        .filter(dedup.same_end(F.col("old_end"), F.col("new_end")))
        .select("price_hist_id", "source_system", "new_end")
    )


@query
def null_wildcard_equal(w: Workspace) -> DataFrame:
    no_currency = F.when(F.col("source_system") == "PRICING_SYS", F.col("currency"))
    staged = w.unrepaired.withColumn("currency", no_currency)
    foreign = w.unrepaired.withColumn("currency", F.when(F.col("region_code") == "AS", "EUR").otherwise("USD"))
    return dedup.new_prices(staged, foreign).select(*PRICE_COLUMNS)


@query
def attr_differs(w: Workspace) -> DataFrame:
    return audit.spans_with_different_rows(w.staging["stg_discount_events"])


def _raised(w: Workspace) -> DataFrame:
    """The price history after somebody raised all late-loaded prices."""
    raised = F.when(F.col("source_system") == "LATE_LOAD_SYS", F.col("price") + F.lit("5.50").cast("decimal(18,4)"))
    return w.facts["fact_price_history"].withColumn("price", raised.otherwise(F.col("price")).cast("decimal(18,4)"))


@query
def value_changed(w: Workspace) -> DataFrame:
    before = w.facts["fact_price_history"].select("price_hist_id", F.col("price").alias("old_price"), "effective_end")
    after = _raised(w).select("price_hist_id", F.col("price").alias("new_price"))
    return before.join(after, "price_hist_id").filter(price_changed()).drop("effective_end")


@query
def active_products(w: Workspace) -> DataFrame:
    return w.dims["dim_product"].filter("is_active").select("sku", "product_name", "category", "brand")


# --- joins -----------------------------------------------------------------------------------------


@query
def dim_enrich(w: Workspace) -> DataFrame:
    return views.enrich_keys(views.recent_activity_keys(w.facts, AS_OF), w.dims)


@query
def bi_left_joins(w: Workspace) -> DataFrame:
    return (
        views.pricing_bi_dataset(w.facts, w.dims, AS_OF)
        .groupBy("as_of_date", "region_code")
        .agg(
            F.count("*").alias("grid_rows"),
            F.sum("dq_missing_price_flag").cast("long").alias("without_price"),
            F.count("active_discount_type").alias("with_discount"),
            F.sum("daily_sales_qty").alias("qty"),
            F.sum("daily_net_sales").alias("net_sales"),
        )
    )


@query
def date_key_grid(w: Workspace) -> DataFrame:
    keys = views.recent_activity_keys(w.facts, AS_OF)
    grid = keys.withColumn("as_of_date", F.explode(inline.last_days(AS_OF, 60)))
    return grid.groupBy("sku", "as_of_date").agg(F.count("*").alias("keys"))


@query
def price_as_of_daily(w: Workspace) -> DataFrame:
    return views.price_as_of_daily(w.facts["fact_price_history"], GRID_START, AS_OF)


@query
def discount_as_of_daily(w: Workspace) -> DataFrame:
    return views.discount_as_of_daily(w.facts["fact_discount_events"], GRID_START, AS_OF)


@query
def dedup_anti_sales(w: Workspace) -> DataFrame:
    return dedup.new_sales(w.loadable["stg_sales"], w.early_facts["fact_sales"])


@query
def dedup_anti_discounts(w: Workspace) -> DataFrame:
    untyped = F.when(F.col("sku") != "SKU-10010", F.col("discount_type"))
    staged = w.loadable["stg_discount_events"].withColumn("discount_type", untyped)
    facts = w.early_facts["fact_discount_events"].withColumn("discount_type", untyped)
    return dedup.new_discounts(staged, facts)


@query
def dedup_anti_prices(w: Workspace) -> DataFrame:
    valid = validate.valid_price_rows(w.staging["stg_price_history"], w.dims["dim_product"])
    return dedup.new_prices(valid, w.early_facts["fact_price_history"])


@query
def sku_exists(w: Workspace) -> DataFrame:
    sold = w.staging["stg_sales"].groupBy("sku").agg(F.count("*").alias("row_count"))
    known = validate.known_sku(sold, w.dims["dim_product"]).withColumn("known", F.lit(True))
    return known.unionByName(validate.unknown_sku(sold, w.dims["dim_product"]).withColumn("known", F.lit(False)))


@query
def orphan_facts(w: Workspace) -> DataFrame:
    return quality.orphan_facts(w.unchecked["fact_sales"], w.unchecked["fact_price_history"], w.dims)


@query
def orphan_rows(w: Workspace) -> DataFrame:
    return validate.orphan_rows(w.unchecked["fact_sales"], w.dims, "fact_sales", "sale_id").unionByName(
        validate.orphan_rows(w.unchecked["fact_price_history"], w.dims, "fact_price_history", "price_hist_id")
    )


@query
def fk_violations(w: Workspace) -> DataFrame:
    facts = {**w.unchecked, "fact_margin_impact": tables.empty_table(w.spark, "fact_margin_impact")}
    return validate.foreign_key_violations(facts, w.dims)


def _pairs(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pairs", F.col("pairs").cast("long"))


@query
def price_overlap_pairs(w: Workspace) -> DataFrame:
    return _pairs(intervals.overlap_counts(w.unrepaired, "effective_start", "effective_end", strict=True))


@query
def discount_overlap_pairs(w: Workspace) -> DataFrame:
    return _pairs(intervals.overlap_counts(w.facts["fact_discount_events"], "start_date", "end_date", strict=False))


@query
def staging_discount_overlaps(w: Workspace) -> DataFrame:
    return audit.staged_overlap_spans(w.staging["stg_discount_events"])


@query
def missing_price_coverage(w: Workspace) -> DataFrame:
    return quality.unpriced_keys(w.staging["stg_sales"], w.facts["fact_price_history"], AS_OF)


@query
def price_override_audit(w: Workspace) -> DataFrame:
    return price_overrides(w.facts["fact_price_history"], _raised(w), "pricing desk", SECOND).drop("reason")


@query
def sales_price_discount_naive(w: Workspace) -> DataFrame:
    return rewrite.fan_out_report(w.facts, w.dims, *YEAR)


@query
def sales_price_discount(w: Workspace) -> DataFrame:
    return rewrite.tuned_report(w.facts, *YEAR)


@query
def key_universe(w: Workspace) -> DataFrame:
    return generators.key_universe(w.dims)


@query
def repair_self_join(w: Workspace) -> DataFrame:
    return repair.repair_ranges(w.unrepaired).select("price_hist_id", "effective_end")


# --- aggregations and distinct ---------------------------------------------------------------------


@query
def sales_daily(w: Workspace) -> DataFrame:
    return views.sales_daily(w.facts["fact_sales"])


@query
def sales_30d_by_sku(w: Workspace) -> DataFrame:
    return rewrite.sales_by_sku(w.facts["fact_sales"], MONTH_START, AS_OF, "AS", "BUIL")


@query
def max_price_discount(w: Workspace) -> DataFrame:
    return rewrite.fan_out_report(w.facts, w.dims, *YEAR).select("sku", "current_price", "active_discount_value")


@query
def global_count(w: Workspace) -> DataFrame:
    return w.staging["stg_price_history"].agg(
        F.count("*").alias("row_count"), F.count_if(F.col("price") < 0).alias("negative_rows")
    )


@query
def distinct_key_count(w: Workspace) -> DataFrame:
    sales = w.unchecked["fact_sales"].agg(F.countDistinct(X.key_text()).alias("key_count"))
    prices = w.staging["stg_price_history"].agg(F.countDistinct(X.key_text()).alias("key_count"))
    return sales.withColumn("table_name", F.lit("sales")).unionByName(prices.withColumn("table_name", F.lit("prices")))


@query
def row_distinct(w: Workspace) -> DataFrame:
    return dedup.distinct_rows(w.staging["stg_price_history"], PRICE_COLUMNS)


@query
def table_row_counts(w: Workspace) -> DataFrame:
    return audit.row_counts({**w.staging, **w.facts})


@query
def volume_thresholds(w: Workspace) -> DataFrame:
    measures = audit.row_counts(w.staging).select(F.col("table_name").alias("measure"), F.col("row_count").alias("actual"))
    return audit.against_thresholds(measures, {n: audit.THRESHOLDS[n] for n in refresh.STAGING})


@query
def pk_duplicates(w: Workspace) -> DataFrame:
    lines = _given(w, "lineitem").select(F.concat_ws("|", "l_orderkey", "l_linenumber").alias("line"))
    found = validate.duplicate_keys(lines, "line").withColumn("table_name", F.lit("lineitem"))
    for name, key in [("fact_sales", "sale_id"), ("fact_price_history", "price_hist_id")]:
        found = found.unionByName(validate.duplicate_keys(w.facts[name], key).withColumn("table_name", F.lit(name)))
    return found


@query
def run_totals(w: Workspace) -> DataFrame:
    loaded = audit.row_counts(w.loaded[1].new_rows).agg(F.sum("row_count").alias("rows_loaded"))
    rejected = validate.rejected_price_count(w.staging["stg_price_history"], w.dims["dim_product"])
    return loaded.select("rows_loaded", rejected.scalar().alias("rows_rejected"))


# --- windows ---------------------------------------------------------------------------------------


@query
def top_price_per_day(w: Workspace) -> DataFrame:
    return views.price_as_of_daily(w.unrepaired, MONTH_START, AS_OF)


@query
def top_discount_per_day(w: Workspace) -> DataFrame:
    return views.discount_as_of_daily(w.facts["fact_discount_events"], AS_OF - dt.timedelta(days=365), AS_OF)


@query
def top_price_per_sku(w: Workspace) -> DataFrame:
    return rewrite.top_price_per_sku(w.unrepaired, AS_OF, "AS", "BUIL")


@query
def top_discount_per_sku(w: Workspace) -> DataFrame:
    return rewrite.top_discount_per_sku(w.facts["fact_discount_events"], dt.date(2001, 3, 1), "AS", "BUIL")


@query
def next_effective_start(w: Workspace) -> DataFrame:
    return repair.with_next_start(w.unrepaired).select("price_hist_id", *KEY, "effective_start", "next_effective_start")


@query
def repair_effective_ranges(w: Workspace) -> DataFrame:
    return repair.repair_ranges(w.unrepaired).select(*PRICE_KEY_OUT, "price")


@query
def ranges_changed(w: Workspace) -> DataFrame:
    return repair.ranges_changed(w.unrepaired)


# --- sorts, limits, top-k --------------------------------------------------------------------------


@query
def current_price(w: Workspace) -> DataFrame:
    return lookups.current_price(w.facts["fact_price_history"], "SKU-10007", "AS", "BUIL")


@query
def current_price_all(w: Workspace) -> DataFrame:
    return lookups.current_price_all(w.facts["fact_price_history"])


@query
def price_history(w: Workspace) -> DataFrame:
    return lookups.price_history(w.facts["fact_price_history"], "SKU-10007", "2000-01-01", "2001-06-30", region_code="AS")


@query
def bi_snapshot(w: Workspace) -> DataFrame:
    return lookups.bi_snapshot(w.facts, w.dims, AS_OF, "2001-07-20", "AS", "BUIL", limit=50)


@query
def etl_runs(w: Workspace) -> DataFrame:
    return store.recent_runs(w.history[0].runs()).drop("failure_reason")


@query
def latest_run(w: Workspace) -> DataFrame:
    return store.latest_run(w.history[0].runs())


@query
def sample_rows(w: Workspace) -> DataFrame:
    prices = intervals.overlap_witnesses(w.unrepaired, "price_hist_id", "effective_start", "effective_end", strict=True)
    discounts = intervals.overlap_witnesses(
        w.facts["fact_discount_events"], "discount_event_id", "start_date", "end_date", strict=False
    )
    top = lambda rows, label: (
        rows.orderBy("second_id", "first_id").limit(5).select(F.lit(label).alias("check_name"), *KEY, "first_id", "second_id")
    )
    unpriced = quality.unpriced_keys(w.staging["stg_sales"], w.facts["fact_price_history"], AS_OF).orderBy(*KEY).limit(5)
    no_id = F.lit(None).cast("long")
    return (
        top(prices, "price overlap")
        .unionByName(top(discounts, "discount overlap"))
        .unionByName(unpriced.select(F.lit("no price").alias("check_name"), *KEY, no_id.alias("first_id"), no_id.alias("second_id")))
    )


@query
def random_sample(w: Workspace) -> DataFrame:
    return generators.random_rows(w.facts["fact_price_history"].select("price_hist_id", *KEY, "price"), 20, ["price_hist_id"])


@query
def override_log_tail(w: Workspace) -> DataFrame:
    changes = price_overrides(w.facts["fact_price_history"], _raised(w), "pricing desk", SECOND)
    log = overrides.append_to_audit(tables.empty_table(w.spark, "price_override_audit"), changes)
    return overrides.audit_tail(log).drop("reason")


# --- set operations --------------------------------------------------------------------------------


@query
def recent_activity_keys(w: Workspace) -> DataFrame:
    return views.recent_activity_keys(w.facts, AS_OF)


@query
def union_all(w: Workspace) -> DataFrame:
    rows = None
    for name, df in w.staging.items():
        part = df.select(F.lit(name).alias("table_name"), "region_code")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("table_name", "region_code").agg(F.count("*").alias("row_count"))


@query
def result_diff(w: Workspace) -> DataFrame:
    columns = [*KEY, "effective_start", "effective_end"]
    return merge.row_differences(w.unrepaired.select(*columns), w.facts["fact_price_history"].select(*columns))


# --- scalar functions ------------------------------------------------------------------------------


@query
def scalar_functions(w: Workspace) -> DataFrame:
    d, price = F.col("effective_start"), F.col("price")
    number = F.expr("try_cast(substring(sku, 5) AS INT)")
    return (
        w.staging["stg_price_history"]
        .select(*PRICE_COLUMNS)
        .distinct()
        .select(
            X.key_text().alias("key_text"),
            F.date_add(d, 7).alias("week_later"),
            F.date_sub(d, 30).alias("month_before"),
            d.cast("string").alias("start_text"),
            (price / 100).cast("decimal(18,4)").alias("hundredth"),
            (price * F.lit("1.10").cast("decimal(9,2)")).cast("decimal(18,2)").alias("raised"),
            X.end_or_open("effective_end").alias("end_or_open"),
            F.when(price < 0, "negative").when(price < 20000, "low").otherwise("high").alias("band"),
            X.is_blank("sku").alias("blank_sku"),
            F.concat(F.col("region_code"), F.lit("-"), F.col("channel_code")).alias("place"),
            X.sku_label(F.coalesce(number - 10000, F.lit(0))).alias("label"),
            F.date_format(d, "yyyy_MM_dd").alias("file_day"),
            F.abs(price).alias("magnitude"),
            (-price).alias("negated"),
            F.pmod(number, F.lit(7)).alias("remainder"),
            number.alias("sku_number"),
            d.between(F.lit("2000-01-01").cast("date"), F.lit("2000-12-31").cast("date")).alias("in_2000"),
            (F.coalesce("sku", F.lit("")) != "SKU-10007").alias("other_sku"),
            F.col("effective_end").isNull().alias("is_open"),
        )
    )


# --- compositions ----------------------------------------------------------------------------------


@query
def refresh_sales(w: Workspace) -> DataFrame:
    return refresh.refresh_sales(w.loadable["stg_sales"], w.early_facts["fact_sales"], SECOND)


@query
def refresh_discounts(w: Workspace) -> DataFrame:
    return refresh.refresh_discounts(w.loadable["stg_discount_events"], w.early_facts["fact_discount_events"], SECOND)


@query
def refresh_prices(w: Workspace) -> DataFrame:
    return refresh.refresh_prices(
        w.staging["stg_price_history"], w.early_facts["fact_price_history"], w.dims["dim_product"], SECOND
    )


@query
def refresh_mart(w: Workspace) -> DataFrame:
    mart = w.fresh_store()
    mart.refresh(w.loadable, w.dims, LOADED_AT)
    return store.latest_run(mart.runs()).select("run_id", "status", "rows_loaded", "rows_rejected")


@query
def pricing_bi_dataset(w: Workspace) -> DataFrame:
    return views.pricing_bi_dataset(w.facts, w.dims, AS_OF)


@query
def dq_suite(w: Workspace) -> DataFrame:
    return quality.run_checks(w.facts, w.dims, AS_OF)


@query
def negative_prices(w: Workspace) -> DataFrame:
    return quality.negative_prices(w.staging["stg_price_history"])


@query
def staging_profile(w: Workspace) -> DataFrame:
    return audit.staging_profile(w.staging)


@query
def fact_sanity(w: Workspace) -> DataFrame:
    return audit.fact_sanity({**w.facts, "fact_price_history": w.unrepaired})


@query
def verify_rewrite(w: Workspace) -> DataFrame:
    return rewrite.verify_rewrite(rewrite.fan_out_report(w.facts, w.dims, *YEAR), rewrite.tuned_report(w.facts, *YEAR))


@query
def mart_audit(w: Workspace) -> DataFrame:
    checks = quality.run_checks(w.facts, w.dims, AS_OF)
    return audit.mart_audit(w.staging, w.history[0].runs(), checks)


@query
def override_demo(w: Workspace) -> DataFrame:
    return overrides.override_demo(w.facts["fact_price_history"], "pricing desk", SECOND).drop("reason")


@query
def override_defaults(w: Workspace) -> DataFrame:
    """The log of changed prices with the session's user and clock."""
    log = price_overrides(w.facts["fact_price_history"], _raised(w))
    return log.select(
        "price_hist_id",
        F.typeof("changed_by").alias("by_type"),
        (F.length("changed_by") > 0).alias("by_known"),
        F.typeof("changed_at").alias("at_type"),
        F.col("changed_at").isNotNull().alias("at_known"),
    )


# --- late arrivals ---------------------------------------------------------------------------------


@query
def late_arrivals(w: Workspace) -> DataFrame:
    prices = late.late_arrivals(w.staging["stg_price_history"], "effective_start")
    sales = late.late_arrivals(w.staging["stg_sales"], "sale_date")
    return prices.select(
        F.lit("price").alias("kind"), *KEY, F.col("effective_start").alias("on_date"), F.col("price").cast("double").alias("amount"), "days_late"
    ).unionByName(
        sales.select(F.lit("sale").alias("kind"), *KEY, F.col("sale_date").alias("on_date"), F.col("net_sales").cast("double").alias("amount"), "days_late")
    )


@query
def late_repair(w: Workspace) -> DataFrame:
    late_rows = F.col("source_system") == "LATE_LOAD_SYS"
    return late.late_repair(w.unrepaired.filter(~late_rows), w.unrepaired.filter(late_rows))


@query
def stream_refresh(w: Workspace) -> DataFrame:
    """Staged prices that arrive in three drops of files, the one between the others last, each loaded by the stream."""
    store_ = w.fresh_store()
    folder, checkpoint = scratch_path(w.spark, "arrivals"), scratch_path(w.spark, "stream")
    begins, second, third = F.col("effective_start"), F.lit(dt.date(1996, 1, 1)), F.lit(dt.date(1999, 1, 1))
    for arrived in (begins.isNull() | (begins < second), begins >= third, (begins >= second) & (begins < third)):
        tables.append_rows(w.staging["stg_price_history"].filter(arrived), f"{folder}/stg_price_history")
        arrivals.stream_refresh(store_, lambda: w.dims, folder, checkpoint, "stg_price_history").awaitTermination()
    return store_.table("fact_price_history").groupBy("region_code", "channel_code").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("effective_end").isNull()).alias("open_rows"),
        F.sum("price").alias("total_price"),
        F.sum(F.datediff("effective_end", "effective_start")).alias("closed_days"),
        F.bool_and(F.col("created_at").isNotNull()).alias("stamped"),
    )
