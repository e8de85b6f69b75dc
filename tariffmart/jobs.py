"""Batch jobs on a mart folder, for spark-submit:

    python -m tariffmart.jobs seed|stage|inject-late|refresh|check|audit|history --mart FOLDER [--as-of yyyy-mm-dd]

``check`` ends with 2 if a critical quality check fails, ``audit`` if any section fails, ``refresh`` with 1 on error.
The session comes from spark-submit; without one a local session is started.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmart.functions.expressions import as_date, moment
from tariffmart.operators.merge import upsert
from tariffmart.operators.surrogate import highest_id, with_surrogate_key
from tariffmart.plans import audit, quality
from tariffmart.plans.refresh import STAGING
from tariffmart.plans.store import MartStore, Refresh, recent_runs
from tariffmart.session import written
from tariffmart.sources import generators, inline
from tariffmart.sources.tables import append_rows, as_table, empty_table, file_rows, load_table, malformed_rows, reload_staging, well_typed_rows

DIMENSIONS = {
    "dim_product": (["sku"], ["product_name", "category", "brand", "is_active"]),
    "dim_region": (["region_code"], ["region_name"]),
    "dim_channel": (["channel_code"], ["channel_name"]),
    "dim_pricing_rule": (["rule_name"], ["rule_type", "priority", "start_date", "end_date", "is_active"]),
}


class Mart:
    """Dimensions, staging, facts and reports below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.store = MartStore(spark, f"{self.root}/facts")
        for name in [*STAGING, *DIMENSIONS]:
            empty_table(spark, name).write.mode("ignore").parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def store_dimension(self, name: str, rows: DataFrame) -> None:
        """Replace a dimension. The new rows are complete in a scratch table before the old ones go."""
        written(rows, name).write.mode("overwrite").parquet(self.path(name))

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    def table(self, name: str) -> DataFrame:
        return load_table(self.spark, self.path(name), name)

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in DIMENSIONS}

    @property
    def staging(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in STAGING}


def merge_dimension(mart: Mart, name: str, source: DataFrame, loaded_at: dt.datetime) -> None:
    """Upsert rows into a stored dimension; new products get their creation time, new rules their id."""
    keys, columns = DIMENSIONS[name]
    stored = mart.table(name)
    merged = upsert(stored, source, keys, columns)
    if name == "dim_product":
        merged = merged.withColumn("created_at", F.coalesce("created_at", moment(loaded_at)))
    if name == "dim_pricing_rule":
        old, new = merged.filter("rule_id IS NOT NULL"), merged.filter("rule_id IS NULL").drop("rule_id")
        numbered = with_surrogate_key(new, "rule_id", keys, highest_id(stored, "rule_id"))
        merged = old.unionByName(as_table(numbered, name))
    mart.store_dimension(name, as_table(merged, name))


def seed(mart: Mart, as_of: dt.date, loaded_at: dt.datetime, sales: int = 10_000, discounts: int = 200) -> None:
    """Merge the seed dimensions and reload staging with generated rows, planted bad rows included."""
    for name, source in inline.seed_dimensions(mart.spark).items():
        merge_dimension(mart, name, source, loaded_at)
    ids = lambda n: mart.spark.range(1, n + 1)
    prices = generators.generate_price_history(generators.key_universe(mart.dims, active_only=False), as_of, loaded_at)
    events = generators.generate_discounts(ids(discounts), as_of, loaded_at)
    rows = {
        "stg_sales": generators.generate_sales(ids(sales), as_of, loaded_at),
        "stg_price_history": prices.unionByName(generators.bad_prices(prices, as_of, loaded_at)),
        "stg_discount_events": events.unionByName(generators.bad_discounts(events, as_of, loaded_at)),
    }
    for name, df in rows.items():
        reload_staging(as_table(df, name), mart.path(name))


def stage(mart: Mart, name: str, path: str, fmt: str, loaded_at: dt.datetime, **options: str) -> int:
    """Reload a staging table from files; rows with a value of a wrong type are kept apart. Their number."""
    rows = file_rows(mart.spark, path, name, fmt, **options)
    malformed = f"{mart.root}/malformed/{name}"
    found = reload_staging(malformed_rows(rows, name), malformed)
    reload_staging(well_typed_rows(rows, name, loaded_at), mart.path(name))
    return found


def inject_late(mart: Mart, as_of: dt.date, loaded_at: dt.datetime) -> None:
    """Append late prices and sales of five keys to staging."""
    prices, sales = generators.late_rows(generators.key_universe(mart.dims), as_of, loaded_at)
    append_rows(as_table(prices, "stg_price_history"), mart.path("stg_price_history"))
    append_rows(as_table(sales, "stg_sales"), mart.path("stg_sales"))


def refresh(mart: Mart, loaded_at: dt.datetime | None = None, idempotent: bool = False) -> Refresh:
    """Load staging into the facts and publish."""
    return mart.store.refresh(mart.staging, mart.dims, loaded_at, idempotent)


def check(mart: Mart, as_of: dt.date, generated_at: dt.datetime) -> DataFrame:
    """Run the quality checks once and append their report; the result holds the checks."""
    checks, report = quality.report(mart.store.facts(), mart.dims, as_of, generated_at)
    quality.write_report(report, mart.reports)
    return checks


def audit_all(mart: Mart, as_of: dt.date) -> DataFrame:
    """Sections of the audit over stored staging, runs and facts."""
    facts = mart.store.facts()
    return audit.mart_audit(mart.staging, mart.store.runs(), quality.run_checks(facts, mart.dims, as_of))


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("job", choices=["seed", "stage", "inject-late", "refresh", "check", "audit", "history"])
    parser.add_argument("--mart", required=True, help="folder that all executors share")
    parser.add_argument("--as-of", type=as_date, default=dt.date.today())
    parser.add_argument("--sales", type=int, default=10_000, help="number of generated sales")
    parser.add_argument("--table", choices=STAGING, help="staging table to reload from --files")
    parser.add_argument("--files", help="folder or file to stage")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--idempotent", action="store_true", help="a reload of the same staging adds nothing")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"tariffmart {options.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    mart = Mart(spark, options.mart)
    if options.job == "seed":
        seed(mart, options.as_of, now, options.sales)
    elif options.job == "stage":
        header = {"header": "true"} if options.format == "csv" else {}
        print(f"malformed {stage(mart, options.table, options.files, options.format, now, **header)}")
    elif options.job == "inject-late":
        inject_late(mart, options.as_of, now)
    elif options.job == "refresh":
        try:
            result = refresh(mart, idempotent=options.idempotent)
        except Exception as error:  # noqa: BLE001
            print(f"refresh failed: {error}", file=sys.stderr)
            return 1
        print(f"loaded {result.rows_loaded}, rejected {result.rows_rejected}")
    elif options.job == "check":
        checks = check(mart, options.as_of, now)
        checks.orderBy("check_no").show(truncate=False)
        try:
            quality.enforce(checks)
        except quality.QualityGateFailed as failed:
            print(f"critical checks failed: {failed}", file=sys.stderr)
            return 2
    elif options.job == "audit":
        sections = {row.section: row.status for row in audit_all(mart, options.as_of).collect()}
        for section, status in sections.items():
            print(f"[{status}] {section}")
        return 0 if sections["OVERALL"] == "PASS" else 2
    else:
        recent_runs(mart.store.runs()).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
