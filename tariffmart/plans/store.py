"""A mart on shared storage with all-or-nothing refreshes, and its run log.

A fact table is a partitioned Parquet table by run and month: sales and discounts by month of their date, closed prices
by month of their end, open prices under a name of their own. A run writes below its own folder and never into what
others read: new sales and discounts, and of prices each month that holds a row the repair changed, whole. Its SUCCESS
row in the log tells how many rows it added and which months of prices it wrote. That row is one file and appended last,
so it publishes everything at once; a failed run leaves a folder that nobody reads, and a FAILED row. Readers filter the
partitions by the successful runs, prices by the last of them for each month. One refresh of a mart runs at a time; that
is the scheduler's to see to.
"""

from __future__ import annotations

import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmart.functions.expressions import month
from tariffmart.operators.dedup import staged_months
from tariffmart.operators.repair import repair_all
from tariffmart.operators.top import first_per_group
from tariffmart.plans.refresh import FACTS, Load, check_load, load_staging
from tariffmart.schemas import KEY, PRIMARY_KEYS, SCHEMAS
from tariffmart.session import written
from tariffmart.sources.tables import append_rows, empty_table

PIPELINE = "pricing_refresh"

OPEN = "open"
DATE_OF = {"fact_sales": "sale_date", "fact_discount_events": "start_date"}
STAGED = {"fact_sales": "stg_sales", "fact_discount_events": "stg_discount_events"}
PARTS = ["run_id", "month"]

# A load of at least one price for so many stored ones is met by all of them and writes all months anew: most keys change,
# and looking for the others would move every row more often than writing them does.
STORED_A_NEW_ROW = 4

# Order of the states of one run.
STATE_ORDER = {"RUNNING": 1, "FAILED": 2, "SUCCESS": 2}


@dataclass
class Refresh:
    """Outcome of a published refresh."""

    run_id: int
    new_rows: dict[str, DataFrame]
    rows_loaded: int
    rows_rejected: int


@dataclass
class Published:
    """What readers see: the successful runs, the run that wrote each month of prices last, and the last ids."""

    runs: list[int]
    price_runs: dict[str, int]
    last_ids: dict[str, int]


class MartStore:
    """Facts and run log below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._log_schema = T.StructType(
            [
                *SCHEMAS["etl_run_history"].fields,
                T.StructField("loaded", T.MapType(T.StringType(), T.LongType())),
                T.StructField("price_months", T.ArrayType(T.StringType())),
                T.StructField("batch", T.StringType()),
            ]
        )
        spark.createDataFrame([], self._log_schema).write.mode("ignore").parquet(f"{root}/etl_run_history")
        for name in FACTS:
            spark.createDataFrame([], _stored(name)).write.mode("ignore").partitionBy(*PARTS).parquet(f"{root}/{name}")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(self._log_schema).parquet(f"{self.root}/etl_run_history")

    def states(self) -> DataFrame:
        """All logged states, up to two per run."""
        return self._log().select(*SCHEMAS["etl_run_history"].names)

    def runs(self) -> DataFrame:
        """The latest state of each run."""
        order = F.coalesce(*[F.when(F.col("status") == s, F.lit(n)) for s, n in STATE_ORDER.items()])
        return first_per_group(self.states(), ["run_id"], [order.desc()])

    def log(
        self,
        run_id: int,
        status: str,
        started_at: dt.datetime,
        finished_at: dt.datetime | None = None,
        rows_rejected: int = 0,
        failure_reason: str | None = None,
        loaded: dict[str, int] | None = None,
        price_months: list[str] | None = None,
        batch: str | None = None,
    ) -> None:
        """Append one state of a run."""
        # Times go in as text, which reads in the session time zone like every other timestamp here.
        times = [None if t is None else t.isoformat(sep=" ") for t in (started_at, finished_at)]
        rows = sum((loaded or {}).values())
        row = (run_id, PIPELINE, *times, status, rows, rows_rejected, failure_reason, loaded, price_months, batch)
        text = (
            "run_id long, pipeline_name string, started_at string, finished_at string, status string, rows_loaded long,"
            " rows_rejected long, failure_reason string, loaded map<string, long>, price_months array<string>, batch string"
        )
        given = self.spark.createDataFrame([row], text)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._log_schema]
        append_rows(given.select(*typed).coalesce(1), f"{self.root}/etl_run_history")

    def published(self) -> Published:
        """The state of the last successful run, from one small row a run."""
        rows = self._log().filter("status = 'SUCCESS'").select("run_id", "loaded", "price_months").orderBy("run_id").collect()
        prices = {month: row.run_id for row in rows for month in row.price_months or []}
        return Published([row.run_id for row in rows], prices, {name: sum(row.loaded.get(name, 0) for row in rows) for name in FACTS})

    def table(self, name: str) -> DataFrame:
        """A fact table as of the last successful run."""
        return self._table(name, self.published())

    def facts(self) -> dict[str, DataFrame]:
        """All facts as of the same, last successful run."""
        published = self.published()
        return {name: self._table(name, published) for name in FACTS}

    def _table(self, name: str, published: Published, months: list[str] | None = None) -> DataFrame:
        """A fact table, or what it holds of some months: filters on its folders, which Spark lists and prunes."""
        rows = self.spark.read.schema(_stored(name)).parquet(f"{self.root}/{name}")
        if months is not None:
            rows = rows.filter(F.col("month").isin(months))
        if name != "fact_price_history":
            return rows.filter(F.col("run_id").isin(published.runs)).drop(*PARTS)
        rows = rows.filter(F.concat_ws("/", "month", "run_id").isin([f"{month}/{run}" for month, run in published.price_runs.items()]))
        # Stating what each part holds lets filters on the end prune files.
        opened = rows.filter(F.col("month") == OPEN).withColumn("effective_end", F.lit(None).cast("date"))
        closed = rows.filter((F.col("month") != OPEN) & F.col("effective_end").isNotNull())
        return opened.unionByName(closed).drop(*PARTS)

    def _write(self, name: str, rows: DataFrame, run_id: int) -> None:
        """Write rows that carry their ``month`` below the folder of a run. Adaptive execution sizes the files; rows of a
        file lie by month and key. New sales are numbered by date, so they lie by month already and do not move."""
        placed = rows if name == "fact_sales" else rows.hint("rebalance", F.col("month"))
        ordered = placed.sortWithinPartitions("month", *KEY, PRIMARY_KEYS[name])
        ordered.write.mode("overwrite").partitionBy("month").parquet(f"{self.root}/{name}/run_id={run_id}")

    def _write_prices(self, changed: DataFrame, published: Published, run_id: int) -> list[str]:
        """Write anew the months that a changed or new price leaves or enters, and name them; others stay where they are."""
        name = "fact_price_history"
        of = lambda end: F.coalesce(month(end), F.lit(OPEN))
        changed = written(changed.withColumn("month", of("effective_end")).withColumn("left", F.when(~F.col("is_new"), of("old_end"))), "changed")
        touched = sorted(r[0] for r in changed.select(F.explode(F.array("month", "left")).alias("m")).distinct().collect() if r[0])
        if touched:
            kept = self._table(name, published, touched).join(changed.select("price_hist_id"), "price_hist_id", "left_anti")
            columns = [*SCHEMAS[name].names, "month"]
            rows = kept.withColumn("month", of("effective_end")).select(*columns).unionByName(changed.select(*columns))
            self._write(name, rows, run_id)
        return touched

    def _rewrite_prices(self, added: DataFrame, published: Published, run_id: int) -> list[str]:
        """Write all months anew from stored and new prices, and name them, those that are empty now included."""
        name = "fact_price_history"
        rows = repair_all(self._table(name, published).unionByName(added))
        self._write(name, rows.withColumn("month", F.coalesce(month("effective_end"), F.lit(OPEN))), run_id)
        stored = T.StructType([f for f in _stored(name).fields if f.name != "run_id"])
        files = self.spark.read.schema(stored).parquet(f"{self.root}/{name}/run_id={run_id}").inputFiles()
        return sorted({re.search(r"/month=([^/]+)/", file)[1] for file in files} | set(published.price_runs))

    def _store(self, load: Load, loaded: dict[str, int], published: Published, run_id: int) -> list[str]:
        """Write what a run adds or changes; nothing reads it until the run is logged as SUCCESS. The months of prices."""
        name = "fact_price_history"
        write = partial(self._write_prices, load.changed_prices)
        if loaded.get(name, 0) > 0 and published.last_ids[name] <= STORED_A_NEW_ROW * loaded[name]:
            write = partial(self._rewrite_prices, load.new_rows[name])
        with ThreadPoolExecutor(max_workers=3) as jobs:
            added = [
                jobs.submit(self._write, name, load.new_rows[name].withColumn("month", month(date)), run_id)
                for name, date in DATE_OF.items()
                if name in load.new_rows
            ]
            prices = jobs.submit(write, published, run_id) if load.changed_prices is not None else None
            for job in added:
                job.result()
            return prices.result() if prices else []

    def _met_by(self, staging: dict[str, DataFrame], published: Published) -> dict[str, DataFrame]:
        """The facts that staged rows can equal or move: their months of sales and discounts, their keys of prices, or all
        prices if there are too many staged rows for that to leave out much."""
        facts = {}
        for name, date in DATE_OF.items():
            if STAGED[name] in staging:
                known = published.last_ids[name] > 0
                facts[name] = self._table(name, published, staged_months(staging[STAGED[name]], date) if known else [])
        if "stg_price_history" in staging:
            prices, staged = self._table("fact_price_history", published), staging["stg_price_history"]
            known = published.last_ids["fact_price_history"]
            if known and known > STORED_A_NEW_ROW * staged.count():
                prices = prices.join(staged.select(*KEY).distinct(), KEY, "left_semi").select(*prices.columns)
            facts["fact_price_history"] = prices
        return facts

    def refresh(
        self,
        staging: dict[str, DataFrame],
        dims: dict[str, DataFrame],
        loaded_at: dt.datetime | None = None,
        idempotent: bool = False,
        batch: str | None = None,
    ) -> Refresh:
        """Run a refresh of the tables in ``staging`` and publish it; on any error log FAILED with the reason and raise.

        The constraint checks run on the numbered rows before these are stored, so a load that breaks one stores nothing
        and repairs nothing. A ``batch`` that a successful run has loaded before is not loaded again.
        """
        started = loaded_at or _now()
        log = self._log()
        if batch is not None and (done := log.filter("status = 'SUCCESS'").filter(F.col("batch") == batch).first()):
            return Refresh(done.run_id, {name: empty_table(self.spark, name) for name in FACTS}, 0, 0)
        run_id = (log.agg(F.max("run_id")).first()[0] or 0) + 1
        self.log(run_id, "RUNNING", started, batch=batch)
        try:
            published = self.published()
            load = load_staging(staging, self._met_by(staging, published), dims["dim_product"], started, published.last_ids, idempotent)
            loaded = check_load(load.new_rows, dims)
            price_months = self._store(load, loaded, published, run_id)
        except Exception as error:
            self.log(run_id, "FAILED", started, loaded_at or _now(), failure_reason=f"{type(error).__name__}: {error}", batch=batch)
            raise
        self.log(run_id, "SUCCESS", started, loaded_at or _now(), load.rows_rejected, None, loaded, price_months, batch)
        return Refresh(run_id, load.new_rows, sum(loaded.values()), load.rows_rejected)


def _stored(name: str) -> T.StructType:
    """The columns of a fact table as stored: its own and the folders that hold them."""
    return T.StructType([*SCHEMAS[name].fields, T.StructField("run_id", T.LongType()), T.StructField("month", T.StringType())])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def latest_run(runs: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    """The newest run of the pipeline."""
    return (
        runs.filter(F.col("pipeline_name") == pipeline)
        .orderBy(F.col("run_id").desc())
        .limit(1)
        .select("run_id", "started_at", "finished_at", "status", "rows_loaded", "rows_rejected", "failure_reason")
    )


def recent_runs(runs: DataFrame, n: int = 50, pipeline: str = PIPELINE) -> DataFrame:
    """The last n runs of the pipeline, newest first."""
    return (
        runs.filter(F.col("pipeline_name") == pipeline)
        .orderBy(F.col("run_id").desc())
        .limit(n)
        .select(*SCHEMAS["etl_run_history"].names)
    )
