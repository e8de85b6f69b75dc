"""The stored mart behind the registered queries: staging derived from the given tables, and its refreshes.

Like the database it stands for, the mart is loaded once and then queried. It lives in the shared scratch
folder of the session and is rebuilt for every application and whenever the given files change. A query pays only for
the tables it reads: order lines move and are written once, the staging tables are views of them, and a fact table is
loaded when first asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffmart.operators.validate import known_sku
from tariffmart.plans.refresh import FACTS, STAGING, LoadRejected, append_prices, refresh_discounts, refresh_sales
from tariffmart.plans.store import MartStore, Refresh
from tariffmart.session import scratch_path, written
from tariffmart.sources import given
from tariffmart.sources.tables import empty_table

STAGE_OF = dict(zip(FACTS, STAGING, strict=True))
DATE_OF = {
    "stg_sales": "sale_date",
    "stg_price_history": "effective_start",
    "stg_discount_events": "start_date",
}


class Tables(Mapping):
    """Fact tables by name, each made when first asked for."""

    def __init__(self, make: Callable[[str], DataFrame]):
        self._make = make
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in FACTS:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in FACTS

    def __iter__(self) -> Iterator[str]:
        return iter(FACTS)

    def __len__(self) -> int:
        return len(FACTS)


class Workspace:
    """Stored tables for one folder of given tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {n: written(df, n) for n, df in given.dimensions(self.spark, self.directory).items()}

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        lines = written(given.order_lines(self.spark, self.directory), "lines")
        return {
            "stg_sales": given.staged_sales(lines),
            "stg_price_history": given.staged_prices(lines),
            "stg_discount_events": given.staged_discounts(lines),
        }

    @property
    def loadable(self) -> dict[str, DataFrame]:
        """Staging without the sales and discounts of unknown skus, which would stop a load."""
        products = self.dims["dim_product"]
        return {
            name: df if name == "stg_price_history" else known_sku(df, products) for name, df in self.staging.items()
        }

    @property
    def loadable_early(self) -> dict[str, DataFrame]:
        """The loadable rows dated before the cut between first and second load."""
        return {name: df.filter(F.col(DATE_OF[name]) < F.lit(given.PRELOADED_BEFORE)) for name, df in self.loadable.items()}

    @cached_property
    def no_facts(self) -> dict[str, DataFrame]:
        return {name: empty_table(self.spark, name) for name in FACTS}

    @cached_property
    def loaded(self) -> tuple[MartStore, Refresh]:
        """The whole staging loaded into an empty store."""
        store = self.fresh_store()
        return store, store.refresh(self.loadable, self.dims, given.LOADED_AT)

    @cached_property
    def loads(self) -> dict[str, tuple[DataFrame, Refresh]]:
        """The facts loaded alone so far, and their loads."""
        return {}

    def load_of(self, name: str) -> tuple[DataFrame, Refresh]:
        """A fact as the load of the whole staging leaves it, and that load. Facts do not depend on each other, so without
        such a load this one alone is loaded."""
        if "loaded" in self.__dict__:
            return self.loaded[0].table(name), self.loaded[1]
        if name not in self.loads:
            store = self.fresh_store()
            load = store.refresh({STAGE_OF[name]: self.loadable[STAGE_OF[name]]}, self.dims, given.LOADED_AT)
            self.loads[name] = store.table(name), load
        return self.loads[name]

    @cached_property
    def facts(self) -> Mapping[str, DataFrame]:
        return Tables(lambda name: self.load_of(name)[0])

    @cached_property
    def unrepaired(self) -> DataFrame:
        """Price facts of the first load as appended, before the repair."""
        return self.load_of("fact_price_history")[1].new_rows["fact_price_history"]

    @cached_property
    def early(self) -> tuple[MartStore, dict[str, DataFrame]]:
        """A store with only the early rows, which is what a second load finds, and its facts before others follow."""
        store = self.fresh_store()
        store.refresh(self.loadable_early, self.dims, given.LOADED_AT)
        return store, store.facts()

    def early_fact(self, name: str) -> DataFrame:
        """An early fact; it alone is loaded unless all are."""
        if "early" in self.__dict__:
            return self.early[1][name]
        store = self.fresh_store()
        store.refresh({STAGE_OF[name]: self.loadable_early[STAGE_OF[name]]}, self.dims, given.LOADED_AT)
        return store.table(name)

    @cached_property
    def early_facts(self) -> Mapping[str, DataFrame]:
        return Tables(self.early_fact)

    @cached_property
    def unchecked(self) -> Mapping[str, DataFrame]:
        """Facts as a load without foreign keys would have made them; unknown members are kept."""

        def members() -> DataFrame:
            return self.staging["stg_price_history"].select("sku").dropna().distinct()

        empty, at = self.no_facts, given.LOADED_AT
        make = {
            "fact_sales": lambda rows, facts: refresh_sales(rows, facts, at),
            "fact_price_history": lambda rows, facts: append_prices(rows, facts, members(), at),
            "fact_discount_events": lambda rows, facts: refresh_discounts(rows, facts, at),
        }
        return Tables(lambda name: make[name](self.staging[STAGE_OF[name]], empty[name]))

    @cached_property
    def history(self) -> tuple[MartStore, dict[str, DataFrame]]:
        """The early store after two more runs (the first fails on unknown skus), and its facts after the failure."""
        store = self.early[0]
        try:
            store.refresh(self.staging, self.dims, given.SECOND_LOAD_AT)
        except LoadRejected:
            pass
        after_failure = store.facts()
        store.refresh(self.loadable, self.dims, given.SECOND_LOAD_AT)
        return store, after_failure

    def fresh_store(self) -> MartStore:
        """A new, empty mart on shared storage."""
        return MartStore(self.spark, scratch_path(self.spark, "mart"))


_OPEN: dict[tuple[str, str, str], Workspace] = {}


def _fingerprint(spark: SparkSession, directory: str) -> str:
    """Names, sizes and times of the entries of the folder, from its listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    seen = sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries)
    return hashlib.sha256(repr(seen).encode()).hexdigest()


def workspace(spark: SparkSession, directory: str) -> Workspace:
    """The workspace of this application for a folder of given tables."""
    key = (spark.sparkContext.applicationId, directory, _fingerprint(spark, directory))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, directory)
    return _OPEN[key]
