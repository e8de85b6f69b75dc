"""Within-batch and against-fact de-duplication.

Staged rows are made distinct before they meet the facts, so a heavily copied row is one row by the time
it is shuffled for the anti join. Stored facts are distinct already, and an anti join only asks whether one is there, so
the fact side moves once, for the join. A load moves both once, to the ranges of their order, and finds copies and stored
rows there, next to each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmart.functions.expressions import end_or_open, month
from tariffmart.schemas import DISCOUNT_COLUMNS, KEY, PRICE_COLUMNS, SALE_COLUMNS

# Where a row comes from; the stored one of two equal rows is the greater.
STAGED, STORED = "staged", "stored"


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """SELECT DISTINCT over the business columns."""
    return df.select(*columns).distinct()


def staged_months(staged: DataFrame, date: str) -> list[str]:
    """The months, as yyyy-MM, that staged rows are about: as many as the calendar has at most.

    Only facts of these months can equal a staged row, so one late row adds one month to what is compared.
    """
    days = staged.select(date).distinct()  # a month's text is made once a day, not once a row
    return sorted(r[0] for r in days.select(month(date)).distinct().collect() if r[0] is not None)


def of_staged_months(facts: DataFrame, staged: DataFrame, date: str) -> DataFrame:
    """The facts dated in a month that staged rows are about, by a filter in the scan."""
    first_day = F.unix_date(F.trunc(date, "MM"))
    months = [r[0] for r in staged.select(date).distinct().select(first_day).distinct().collect() if r[0] is not None]
    return facts.filter(first_day.isin(months))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def new_sales(staged: DataFrame, facts: DataFrame) -> DataFrame:
    """Distinct staged sales without an equal fact on all six business columns."""
    return distinct_rows(staged, SALE_COLUMNS).join(
        facts.select(*SALE_COLUMNS), SALE_COLUMNS, "left_anti"
    )


def new_discounts(staged: DataFrame, facts: DataFrame) -> DataFrame:
    """Distinct staged discounts without an equal fact. A NULL type equals nothing, so it is always new."""
    return distinct_rows(staged, DISCOUNT_COLUMNS).join(
        facts.select(*DISCOUNT_COLUMNS), DISCOUNT_COLUMNS, "left_anti"
    )


def beside_stored(staged: DataFrame, facts: DataFrame | None, columns: list[str]) -> DataFrame:
    """Staged rows and the facts they can equal, told apart by ``_of``. A NULL equals nothing, so facts with one stay out."""
    rows = staged.select(*columns, F.lit(STAGED).alias("_of"))
    return rows if facts is None else rows.unionByName(facts.select(*columns).dropna().select("*", F.lit(STORED).alias("_of")))


def unstored_in_place(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of rows ``beside_stored``, equal ones in one task, the distinct staged ones without an equal fact.

    ``_of`` is text, so the aggregate goes over sorted rows and holds none; its order is that of ``columns``.
    """
    return rows.groupBy(*columns).agg(F.max("_of").alias("_of")).filter(F.col("_of") == STAGED).drop("_of")


def same_end(left: Column, right: Column) -> Column:
    """Both ends equal, an open end being equal to an open end."""
    return end_or_open(left) == end_or_open(right)


def currency_matches(fact: Column, staged: Column) -> Column:
    """A staged NULL currency matches any fact currency."""
    return fact == F.coalesce(staged, fact)


def new_prices(staged: DataFrame, facts: DataFrame, match_end: bool = True) -> DataFrame:
    """Distinct staged prices without a matching fact.

    With ``match_end`` the staged end is compared with the fact's end. Since repair rewrites ends, a row
    whose end was changed is then loaded again on the next run. ``match_end=False`` leaves the end out and
    makes a reload of the same staging add nothing.
    """
    return unstored_prices(distinct_rows(staged, PRICE_COLUMNS), facts, match_end)


def unstored_prices(distinct: DataFrame, facts: DataFrame, match_end: bool = True) -> DataFrame:
    """The same of staged prices that are distinct already."""
    keys = [*KEY, "price", "effective_start", "currency"] + (["effective_end"] if match_end else [])
    s = distinct.alias("s")
    f = facts.select(*keys).alias("f")
    equal = [F.col(f"s.{c}") == F.col(f"f.{c}") for c in [*KEY, "price", "effective_start"]]
    if match_end:
        equal.append(same_end(F.col("s.effective_end"), F.col("f.effective_end")))
    equal.append(currency_matches(F.col("f.currency"), F.col("s.currency")))
    return s.join(f, _all(equal), "left_anti")
