"""Small column expressions. Everything here is a built-in Spark expression, so it stays in generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffmart.schemas import KEY

# Fixed value: the date that stands for "no end" where two ends are compared.
OPEN_END = dt.date(9999, 12, 31)


def day(value: dt.date | str | Column) -> Column:
    """A DATE column from a date, an ISO string or an existing column."""
    if isinstance(value, Column):
        return value
    return F.lit(as_date(value))


def as_date(value: dt.date | str) -> dt.date:
    """Strict yyyy-mm-dd check of a caller's date argument; raises ValueError on anything else."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def moment(value: dt.datetime | str) -> Column:
    """A TIMESTAMP literal in the session time zone (UTC in this project)."""
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(text))


def end_or_open(end: str | Column) -> Column:
    """The end date with NULL read as the open end."""
    return F.coalesce(F.col(end) if isinstance(end, str) else end, F.lit(OPEN_END))


def is_blank(text: str) -> Column:
    """True for NULL and for text of spaces only."""
    return F.coalesce(F.trim(F.col(text)) == "", F.lit(True))


def has_text(text: str) -> Column:
    """True only for text with something other than spaces."""
    return F.coalesce(F.trim(F.col(text)) != "", F.lit(False))


def key_text(columns: list[str] = KEY) -> Column:
    """Key columns as one text joined by '|'; NULL counts as empty text."""
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def sku_label(number: Column) -> Column:
    """'SKU-' and the number raised by 10000, at least five digits."""
    return F.concat(F.lit("SKU-"), F.format_string("%05d", number + 10000))


def month(date: str | Column) -> Column:
    """The month of a date as yyyy-MM."""
    return F.date_format(date, "yyyy-MM").alias("month")


def sales_file_name(sale_date: str | Column) -> Column:
    """Name of the daily sales file that a row came from."""
    return F.concat(F.lit("sales_"), F.date_format(sale_date, "yyyy_MM_dd"), F.lit(".csv"))


def draw(label: str, below: int, *seeds: str | Column) -> Column:
    """A repeatable pseudo-random integer in [0, below) from the seed columns; ``below`` <= 2**28."""
    text = F.concat_ws("|", F.lit(label), *[F.col(s) if isinstance(s, str) else s for s in seeds])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % below


def pick(values: list[str], position: Column) -> Column:
    """The list member at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def differs(left: Column, right: Column) -> Column:
    """left <> right with unknown read as not different."""
    return F.coalesce(left != right, F.lit(False))
