"""Intervals of days: containment, overlap, day expansion, and overlap counting without pairs.

Every window in this module runs over rows already aggregated to one per (key, date). The number of
dates bounds such a group however many rows one key holds, and the aggregation before the shuffle
runs on the map side.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmart.functions.expressions import day, end_or_open
from tariffmart.operators.top import first_per_group
from tariffmart.schemas import KEY

COUNT_TYPE = "decimal(38,0)"
HALF = 31  # bits of a factor whose product fits a long


def active_on(start: str, end: str, on: dt.date | str | Column) -> Column:
    """The closed interval [start, end] holds the day; a NULL end never ends."""
    on = day(on)
    return (F.col(start) <= on) & (F.col(end).isNull() | (F.col(end) >= on))


def overlaps(start: str, end: str, first: dt.date | str, last: dt.date | str) -> Column:
    """The interval touches [first, last]; a NULL end never ends."""
    return (F.col(start) <= day(last)) & (F.col(end).isNull() | (F.col(end) >= day(first)))


def _clipped(df: DataFrame, start: str, end: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows that hold a day of [first, last], with the first and last such day. An inverted interval holds none."""
    return (
        df.filter(overlaps(start, end, first, last))
        .filter(F.col(end).isNull() | (F.col(start) <= F.col(end)))
        .withColumn("_first", F.greatest(F.col(start), day(first)))
        .withColumn("_last", F.least(end_or_open(end), day(last)))
    )


def one_row_per_day(
    df: DataFrame, start: str, end: str, first: dt.date, last: dt.date, name: str = "as_of_date"
) -> DataFrame:
    """One copy of each row for every day of [first, last] that its interval holds.

    The same rows as a range join with a calendar, without the nested loop: the interval is clipped to
    the window and unrolled in place, so nothing moves.
    """
    days = _clipped(df, start, end, first, last).withColumn(name, F.explode(F.sequence("_first", "_last")))
    return days.drop("_first", "_last")


def best_per_day(
    df: DataFrame,
    start: str,
    end: str,
    first: dt.date,
    last: dt.date,
    order_by: list[Column],
    by: list[str] = KEY,
    name: str = "as_of_date",
) -> DataFrame:
    """For each day of [first, last] and key the first row, in the given order, among those that hold the day.

    Rows of a key that hold the same days of the window compete on all of them, so only the best goes on to
    be unrolled. That leaves at most one row per pair of days for any key, whatever number of rows overlap, so
    they can move by key alone, before the days are unrolled; a join or group by key then moves nothing.
    """
    contenders = first_per_group(_clipped(df, start, end, first, last), [*by, "_first", "_last"], order_by)
    days = contenders.repartition(*by).withColumn(name, F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    return first_per_group(days, [name, *by], order_by)


def _as_intervals(df: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """Distinct (key, start, end) with the number of rows behind it."""
    return (
        df.filter(F.col(start).isNotNull())
        .filter(_known_key(by))
        .groupBy(*by, F.col(start).alias("s"), end_or_open(end).alias("e"))
        .agg(F.count("*").alias("n"))
    )


def _known_key(by: list[str]) -> Column:
    known = F.lit(True)
    for name in by:
        known = known & F.col(name).isNotNull()
    return known


def _running(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def overlap_counts(df: DataFrame, start: str, end: str, strict: bool, by: list[str] = KEY) -> DataFrame:
    """Number of row pairs per key whose intervals overlap; keys without any are left out.

    ``strict`` compares with ``<`` (touching days do not count), otherwise with ``<=``.
    """
    return _overlaps(_ranges(df, start, end, by), by, F.lit(strict))


def overlap_counts_by_kind(tables: dict[str, tuple[DataFrame, str, str, bool]], by: list[str] = KEY) -> DataFrame:
    """(kind, key, pairs) for several tables of intervals, named by kind: (rows, start, end, strict); see ``overlap_counts``.

    No pair is ever formed. Equal intervals of a key are counted first, so at most one row per pair of days moves on for a
    key, and moves by kind and key alone: all that follows finds its groups in place. Intervals with start <= end are
    counted by complement: all pairs less those where one ends before the other starts, which needs only running totals
    over dates. An inverted interval overlaps exactly the proper ones that enclose it, counted by ``_enclosing_counts``;
    without any inverted interval adaptive execution finds that side empty and drops it.
    """
    rows = [_ranges(df, start, end, by).withColumn("kind", F.lit(kind)) for kind, (df, start, end, _) in tables.items()]
    strict = F.col("kind").isin([kind for kind, (*_, strict) in tables.items() if strict])
    return _overlaps(reduce(DataFrame.unionByName, rows), ["kind", *by], strict)


def _ranges(df: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """(key, s, e) of the rows with a key and a start; a NULL end never ends."""
    rows = df.filter(F.col(start).isNotNull()).filter(_known_key(by))
    return rows.select(*by, F.col(start).alias("s"), end_or_open(end).alias("e"))


def _overlaps(ranges: DataFrame, group: list[str], strict: Column) -> DataFrame:
    """The pairs of each group; ``strict`` may depend on it."""
    # Proper and inverted spans are told apart first, where they are read.
    spans = lambda rows: rows.groupBy(*group, "s", "e").agg(F.count("*").alias("n")).repartition(*group)
    proper, inverted = spans(ranges.filter("s <= e")), spans(ranges.filter("s > e"))

    none = F.lit(0).cast("long")
    point = F.when(F.col("s") == F.col("e"), F.col("n")).otherwise(none)
    marks = F.array(
        F.struct(F.col("s").alias("d"), F.col("n").alias("starts"), none.alias("ends"), point.alias("points")),
        F.struct(F.col("e").alias("d"), none.alias("starts"), F.col("n").alias("ends"), none.alias("points")),
    )
    dates = (
        proper.select(*group, F.explode(marks).alias("m"))
        .select(*group, "m.*")
        .groupBy(*group, "d")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("points").alias("points"))
    )
    ended = F.sum("ends").over(_running(group))
    # Ended on or before the start. A one-day interval would meet itself there, and two on the same day would be
    # subtracted from both sides, hence the correction: p itself and p*(p-1)/2 once.
    def apart(number: str, half: Column) -> Column:
        starts, ended, ends, p = (F.col(c).cast(number) for c in ("starts", "ended", "ends", "points"))
        return F.when(strict, starts * ended - p - half).otherwise(starts * (ended - ends))

    # Products of two halves of a long are exact in a long, and so are the sums of their upper and of their lower bits, over
    # as many days as there are. Larger ones go by decimals, which cost far more.
    p, fits = F.col("points"), (F.col("starts") < 1 << HALF) & (F.col("ended") < 1 << HALF)
    short = F.when(fits, apart("long", F.shiftright(p * (p - 1), 1)))
    wide = p.cast(COUNT_TYPE)
    long = F.when(~fits, apart(COUNT_TYPE, wide * (wide - 1) / 2).cast(COUNT_TYPE))
    upper, lower = F.sum(F.shiftright("short", HALF)), F.sum(F.col("short").bitwiseAND((1 << HALF) - 1))
    total = [F.coalesce(c, F.lit(0)).cast(COUNT_TYPE) for c in (upper, lower, F.sum("long"))]
    totals = (
        dates.withColumn("ended", ended)
        .select(*group, "starts", short.alias("short"), long.alias("long"))
        .groupBy(*group)
        .agg(F.sum("starts").cast(COUNT_TYPE).alias("rows"), *[c.alias(n) for c, n in zip(total, ("upper", "lower", "long"), strict=True)])
        .withColumn("apart", (F.col("upper") * (1 << HALF) + F.col("lower") + F.col("long")).cast(COUNT_TYPE))
        .select(*group, (F.col("rows") * (F.col("rows") - 1) / 2 - F.col("apart")).cast(COUNT_TYPE).alias("pairs"))
    )
    totals = totals.unionByName(_enclosing_counts(proper, inverted, group, strict)).groupBy(*group).agg(F.sum("pairs").cast(COUNT_TYPE).alias("pairs"))
    return totals.filter(F.col("pairs") > 0)


def _enclosing_counts(proper: DataFrame, inverted: DataFrame, group: list[str], strict: Column) -> DataFrame:
    """Pairs of an inverted interval (start after end) and a proper one of the same key around it.

    A pair counts when proper.s < inverted.e and proper.e > inverted.s (or <=, >=). That is a count over
    two inequalities. The first becomes an equality: a proper start, as its day number from the lowest one,
    is filed under its binary prefixes (22 of them for all days), and "start below x" is the disjoint union
    of at most as many prefixes. The second is a running total over dates. Only keys that hold an inverted
    interval take part. Both tables lie by ``group``, so they do not move here.
    """
    low, width = F.expr("DATE'0001-01-01'"), (dt.date.max - dt.date.min).days + 1
    # An inner join on distinct keys: a semi join would be pushed below the count, so uncounted rows would move for it.
    around = proper.join(inverted.select(*group).distinct(), group).select(*proper.columns, F.lit(False).alias("inverted"))
    concerned = around.unionByName(inverted.withColumn("inverted", F.lit(True)))
    # "start < x" for strict; "start <= x" is "start < x + 1". Beyond the highest start nothing is left to count.
    below = F.datediff("e", low) + F.when(strict, 0).otherwise(1)
    x = F.when(F.col("inverted"), F.least(F.greatest(below, F.lit(0)), F.lit(width))).otherwise(F.datediff("s", low))
    levels = F.sequence(F.lit(0), F.lit(width.bit_length() - 1))
    filed = (
        concerned.withColumn("x", x)
        .withColumn("level", F.explode(levels))
        .filter("NOT inverted OR shiftright(x, level) % 2 = 1")
        .select(
            *group,
            "level",
            F.expr("shiftright(x, level) - IF(inverted, 1, 0)").alias("node"),
            F.when(F.col("inverted"), F.col("s")).otherwise(F.col("e")).alias("d"),
            F.when(~F.col("inverted"), F.col("n")).cast(COUNT_TYPE).alias("n"),
            F.when(F.col("inverted"), F.col("n")).cast(COUNT_TYPE).alias("asked"),
        )
    )
    node = [*group, "level", "node"]
    events = filed.groupBy(*node, "d").agg(F.coalesce(F.sum("n"), F.lit(0)).cast(COUNT_TYPE).alias("n"), F.sum("asked").alias("asked"))
    # Proper ends after the inverted start: strictly later dates, or that date as well.
    later = F.sum("n").over(Window.partitionBy(*node).orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        events.withColumn("around", (later - F.when(strict, F.col("n")).otherwise(0)).cast(COUNT_TYPE))
        .filter(F.col("asked").isNotNull())
        .groupBy(*group)
        .agg(F.sum(F.col("asked") * F.col("around")).cast(COUNT_TYPE).alias("pairs"))
    )


def overlapping_spans(df: DataFrame, start: str, end: str, by: list[str] = KEY) -> DataFrame:
    """Distinct (key, start, end) that share a day (closed intervals) with a different span of the key."""
    spans = _as_intervals(df, start, end, by).select(*by, F.col("s").alias(start), F.col("e").alias(end))
    return with_overlaps(spans, start, end, by).filter("overlaps").drop("overlaps")


def with_overlaps(spans: DataFrame, start: str, end: str, by: list[str] = KEY) -> DataFrame:
    """Distinct spans (key, start, end, ...) with a further column ``overlaps``: whether another span of the key shares a
    day with it. Spans are closed; an inverted one (start after end) meets exactly the proper ones that enclose it.

    Spans gather by key and lower day, so what is ordered is one row a day however many spans a key holds. One window
    over these days answers for all spans of a day: the latest proper end among earlier days, the next day that a proper
    span starts, the latest proper end so far, and the least upper day of an inverted span from here on.
    """
    span = F.struct(*[c for c in spans.columns if c not in by])
    proper = F.col(start) <= F.col(end)
    days = (
        spans.repartition(*by)  # by key alone, so neither the days nor the window move again
        .groupBy(*by, F.least(start, end).alias("_low"))
        .agg(
            F.collect_list(span).alias("_spans"),
            F.max(F.when(proper, F.col(end))).alias("_until"),
            F.count_if(proper).alias("_proper"),
            F.min(F.when(~proper, F.col(start))).alias("_inverted"),
        )
    )
    in_order = Window.partitionBy(*by).orderBy("_low")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*by).orderBy(F.col("_low").desc())
    from_here = later.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = later.rowsBetween(Window.unboundedPreceding, -1)
    rows = days.select(
        "*",
        F.max("_until").over(earlier).alias("_before"),
        F.min(F.when(F.col("_proper") > 0, F.col("_low"))).over(after).alias("_next"),
        F.min("_inverted").over(from_here).alias("_within"),
    ).withColumn("_span", F.explode("_spans"))
    low, high = F.col(f"_span.{start}"), F.col(f"_span.{end}")
    meets_proper = (F.col("_before") >= low) | (F.col("_proper") > 1) | (F.col("_next") <= high) | (F.col("_within") <= high)
    meets_inverted = F.greatest("_before", "_until") >= low
    overlaps = F.coalesce(F.when(low <= high, meets_proper).otherwise(meets_inverted), F.lit(False))
    return rows.select(*by, "_span.*", overlaps.alias("overlaps"))


def overlap_witnesses(
    df: DataFrame, row_id: str, start: str, end: str, strict: bool, by: list[str] = KEY
) -> DataFrame:
    """For each proper row that overlaps another of its key, one partner that proves it.

    The partner is the row with the latest end among those that start on an earlier day (largest id on
    equal ends); if none of them reaches this row, it is the day's row with the smallest id that overlaps
    it. At most one output row per input row, so offending pairs can be sampled without forming all of
    them, and every key that has an overlap among proper rows shows at least one.
    """
    rows = (
        df.select(*by, F.col(row_id).alias("id"), F.col(start).alias("s"), end_or_open(end).alias("e"))
        .filter("s <= e")
        .filter(_known_key(by))
    )
    # On one day two rows overlap always (closed) or when both are longer than the day itself (strict).
    meets_today = F.col("e") > F.col("s") if strict else F.lit(True)
    by_day = rows.groupBy(*by, "s").agg(
        F.max(F.struct("e", "id")).alias("longest"), F.min(F.when(meets_today, F.struct("id", "e"))).alias("anchor")
    )
    before = Window.partitionBy(*by).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    by_day = by_day.withColumn("prior", F.max(F.struct("longest.e", "longest.id", "s")).over(before))
    joined = rows.join(by_day, [*by, "s"])
    reaches = F.col("prior.e") > F.col("s") if strict else F.col("prior.e") >= F.col("s")
    today = meets_today & (F.col("anchor.id") != F.col("id"))
    partner = F.when(reaches, F.struct("prior.id", "prior.s", "prior.e")).when(
        today, F.struct(F.col("anchor.id"), F.col("s"), F.col("anchor.e"))
    )
    return joined.withColumn("partner", partner).filter("partner IS NOT NULL").select(
        *by,
        F.col("partner.id").alias("first_id"),
        F.col("partner.s").alias("first_start"),
        F.col("partner.e").alias("first_end"),
        F.col("id").alias("second_id"),
        F.col("s").alias("second_start"),
        F.col("e").alias("second_end"),
    )
