"""Upsert, update-from-join and result comparison, as joins over whole snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Merge ``source`` into ``target`` on the natural key.

    Matched rows take the source's ``columns`` (also where the source is NULL) and keep everything else;
    source rows without a match are inserted with NULL for what the source lacks; other target rows stay.
    Every key column must be unique and not NULL on both sides.
    """
    s = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in columns])
    s = s.withColumn("_matched", F.lit(True))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    joined = target.join(s, on, "full_outer")
    out = []
    for name in target.columns:
        if name in keys:
            out.append(F.coalesce(F.col(name), F.col(f"_k_{name}")).alias(name))
        elif name in columns:
            out.append(F.when(F.col("_matched"), F.col(f"_s_{name}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)


def update_from(target: DataFrame, changes: DataFrame, key: str, assignments: dict[str, str]) -> DataFrame:
    """Set target columns from the matching row of ``changes``; rows without one stay as they are."""
    c = changes.select(
        F.col(key).alias("_key"), *[F.col(source).alias(f"_new_{name}") for name, source in assignments.items()]
    )
    joined = target.join(c, F.col(key) == F.col("_key"), "left")
    return joined.select(
        *[
            F.when(F.col("_key").isNotNull(), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            if name in assignments
            else F.col(name)
            for name in target.columns
        ]
    )


BUCKETS = 1 << 14  # of rows that are compared by fingerprint; at most so many come back as different


def fingerprints(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, left_rows, right_rows, same): by bucket of row hashes, whether both sides hold the same rows, copies counted.

    The fingerprint of a bucket is the number of rows and the sums of two 64-bit hashes of each row, NULL told from any
    value. It does not depend on order, and is summed before anything moves: what moves is one row a bucket and task.
    Different rows pass as the same only if both sums agree by chance, about once in 10^38.
    """

    def summed(df: DataFrame, side: str) -> DataFrame:
        first, second = _row_hashes(df)
        bucket = F.pmod(first, F.lit(buckets)).cast("int").alias("bucket")
        rows = df.select(bucket, first.cast("decimal(20,0)").alias("a"), second.cast("decimal(20,0)").alias("b"), F.lit(side).alias("side"))
        return rows.groupBy("bucket", "side").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))

    sides = summed(left, "left").unionByName(summed(right.select(*left.columns), "right"))
    is_left, sign = F.col("side") == "left", F.when(F.col("side") == "left", 1).otherwise(-1)
    gone = lambda c: F.coalesce(F.sum((sign * F.col(c)).cast("decimal(38,0)")), F.lit(0)) == 0
    return sides.groupBy("bucket").agg(
        F.sum(F.when(is_left, F.col("n")).otherwise(0)).alias("left_rows"),
        F.sum(F.when(is_left, 0).otherwise(F.col("n"))).alias("right_rows"),
        (gone("n") & gone("a") & gone("b")).alias("same"),
    )


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    columns = [F.col(f"`{c}`") for c in df.columns]
    missing = F.array(*[c.isNull() for c in columns])  # a NULL leaves a hash as it was
    return F.xxhash64(*columns, missing), F.xxhash64(F.lit(7), missing, *columns)


def _suspects(left: DataFrame, right: DataFrame, prints: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of both sides whose bucket differs, with ``_l`` and ``_r`` for the side; none of equal tables."""
    differing = F.broadcast(prints.filter("NOT same").select("bucket"))  # at most one small row for each bucket

    def marked(df: DataFrame, in_left: int) -> DataFrame:
        bucket = F.pmod(_row_hashes(df)[0], F.lit(buckets)).cast("int")
        rows = df.withColumn("_bucket", bucket).join(differing, F.col("_bucket") == differing["bucket"], "left_semi")
        return rows.select(*df.columns, F.lit(in_left).alias("_l"), F.lit(1 - in_left).alias("_r"))

    return marked(left, 1).unionByName(marked(right.select(*left.columns), 0))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that only one side has, labelled ``left`` or ``right``; NULL equals NULL.

    Fingerprints come first; only rows of buckets that differ are compared in full, both directions by one aggregation
    over their union. Equal tables are read twice and none of their rows moves.
    """
    seen = _suspects(left, right, fingerprints(left, right)).groupBy(*left.columns).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.filter("_l <> _r").select(F.when(F.col("_l") == 1, "left").otherwise("right").alias("only_in"), *left.columns)


def diff_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: row counts, distinct rows missing on each side, and PASS only if all of them agree.

    The set difference ignores copies, so the row counts are compared as well; they come from the fingerprints.
    """
    prints = fingerprints(left, right)
    seen = _suspects(left, right, prints).groupBy(*left.columns).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    none = F.lit(0).cast("long")
    missing = seen.select(none.alias("left_rows"), none.alias("right_rows"), (F.col("_l") > F.col("_r")).cast("long").alias("only_left"), (F.col("_r") > F.col("_l")).cast("long").alias("only_right"))
    measured = prints.select("left_rows", "right_rows", none.alias("only_left"), none.alias("only_right")).unionByName(missing)
    totals = measured.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in measured.columns])
    same = (F.col("only_left") == 0) & (F.col("only_right") == 0) & (F.col("left_rows") == F.col("right_rows"))
    return totals.withColumn("result", F.when(same, "PASS").otherwise("FAIL"))
