"""Late arrivals: which staged rows are late, and what merging them does to the ranges around them.

Late rows need no watermark. A row is sorted into its place by its start date whenever it comes, so a
limit on lateness would only lose rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.operators.repair import repair_ranges
from tariffmart.schemas import KEY


def late_arrivals(staged: DataFrame, date: str, days: int = 30) -> DataFrame:
    """Staged rows loaded at least ``days`` days after the date they are about."""
    late_by = F.datediff(F.to_date("loaded_at"), F.col(date))
    return staged.withColumn("days_late", late_by).filter(F.col("days_late") >= days)


def late_repair(base: DataFrame, late: DataFrame) -> DataFrame:
    """Rows of ``base`` whose repaired end differs once ``late`` is merged in."""
    without = repair_ranges(base).select("price_hist_id", F.col("effective_end").alias("end_without_late"))
    merged = repair_ranges(base.unionByName(late)).select(
        "price_hist_id", *KEY, "effective_start", F.col("effective_end").alias("end_with_late")
    )
    return merged.join(without, "price_hist_id").filter(
        ~F.col("end_with_late").eqNullSafe(F.col("end_without_late"))
    )
