"""Row rules for staged data, and the table contract that Parquet does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffmart.functions.expressions import has_text, is_blank
from tariffmart.schemas import DIMENSION_OF, KEY, Contract
from tariffmart.sources.tables import broken_type, business_fields


def required_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with any of the columns NULL are dropped, silently and uncounted."""
    return df.dropna(subset=columns)


def price_row_rules() -> Column:
    """The column rules a staged price must pass; a NULL price passes neither this nor its opposite."""
    return has_text("sku") & (F.col("price") >= 0) & F.col("effective_start").isNotNull()


def known_sku(df: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Rows whose sku is in the product dimension. No broadcast is forced: the planner decides by size."""
    return df.join(dim_product.select("sku"), "sku", "left_semi").select(*df.columns)


def unknown_sku(df: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Rows whose sku is not in the product dimension; a NULL sku is unknown."""
    return df.join(dim_product.select("sku"), "sku", "left_anti").select(*df.columns)


def valid_price_rows(staged: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Staged prices that may be loaded."""
    return known_sku(staged.filter(price_row_rules()), dim_product)


def rejected_price_count(staged: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row: number of raw staged prices that break at least one rule, copies included.

    Rows are counted per (sku, column rule) before they meet the dimension, so a common sku is one row.
    """
    broken = F.coalesce(F.col("price") < 0, F.lit(False)) | F.col("effective_start").isNull() | is_blank("sku")
    groups = staged.groupBy("sku", broken.alias("broken")).agg(F.count("*").alias("n"))
    known = dim_product.select("sku", F.lit(True).alias("known"))
    counted = F.when(F.col("broken") | F.col("known").isNull(), F.col("n")).otherwise(0)
    return groups.join(known, "sku", "left").agg(
        F.coalesce(F.sum(counted), F.lit(0)).cast("long").alias("rows_rejected")
    )


def reject_reasons(staged: DataFrame) -> DataFrame:
    """Labelled counts of negative prices and missing skus, in one pass."""
    return staged.agg(
        F.count_if(F.col("price") < 0).alias("negative_price"), F.count_if(is_blank("sku")).alias("missing_sku")
    ).select(
        F.expr("stack(2, 'negative_price', negative_price, 'missing_sku', missing_sku) AS (check_type, row_count)")
    )


def _rules(contract: Contract) -> list[tuple[str, str, Column]]:
    """(column, rule, condition that breaks it)."""
    rules = [(c, "not_null", F.col(c).isNull()) for c in contract.required]
    return rules + [(c, f"max_length_{n}", F.length(c) > n) for c, n in contract.max_length.items()]


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, rule, row_count) for each NOT NULL and length rule, in one pass over the rows."""
    rules = _rules(contract)
    counts = df.agg(*[F.count_if(broken).alias(f"m{i}") for i, (_, _, broken) in enumerate(rules)])
    cells = ", ".join(f"'{column}', '{rule}', m{i}" for i, (column, rule, _) in enumerate(rules))
    return counts.select(F.expr(f"stack({len(rules)}, {cells}) AS (column_name, rule, row_count)"))


def type_violations(rows: DataFrame, name: str) -> DataFrame:
    """(column_name, rule, row_count) of values that cannot be read as their column's type, in one pass."""
    fields = [f for f in business_fields(name) if not isinstance(f.dataType, T.StringType)]
    counts = rows.agg(*[F.count_if(broken_type(f)).alias(f"m{i}") for i, f in enumerate(fields)])
    cells = ", ".join(f"'{f.name}', 'type', m{i}" for i, f in enumerate(fields))
    return counts.select(F.expr(f"stack({len(fields)}, {cells}) AS (column_name, rule, row_count)"))


def load_profile(
    new_rows: dict[str, DataFrame], contracts: dict[str, Contract], dims: dict[str, DataFrame]
) -> DataFrame:
    """One row per table: number of rows, rows breaking each of its rules in turn (r0, r1, ...), and rows with
    an unknown member per key column.

    All tables are counted per key first, then looked up in the dimensions together.
    """
    width = max(len(_rules(contracts[table])) for table in new_rows)
    parts = []
    for table, rows in new_rows.items():
        broken = [F.count_if(condition) for _, _, condition in _rules(contracts[table])]
        broken += [F.lit(0).cast("long")] * (width - len(broken))
        parts.append(
            rows.groupBy(F.lit(table).alias("table_name"), *KEY).agg(
                F.count("*").alias("n"),
                *[c.alias(f"r{i}") for i, c in enumerate(broken)],
            )
        )
    flagged = flag_unknown_members(reduce(DataFrame.unionByName, parts), dims)
    unknown = [
        F.sum(F.when(F.col(f"{c}_unknown") & F.col(c).isNotNull(), F.col("n")).otherwise(0)).alias(f"{c}_unknown")
        for c in DIMENSION_OF
    ]
    return flagged.groupBy("table_name").agg(
        F.sum("n").alias("n"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(width)], *unknown
    )


def broken_rules(profile: Row, contract: Contract) -> list[str]:
    """The rules that a table's profile breaks, as text with their counts."""
    found = [(f"{column} {rule}", profile[f"r{i}"]) for i, (column, rule, _) in enumerate(_rules(contract))]
    found += [(f"{c} without dimension row", profile[f"{c}_unknown"]) for c in DIMENSION_OF]
    return [f"{profile.table_name}.{what}: {n}" for what, n in found if n]


def key_counts(df: DataFrame, by: list[str] = KEY) -> DataFrame:
    """Rows per key. Checks against dimensions run on these instead of on the facts."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def flag_unknown_members(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Adds one boolean per key column: true if the dimension lacks the member."""
    for column, table in DIMENSION_OF.items():
        members = dims[table].select(column, F.lit(True).alias("_known")).distinct()
        df = df.join(members, column, "left").withColumn(f"{column}_unknown", F.col("_known").isNull()).drop("_known")
    return df


def foreign_key_violations(facts: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, row_count) of non-NULL keys without a dimension row, zeros included."""
    per_key = None
    for name, fact in facts.items():
        part = key_counts(fact).withColumn("table_name", F.lit(name))
        per_key = part if per_key is None else per_key.unionByName(part)
    flagged = flag_unknown_members(per_key, dims)
    cells = ", ".join(
        f"'{c}', CASE WHEN {c}_unknown AND {c} IS NOT NULL THEN n ELSE 0L END" for c in DIMENSION_OF
    )
    counts = flagged.select(
        "table_name", F.expr(f"stack({len(DIMENSION_OF)}, {cells}) AS (column_name, row_count)")
    )
    # Facts without any row still report their zeros.
    names = F.explode(F.array(*[F.lit(n) for n in facts])).alias("table_name")
    columns = F.explode(F.array(*[F.lit(c) for c in DIMENSION_OF])).alias("column_name")
    spark = per_key.sparkSession
    zeros = spark.range(1).select(names).select("table_name", columns).withColumn("row_count", F.lit(0).cast("long"))
    return (
        counts.unionByName(zeros)
        .groupBy("table_name", "column_name")
        .agg(F.sum("row_count").cast("long").alias("row_count"))
    )


def orphan_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Keys of the fact that miss at least one dimension, with their number of rows ``n``."""
    missing = " OR ".join(f"NOT EXISTS (SELECT 1 FROM {{{table}}} d WHERE d.{column} = k.{column})" for column, table in DIMENSION_OF.items())
    asked = {table: dims[table] for table in DIMENSION_OF.values()}
    return fact.sparkSession.sql(f"SELECT {', '.join(KEY)}, n FROM {{per_key}} k WHERE {missing}", per_key=key_counts(fact), **asked)


def orphan_rows(fact: DataFrame, dims: dict[str, DataFrame], label: str, row_id: str) -> DataFrame:
    """The fact rows behind ``orphan_keys``, labelled with their table."""
    bad = orphan_keys(fact, dims).drop("n")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
    return (
        fact.alias("f")
        .join(bad.alias("b"), same, "left_semi")
        .select(F.lit(label).alias("table_name"), F.col(row_id).alias("row_id"), *KEY)
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of a primary key that occur more than once."""
    return df.groupBy(F.col(key).cast("string").alias("key_value")).agg(F.count("*").alias("row_count")).filter(
        "row_count > 1"
    )
