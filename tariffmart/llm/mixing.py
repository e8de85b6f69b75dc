"""Mixing of sources to target weights: temperature, then budgeted block permutations.

Each source's share of the tokens is raised to an exponent between 0 (all alike) and 1 (as they are), found by
bisection: the one that meets the entropy asked for, or the least that keeps every source within the repetition limit.
The weights are realised by passes over each source. A pass deals the source's blocks in a new order; the last pass of
a source stops where its budget ends, within one document.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, parts_for, place_hash, written

MOST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """What stands between ASCII white space; stands for tokens unless a column is given."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Normalised weights of sources whose shares are raised to ``exponent``; sources without tokens weigh nothing."""
    total = sum(tokens)
    raised = [(n / total) ** exponent if n else 0.0 for n in tokens]
    return [r / sum(raised) for r in raised]


def entropy(weights: list[float]) -> float:
    """Entropy as a share of the largest possible among the sources that weigh anything; 1 for a single one."""
    some = [w for w in weights if w > 0]
    return -sum(w * math.log(w) for w in some) / math.log(len(some)) if len(some) > 1 else 1.0


def repeats(tokens: list[int], weights: list[float], budget: float) -> float:
    """How often the most repeated source is passed over."""
    return max(budget * w / n for n, w in zip(tokens, weights, strict=True) if n)


def least_exponent(holds: Callable[[float], bool]) -> float:
    """The least exponent in [0, 1] from which on ``holds`` is true, by bisection; 1 if it holds nowhere below."""
    if holds(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


@dataclass
class Mixture:
    """For each source its tokens, weight and budget, and the exponent that gave them."""

    exponent: float
    sources: list[str | None]
    tokens: list[int]
    weights: list[float]
    budgets: list[float]


def plan_mixture(totals: list[tuple[str | None, int]], budget_share: float | None, target_entropy: float, most_repeats: float) -> Mixture:
    """Weights for (source, tokens): entropy falls and repetition shrinks as the exponent grows.

    The exponent is the largest that still reaches ``target_entropy``, raised as far as ``most_repeats`` demands. A budget
    beyond ``most_repeats`` passes over everything is cut to that. Without a ``budget_share`` the budget follows from the
    weights: the least with which every source is passed over once, so nothing is left out and lighter sources repeat.
    """
    sources, tokens = [s for s, _ in totals], [n for _, n in totals]
    if not sum(tokens):
        return Mixture(1.0, sources, tokens, [0.0] * len(totals), [0.0] * len(totals))

    def budget(weights: list[float]) -> float:
        if budget_share is None:
            return max(n / w for n, w in zip(tokens, weights, strict=True) if n)
        return sum(tokens) * min(budget_share, most_repeats)

    exponent = least_exponent(lambda a: entropy(tempered(tokens, a)) <= target_entropy)
    slack = max(most_repeats, 1.0 if budget_share is None else 0.0) * (1 + 1e-9)
    exponent = max(exponent, least_exponent(lambda a: repeats(tokens, tempered(tokens, a), budget(tempered(tokens, a))) <= slack))
    weights = tempered(tokens, exponent)
    return Mixture(exponent, sources, tokens, weights, [whole_passes(budget(weights) * w, n) for w, n in zip(weights, tokens, strict=True)])


def whole_passes(budget: float, tokens: int) -> float:
    """The budget, or the whole passes over ``tokens`` that it is but for rounding."""
    passes = round(budget / tokens) if tokens else 0
    return float(passes * tokens) if abs(budget - passes * tokens) <= 1e-8 * tokens else budget


def mix(
    docs: DataFrame,
    tokens: Column | None = None,
    budget_share: float | None = 1.0,
    target_entropy: float = 0.98,
    most_repeats: float = 4.0,
    block_rows: int = 1024,
    blocks_together: int = 4096,
) -> DataFrame:
    """(row, pass, block, n_tokens, weight, place): the draws of the mixture, ``row`` a struct of the input's columns.

    ``docs`` needs doc_id, text and source; ``tokens`` gives a row's tokens, else its words count. ``place`` between 0
    and 1 orders the draws so that every stretch holds the sources in proportion to their weights. Rows without tokens
    (null and empty texts) are never drawn; a null source is a source; repeated rows are rows of their own; an empty
    table gives no draws. A source gets its budget to within one row, or exactly whole passes.

    The rows are written once with their tokens. A source's order is by blocks of about ``block_rows`` rows chosen by a
    hash of the row and its place in that table, so rows that are equal in all columns spread as well. A pass is found from
    one sum for each block, added up for ``blocks_together`` of them at a time; only the block in which a budget ends is
    sorted by rows. The number of sources is taken to be at most ``MOST_SOURCES``; more raise an error.
    """
    spark = docs.sparkSession
    inner = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), (word_count(docs["text"]) if tokens is None else tokens.cast("long")).alias("n_tokens"), F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])).alias("seed"))
    inner = written(inner.where("n_tokens > 0"), "mixture")
    inner = inner.withColumn("at", place_hash()).withColumn("key", F.when(F.col("row.source").isNull(), "-").otherwise(F.concat(F.lit("+"), "row.source")))
    sums = inner.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sums = sorted(sums, key=lambda r: r["key"])
    planned = plan_mixture([(r["key"], r["tokens"]) for r in sums], budget_share, target_entropy, most_repeats)
    plan = [
        (r["key"], parts_for(r["rows"], block_rows), r["tokens"], w, int(b + 1e-6))
        for r, w, b in zip(sums, planned.weights, planned.budgets, strict=True)
    ]
    sources = F.broadcast(spark.createDataFrame(plan, "key string, blocks long, tokens long, weight double, budget long"))
    dealt = inner.join(sources, "key").withColumn("draw", F.xxhash64("seed", "at"))
    dealt = dealt.withColumn("block", F.pmod(F.col("draw"), F.col("blocks")))

    sizes = dealt.groupBy("key", "block").agg(F.sum("n_tokens").alias("size"), *[F.first(c).alias(c) for c in ("tokens", "budget", "blocks")])
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("budget") - 1) / F.col("tokens")))
    turns = sizes.where("budget > 0").withColumn("pass", F.explode(passes)).withColumn("turn", F.xxhash64("key", "block", "pass"))
    # blocks by turn, in ranges of turns: the sums of the ranges come first, then each range adds up its own blocks
    share = (F.col("turn") / F.lit(2.0**64) + 0.5) * F.ceil(F.col("blocks") / F.lit(blocks_together))
    turns = turns.withColumn("range", F.floor(share))
    ranges = turns.groupBy("key", "pass", "range").agg(F.sum("size").alias("own"))
    ranges = ranges.withColumn("earlier", F.sum("own").over(Window.partitionBy("key", "pass").orderBy("range")) - F.col("own"))
    order = Window.partitionBy("key", "pass", "range").orderBy("turn", "block")
    turns = turns.join(ranges.select("key", "pass", "range", "earlier"), ["key", "pass", "range"])
    turns = turns.withColumn("before", F.col("earlier") + F.sum("size").over(order) - F.col("size"))
    until = F.least(F.col("tokens"), F.col("budget") - F.col("pass") * F.col("tokens"))
    turns = turns.select(
        "key",
        "block",
        "pass",
        "size",
        until.alias("until"),
        "before",
        ((F.col("pass") * F.col("tokens") + F.col("before")) / F.col("budget")).alias("start"),
    ).where("before < until")
    whole = dealt.join(turns.where("before + size <= until").select("key", "block", "pass", "start"), ["key", "block"])
    cut = dealt.join(turns.where("before + size > until").select("key", "block", "pass", "before", "until", "start"), ["key", "block"])
    inside = Window.partitionBy("key", "pass").orderBy(F.xxhash64("draw", "pass"), "draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("reach", F.col("before") + F.sum("n_tokens").over(inside)).where("reach <= until")
    columns = ["row", "pass", "block", "n_tokens", "weight", "start"]
    return whole.select(columns).union(cut.select(columns)).withColumnRenamed("start", "place").withColumn("pass", F.col("pass").cast("int"))


def mixture_draws(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, source, pass, block, n_tokens, weight, place) of each draw; see :func:`mix`."""
    slim = argument(docs, "doc_id", "text", "source")
    counted = slim.select("doc_id", "source", F.xxhash64("text").alias("text"), word_count(F.col("text")).alias("words"))
    draws = mix(counted, tokens=F.col("words"), **settings)
    return draws.select("row.doc_id", "row.source", "pass", "block", "n_tokens", "weight", "place")
