"""Shards by jump consistent hashing, in column expressions only.

A key's own random sequence decides at which shard counts it jumps to the newest shard; its shard is the last jump
below the count. There is no ring table, and appending a shard moves only the keys that jump to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, written
from tariffmart.operators.surrogate import with_surrogate_key

SHARDS = 16
#: Fixed value: the multiplier of the published generator, whose step is key * MULTIPLIER + 1 modulo 2**64.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64 on the halves of the key; no product here reaches 2**63."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & LOW

    def times(half: Column, factor: int) -> Column:
        """half * factor modulo 2**32."""
        upper = F.shiftleft((F.shiftrightunsigned(half, 16) * F.lit(factor)).bitwiseAND(0xFFFF), 16)
        return (half.bitwiseAND(0xFFFF) * F.lit(factor) + upper).bitwiseAND(LOW)

    first = low.bitwiseAND(0xFFFF) * F.lit(m_low) + F.lit(1).cast("long")
    second = F.shiftrightunsigned(low, 16) * F.lit(m_low)
    sum_low = first + F.shiftleft(second.bitwiseAND(0xFFFF), 16)
    carried = F.shiftrightunsigned(sum_low, 32) + F.shiftrightunsigned(second, 16)
    return (carried + times(high, m_low) + times(low, m_high)).bitwiseAND(LOW), sum_low.bitwiseAND(LOW)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a long key among ``shards``, as int; a null key counts as 0.

    Jumps strictly increase, so ``shards`` steps suffice for every key.
    """
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(LOW).alias("low"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _step(state["high"], state["low"])
        top = F.shiftrightunsigned(high, 1) + 1
        at = state["next"]
        further = F.floor((at + 1).cast("double") * (F.lit(float(1 << 31)) / top.cast("double"))).cast("long")
        return F.when(at >= shards, state).otherwise(
            F.struct(at.alias("shard"), further.alias("next"), high.alias("high"), low.alias("low"))
        )

    steps = F.sequence(F.lit(1), F.lit(shards + 1))
    return F.aggregate(steps, start, jump, lambda state: state["shard"].cast("int"))


def jump_sql(key: str, shards: int) -> str:
    """The same rule as one SQL expression for DuckDB: a fold over the steps on unsigned 128-bit numbers."""
    step = f"((s.k * {MULTIPLIER}::uhugeint + 1) % 18446744073709551616::uhugeint)"
    further = f"floor((s.j + 1)::double * (2147483648.0 / ((({step}) // 8589934592::uhugeint)::double + 1)))::bigint"
    start = f"{{'b': 0::bigint, 'j': 0::bigint, 'k': (coalesce({key}, 0) % 18446744073709551616::hugeint)::uhugeint}}"
    return (
        f"list_reduce([{start}] || list_transform(range({shards + 1}), lambda x: {start}), "
        f"lambda s, x: case when s.j >= {shards} then s else {{'b': s.j, 'j': {further}, 'k': {step}}} end).b::integer"
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs`` (doc_id, text).

    The law is ``key``: doc_id and the number of shards decide, and ``grown_shard``, the shard among one more, differs
    only where it is the new one. ``slot`` numbers a shard's rows from 0 in order of doc_id (nulls first), then size and
    checksum; rows equal in all of these may swap. Null texts have size 1 and checksum 0; a null doc_id is key 0.

    Slots need no sort of a whole shard: the rows, without their texts, are written in ranges of (shard, doc_id, size,
    checksum, place in the input) and numbered there, and a shard's first number is taken off. The ranges are cut by a
    sample of that order, so neither an outlying id nor a third of all rows with one id and text fill one.
    """
    rows = argument(docs, "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        jump_shard(F.col("doc_id"), shards).alias("shard"),
        jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["shard", F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "place"]
    numbered = with_surrogate_key(written(rows, "shards"), "number", order)
    # one row for each shard
    starts = numbered.groupBy("shard").agg(F.min("number").alias("first"))
    slot = (F.col("number") - F.col("first")).cast("long").alias("slot")
    law = F.lit("key").alias("law")
    return numbered.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", law, "shard", slot, "grown_shard")
