from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tariffmart.llm.sharding import jump_shard, shard_documents


def jump(key: int, shards: int) -> int:
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_equal_the_published_rule(spark):
    keys = [*range(300), -1, 2**63 - 1, -(2**63), 10**18, -(10**18) + 7]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 17, 100):
        got = {r[0]: r[1] for r in frame.select("k", jump_shard(F.col("k"), shards)).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_slots_are_gapless_and_growth_moves_into_the_new_shard_only(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = shard_documents(given).collect()
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    for shard in range(16):
        own = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert [r["doc_id"] for r in own] == sorted(r["doc_id"] for r in own)


def test_edges(docs):
    got = shard_documents(docs((None, "a"), (1, None), (1, None), (1, ""), (10**17, "é" * 100_000), (-5, "b"))).collect()
    assert len(got) == 6 and {r["shard"] for r in got if r["doc_id"] == 1} == {jump(1, 16)}
    assert next(r for r in got if r["doc_id"] is None)["shard"] == jump(0, 16)
    assert next(r for r in got if r["doc_id"] == 10**17)["size"] == 200_001
    for shard, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert shard_documents(docs()).collect() == []


def test_neither_an_outlying_id_nor_equal_rows_fill_a_range(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id = 1 THEN 4000000000000000000 ELSE id END AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text")
    got = shard_documents(rows.repartition(5))
    for shard, n in Counter(r["shard"] for r in got.collect()).items():
        assert sorted(r["slot"] for r in got.where(f"shard = {shard}").collect()) == list(range(n))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no group is sorted as one
