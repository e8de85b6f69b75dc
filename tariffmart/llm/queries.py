"""The registered queries of this subpackage: every operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tariffmart.llm.byte_bpe import code_digests, decode, encode
from tariffmart.llm.common import given
from tariffmart.llm.language import language_model, predict_language
from tariffmart.llm.main_text import main_text
from tariffmart.llm.mixing import mixture_draws
from tariffmart.llm.nearest import nearest
from tariffmart.llm.packing import pack
from tariffmart.llm.periodic import crc_rewrite, periodic_runs, run_digests
from tariffmart.llm.sharding import SHARDS, jump_sql, shard_documents
from tariffmart.llm.similar import jaccard_components
from tariffmart.llm.token_counts import token_counts
from tariffmart.llm.top_search import exact_top_k
from tariffmart.llm.toxicity import fit_toxicity, score_toxicity
from tariffmart.llm.whitening import whiten


def op1_exact_top_k(spark: SparkSession, directory: str) -> DataFrame:
    return exact_top_k(given(spark, directory, "embeddings"))


def op2_nearest(spark: SparkSession, directory: str) -> DataFrame:
    return nearest(given(spark, directory, "embeddings"))


def op3_packing(spark: SparkSession, directory: str) -> DataFrame:
    return pack(given(spark, directory, "documents"))


def op4_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = given(spark, directory, "documents")
    return score_toxicity(docs, fit_toxicity(docs, given(spark, directory, "labels")))


def op5_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts(given(spark, directory, "documents"))


def op6_sharding(spark: SparkSession, directory: str) -> DataFrame:
    return shard_documents(given(spark, directory, "documents"))


def op7_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard_components(given(spark, directory, "documents"))


def op8_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = given(spark, directory, "documents")
    return predict_language(docs, language_model(docs))


def op9_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixture_draws(given(spark, directory, "documents"))


def op10_main_text(spark: SparkSession, directory: str) -> DataFrame:
    return main_text(given(spark, directory, "pages"))


def op11_periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    return run_digests(periodic_runs(given(spark, directory, "documents"), rewrite=crc_rewrite))


def op12_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return code_digests(decode(encode(given(spark, directory, "documents"))))


def op13_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whiten(given(spark, directory, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_nearest": op2_nearest,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language": op8_language,
    "op9_mixing": op9_mixing,
    "op10_main_text": op10_main_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op6_sharding": f"""
        with crcs as (
            select list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, k:
                case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crcs
        ),
        texts as (select doc_id, coalesce(strlen(text), 0) as bytes, hex(encode(coalesce(text, ''))) as digits from documents),
        placed as (
            select doc_id, bytes + 1 as size,
                   xor(list_reduce([4294967295::bigint] || list_transform(range(bytes), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::bigint),
                       lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32,
                   {jump_sql("doc_id", SHARDS)} as shard, {jump_sql("doc_id", SHARDS + 1)} as grown_shard
            from texts, crcs
        )
        select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard,
               row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard
        from placed
    """,
    "op1_exact_top_k": """
        with usable as (
            select vec_id, list_transform(embedding, lambda x: floor(256.0 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
            from usable q join usable c on c.vec_id <> q.vec_id
            where q.vec_id % 50 = 0
        ),
        ranked as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}
