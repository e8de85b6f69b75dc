"""Byte-level BPE against the vocabulary's library, and back to the bytes."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tariffmart.llm.byte_bpe import VOCABULARY, ByteCoder, PerfectHash, code_digests, decode, encode, plain_pattern, scrambled

ODD = "abcdeéñßΣσςİ½²Ⅷ٣ \t\n\x00\x1c\x1f\x85\xa0'stdlm_-–—¿!?.,🙂中文か́ͅ ﬁAZ<|>՘࢏\U00018e00"
LATIN = "abcdeéñßİ\x00\x1c\x1f \t\n'stdlmrv_-–—¿!?.,AZ<|>ÿɏ’«12"


@pytest.fixture(scope="module")
def coder():
    return ByteCoder(VOCABULARY, public_tokenizers.PATTERN, kept=500)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def check(coder, library, texts):
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], coder.encode(texts[at : at + 500]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
            assert coder.decode(ids) == text.encode()


def test_ids_equal_the_library_on_odd_texts(coder, library):
    draw = random.Random(1)
    for letters in (ODD, LATIN):
        check(coder, library, ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)])
    check(coder, library, ["", "<|endoftext|>", "x" * 3000, "ab" * 2000, " " * 500, "é" * 700, "x" * 200 + " " + "\n" * 70, "中" * 50])


def test_every_character_class_equals_the_library(coder, library):
    points = [i for i in range(1, 0x30000) if not 0xD800 <= i < 0xE000]
    check(coder, library, ["".join(f"a{chr(i)}1 {chr(i)}{chr(i)}a  {chr(i)}\n" for i in points[k : k + 64]) for k in range(0, len(points), 64)])


def test_the_hash_is_perfect_and_minimal(coder):
    entries = list(coder.ranks)
    assert coder.entries.find(entries).tolist() == list(range(len(entries)))
    assert set(coder.entries.find([b"", b"\xff\xfe\xfd", b"x" * 999])[1:].tolist()) == {-1}
    for n in (1, 2, 3, 777):
        keys = scrambled(np.arange(n, dtype=np.uint64))
        assert sorted(PerfectHash(keys).slots(keys).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        PerfectHash(np.array([5, 5, 7], np.uint64))


def test_heaps_in_step_equal_one_heap(coder):
    draw = random.Random(2)
    words = list({bytes(draw.choice(b"abcdeinrstu \xc3\xa9") for _ in range(draw.randint(1, 70))) for _ in range(3000)})
    assert coder.merge_all(words) == [coder.merge(w) for w in words]


def test_a_pattern_of_its_own_and_its_plain_form(coder):
    assert "\\p" not in plain_pattern(public_tokenizers.PATTERN) and plain_pattern(r"\p{Lu}+|.") is None
    own = ByteCoder(VOCABULARY, r"\p{Lu}|[^\p{Lu}]+")
    library = tiktoken.Encoding("x", pat_str=r"\p{Lu}|[^\p{Lu}]+", mergeable_ranks=own.ranks, special_tokens={})
    check(own, library, ["Some Words hERE", "éÉ"])


def test_query_on_given_documents(spark, library):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = code_digests(decode(encode(given)))
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    found = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    for r in given.collect():
        ids = np.array(library.encode_ordinary(r["text"] or ""), "<u4")
        assert found[r["doc_id"]] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())


def test_edges(docs, spark, library):
    rows = [(1, None), (1, None), (2, ""), (None, "Hello"), (None, None), (3, "the " * 30_000), (3, "the " * 30_000), (4, "q" * 20_000)]
    got = decode(encode(docs(*rows), batch_bytes=100)).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in got) == sorted((i or 0, (t or "").encode()) for i, t in rows)
    assert {(r["doc_id"], len(r["ids"]) // 4) for r in got if r["doc_id"] != 4} == {(1, 0), (2, 0), (None, 1), (None, 0), (3, 30_001)}
    assert decode(encode(docs())).collect() == []
    assert bytes(decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).first()["decoded"]) == b""
