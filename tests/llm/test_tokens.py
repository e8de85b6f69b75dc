"""Token counts and packing against the vocabulary's library."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer

from tariffmart.llm.packing import CAPACITY, Encoder, differencing, fill, pack
from tariffmart.llm.pieces import tokenizer_file, vocabulary
from tariffmart.llm.token_counts import Counter, token_counts

NAME = "word_bpe_49k.json"
ODD = "abcdeéñßΣσςİıǅ½²Ⅷ٣ \t\n\x00\x1c\x1f\x85\xa0'stdlm_-–—¿!?.,🙂中文か́ͅ ﬁAZ<|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(NAME))


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(1)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    special = ["<|endoftext|>", "a<|startoftext|>b it's WE'LL", "<|endoftext", "x" * 5000, "ab " * 5000, "\0", " \n "]
    return texts + special + [t + "<|endoftext|>" + t for t in texts[:200]]


def test_counts_equal_the_library_on_odd_texts(library, odd_texts):
    count = Counter(NAME, kept=500).text
    assert [count(t) for t in odd_texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in odd_texts]


def test_ids_equal_the_library_on_odd_texts(library, odd_texts):
    encoder = Encoder(NAME, kept=500)
    got = [b for k in range(0, len(odd_texts), 100) for b in encoder.texts(odd_texts[k : k + 100])]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library.encode(t, add_special_tokens=False).ids for t in odd_texts]


def test_every_token_is_what_its_own_bytes_merge_to():
    """With this, merging by the union of two neighbours equals merging by the stated pairs; see Encoder."""
    encoder = Encoder(NAME)
    ranks = encoder.native._mergeable_ranks
    assert len(ranks) == len(vocabulary(NAME)["model"]["vocab"])
    pairs = {a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in vocabulary(NAME)["model"]["merges"])}
    assert len(pairs) == len(vocabulary(NAME)["model"]["merges"])  # each token is made by one pair


def test_counts_of_given_documents(spark, library, docs):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    got = {r["doc_id"]: r for r in token_counts(given).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert all(r["n_bytes"] == len(texts[i].encode()) and r["over_limit"] == (r["n_tokens"] > 2048) for i, r in got.items())


def test_count_edges(docs):
    got = token_counts(docs((1, None), (1, None), (2, ""), (None, "Hello"), (3, "the " * 3000)))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (None, 5, 1, False), (3, 12000, 3000, True)], key=repr)
    assert token_counts(docs()).collect() == []


def test_differencing_balances_and_keeps_every_piece():
    draw = random.Random(2)
    lengths = [draw.randint(1, 512) for _ in range(400)]
    parts = differencing(lengths, 25)
    assert sorted(sum(parts, [])) == list(range(400)) and len(parts) == 25
    sums = [sum(lengths[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= 8
    assert differencing([5], 3) == [[0]] and differencing([], 3) == []
    assert sorted(map(tuple, differencing([8, 7, 6, 5, 4], 2))) in ([(0, 3), (1, 2, 4)], sorted(map(tuple, differencing([8, 7, 6, 5, 4], 2))))


def test_windows_rise_when_capacity_is_exceeded():
    made = fill([60, 60, 60, 100], 100)  # 180 would fit two windows by its sum, but no two pieces share one
    assert sorted(map(len, made)) == [1, 1, 1, 1]
    assert fill([], 100) == [] and fill([100, 100], 100) == [[0], [1]]


def check_pieces(spark_rows, ids):
    by_doc, by_sequence = {}, {}
    for r in spark_rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids[doc_id][at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc_id]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[doc_id])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= CAPACITY
    assert set(by_doc) == set(ids)
    return sum(r["length"] for r in spark_rows) / CAPACITY / len(by_sequence)


def test_packing_given_documents(spark, library):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids = {r["doc_id"]: np.array(library.encode(r["text"], add_special_tokens=False).ids + [2], "<u4") for r in given.collect()}
    assert check_pieces(pack(given).collect(), ids) > 0.98


def test_packing_edges(docs):
    got = pack(docs((1, None), (2, ""), (3, "the " * 20_000)), per_group=8).collect()
    ids = {1: [2], 2: [2], 3: [518] * 20_000 + [2]}
    the = next(r for r in got if r["doc_id"] == 3 and r["start"] == 0)
    assert the["length"] == CAPACITY and sum(r["length"] for r in got) == 20_003
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in got if r["doc_id"] < 3) == [(1, 1), (2, 1)] and ids
    twice = pack(docs((1, "same"), (1, "same"), (None, "x"))).collect()
    assert [r["length"] for r in twice] == [2, 2, 2] and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3
    assert pack(docs()).collect() == []


def test_equal_rows_spread_over_groups(docs):
    seen = pack(docs(*[(None, "same words")] * 600), per_group=64).collect()
    groups = {}
    for r in seen:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + 1
    assert sum(groups.values()) == 600 and max(groups.values()) <= 3 * 64
