"""Runs of words against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tariffmart.llm.periodic import crc_rewrite, periodic_runs, run_digests, runs_of


def brute(words: list) -> list[tuple[int, int, int]]:
    """All runs by definition: for each period, the maximal stretches that are long enough and have no smaller period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def digest(lines: str) -> str:
    return hashlib.sha256(lines.encode()).hexdigest()


def expected(doc_id, text, rewrite=True) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = digest("".join(f"{s},{length},{q}\n" for s, length, q in runs))
    kept = digest(" ".join(w for i, w in enumerate(words) if i not in gone))
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], lines, kept)


def periodic(draw: random.Random, n: int) -> list[int]:
    letters = draw.choice([1, 2, 2, 3, 50])
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randint(0, 3)):
        if n > 8:
            a = draw.randrange(n)
            p, end = draw.randint(1, max(1, (n - a) // 3)), draw.randint(a, n)
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_brute_force_on_several_texts_at_a_time():
    draw = random.Random(5)
    for trial in range(400):
        texts = [periodic(draw, draw.randint(0, 90 if trial % 20 else 600)) for _ in range(draw.randint(1, 6))]
        bounds = np.concatenate([[0], np.cumsum(list(map(len, texts)))]).astype(int)
        got = runs_of(np.array(sum(texts, []), np.int64), bounds)
        assert [tuple(r) for r in got.tolist()] == [(s + at, n, q) for t, at in zip(texts, bounds, strict=False) for s, n, q in brute(t)]


def test_runs_of_runs_and_words_without_end():
    word = [0]
    for _ in range(6):
        word = word * 5 + [max(word) + 1]  # runs inside the period of longer runs
    assert [tuple(r) for r in runs_of(np.array(word[:1200]), np.array([0, 1200])).tolist()] == brute(word[:1200])
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 900:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert runs_of(np.array(fibonacci[1]), np.array([0, len(fibonacci[1])])).tolist() == []  # no fourth power
    same = runs_of(np.zeros(100_000, np.int64), np.array([0, 100_000]))
    assert same.tolist() == [[0, 100_000, 1]]


def test_query_on_given_documents(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = run_digests(periodic_runs(given, rewrite=crc_rewrite))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    small = [r for r in given.collect() if len(r["text"] or "") < 20_000]
    found = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(found) == given.count() and any(r[1] for r in found.values())
    for r in small:
        assert found[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_edges(spark, docs):
    planted = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    phrase = "to be or not to be "
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "a a a a a", "a a a a a a", "x " + phrase * 5 + "y", "ab ab ab ab ab ab ab ab", "a\x1ca a\x1ca " * 9, "Wort " * 5000]
    rows = [(planted if i % 2 else planted + 1, t) for i, t in enumerate(texts)] + [(None, phrase * 4), (None, phrase * 4), (planted, phrase * 30)]
    for rewrite in (None, crc_rewrite):
        got = run_digests(periodic_runs(docs(*rows), rewrite=rewrite, batch_bytes=200)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t, bool(rewrite)) for i, t in rows), key=repr)
    assert periodic_runs(docs()).collect() == []
    one = periodic_runs(docs((1, "x " + phrase * 5 + "y"))).first()
    assert [tuple(r) for r in one["runs"]] == [(1, 30, 6)] and one["collapsed"] == "x to be or not to be y"
