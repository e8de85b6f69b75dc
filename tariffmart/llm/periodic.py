"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch whose smallest period q fits into it at least four times. Periods below ``SMALLEST`` words are
found by themselves: the highly periodic regions where words equal those one, two or three places on. For every dyadic
scale t from there on, a synchronising set holds the positions whose window of t words has the least hash among the t + 1
windows that start at it and after it, or the last of these has; whether a position is in the set depends on its next 2t
words alone. Windows inside a region of period t/4 or less take no part, so the set is sparse; their periods are known
from smaller scales. In a run of period q, t <= q < 2t, some position of the set lies among the first t words, and the
next position of the set with the same 2t words is q later: two positions with an equal context in a row propose their
distance as a period. Every proposal is extended word by word, so hashes only save work and never make a run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, by_bytes

SMALLEST = 4  # the first scale; smaller periods have regions of their own
FOLD = 4  # a run holds its period at least so many times
SHORTEST = 6
NEVER = np.uint64(2**64 - 1)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit numbers (the finaliser of splitmix64); ``x`` is overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true."""
    edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def small_periods(words: np.ndarray) -> list[np.ndarray]:
    """(start, length, period) of the highly periodic regions of periods below the first scale."""
    found = []
    for q in range(1, SMALLEST):
        start, end = stretches(words[:-q] == words[q:])
        long = end - start >= (FOLD - 1) * q
        start, length = start[long], (end - start)[long] + q
        if q > 1:  # 2 and 3 are prime: a smaller period means equal words throughout
            own = (words[start[:, None] + np.arange(1, q)] != words[start][:, None]).any(axis=1)
            start, length = start[own], length[own]
        found.append(np.stack([start, length, np.full(len(start), q)], axis=1))
    return found


def agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words of two stretches agree."""
    at, size = 0, 32
    while True:
        x, y = a[at : at + size], b[at : at + size]
        n = min(len(x), len(y))
        if n == 0:
            return at
        differs = x[:n] != y[:n]
        if differs.any():
            return at + int(differs.argmax())
        at, size = at + n, 2 * size


def synchronising(hashes: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The positions of the synchronising set at scale ``t``, from the hashes of all windows of ``t`` words."""
    ids = np.where(periodic, NEVER, hashes)
    least, width = ids, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least, last = np.minimum(least[:-1], least[1:]), ids[t:]
    first = ids[: len(last)]
    least = least[: len(last)]
    return np.flatnonzero((least != NEVER) & ((least == first) | (least == last)))


def runs_of(texts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs in the concatenated word numbers of several texts, by start, then period.

    ``bounds`` holds where each text starts and, last, the end. Starts count in the concatenation.
    """
    sizes = np.diff(bounds)
    total = int(bounds[-1])
    # one word that occurs nowhere else before each text and after the last, so that nothing crosses a border
    home = np.arange(total) + np.repeat(np.arange(len(sizes)), sizes) + 1
    words = np.empty(total + len(sizes) + 1, np.int64)
    words[home] = texts
    fences = bounds + np.arange(len(bounds))
    words[fences] = -1 - np.arange(len(fences))
    found = small_periods(words)

    spans = sizes + 1  # each text with the fence after it
    place = np.arange(1, len(words))
    hashes = mixed(words[1:].astype(np.uint64) + np.uint64(1))
    t = 1
    while True:
        # hashes of windows of t words become those of 2t words, the context, and of the next scale's windows
        wide = np.empty_like(hashes)
        step = min(t, len(hashes))
        wide[: len(hashes) - step] = mixed(hashes[:-step] * np.uint64(0x9E3779B97F4A7C15) + hashes[step:])
        wide[len(hashes) - step :] = mixed(np.arange(step, dtype=np.uint64))
        if t >= SMALLEST:
            found.append(proposed(words, place, hashes, wide, t, np.concatenate(found)))
        t *= 2
        if t >= SMALLEST:  # texts too short for four periods of this scale are done
            keep = sizes >= FOLD * t
            if not keep.any():
                break
            if not keep.all():
                inside = np.repeat(keep, spans)
                place, wide, sizes, spans = place[inside], wide[inside], sizes[keep], spans[keep]
        hashes = wide
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= SHORTEST]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    runs[:, 0] -= np.searchsorted(fences, runs[:, 0])
    return runs


def proposed(words: np.ndarray, place: np.ndarray, hashes: np.ndarray, wide: np.ndarray, t: int, known: np.ndarray) -> np.ndarray:
    """The runs of period ``t`` to ``2t - 1``; ``place`` says where the hashed windows start in ``words``."""
    periodic = np.zeros(len(hashes) + 1, np.int64)
    regions = known[(known[:, 2] * FOLD <= t) & (known[:, 1] >= t)]
    if len(regions):
        at = np.searchsorted(place, regions[:, 0])
        there = (at < len(place)) & (place[np.minimum(at, len(place) - 1)] == regions[:, 0])
        np.add.at(periodic, at[there], 1)
        np.add.at(periodic, at[there] + regions[there, 1] - t + 1, -1)
    chosen = synchronising(hashes, t, np.cumsum(periodic)[:-1] > 0)
    context = wide[chosen]
    order = np.argsort(context, kind="stable")
    context, chosen = context[order], chosen[order]
    apart = chosen[1:] - chosen[:-1]
    pair = np.flatnonzero((context[1:] == context[:-1]) & (apart >= t) & (apart < 2 * t))
    found, reached = [], {}
    pair = pair[np.argsort(chosen[pair], kind="stable")]
    for s, q in zip(place[chosen[pair]].tolist(), apart[pair].tolist(), strict=True):
        if s < reached.get(q, 0):
            continue  # inside the stretch that an earlier pair of this distance gave
        end = s + agreement(words[s:], words[s + q :])
        start = s - agreement(words[:s][::-1], words[: s + q][::-1])
        reached[q] = end
        if end - start >= (FOLD - 1) * q:
            found.append((start, end - start + q, q))
    return np.array(found, np.int64).reshape(-1, 3)


def crc_rewrite(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Which texts are made periodic, from the word a on with period p: (a, p), or None. A null id leaves its text."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and where each text starts; words end at the six white characters of ASCII."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    parts, bounds = lists.flatten(), lists.offsets.to_numpy()
    real = pc.not_equal(pc.binary_length(parts), 0)  # white space at either end leaves an empty part
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return parts.filter(real), before[bounds - bounds[0]]


Rewrite = Callable[[int | None, int], tuple[int, int] | None]


def collapsed(texts: pa.Array, ids: list, rewrite: Rewrite | None) -> tuple[pa.Array, pa.Array]:
    """For each text its runs, and its words without those that a run repeats."""
    values, bounds = split_words(texts)
    coded = values.dictionary_encode()
    words = coded.indices.to_numpy()
    if rewrite:
        words = words.copy()
        for doc_id, low, high in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if made := rewrite(doc_id, high - low):
                first, period = low + made[0], made[1]
                words[first:high] = words[first + np.arange(high - first) % period]
    runs = runs_of(words, bounds)
    repeated = np.zeros(len(words) + 1, np.int64)
    np.add.at(repeated, runs[:, 0] + runs[:, 2], 1)
    np.add.at(repeated, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(repeated)[:-1] == 0
    kept_before = np.concatenate([[0], np.cumsum(kept)])
    lists = pa.ListArray.from_arrays(pa.array(kept_before[bounds], pa.int32()), coded.dictionary.take(pa.array(words[kept])))
    of_text = np.searchsorted(runs[:, 0], bounds)
    own = np.repeat(bounds[:-1], np.diff(of_text))
    structs = pa.StructArray.from_arrays([pa.array(runs[:, 0] - own), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN))
    return pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), structs), pc.binary_join(lists, " ")


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs`` (doc_id, text): its runs of words and its text without repeats.

    Words are what lies between the white characters of ASCII, numbered from 0. ``runs`` is an array of (start, length,
    period) by start, then period: stretches with smallest period ``period``, at least four times as long and of six
    words or more, that no neighbouring word extends. ``collapsed`` joins the words that stay by one space; a word goes
    if some run holds it after the run's first ``period`` words. ``rewrite`` may name texts to be made periodic first.

    One row for each input row, repeated rows included. A null or empty text, or one of white space alone, has no words,
    no runs and an empty ``collapsed``; a null doc_id stays null. Whole texts are searched whatever their length, about
    ``batch_bytes`` of them at a time, a longer text by itself. Other columns are ignored; nothing is shuffled.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, batch_bytes):
            runs, text = collapsed(batch.column(1), batch.column(0).to_pylist(), rewrite)
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, text], ["doc_id", "runs", "collapsed"])

    slim = argument(docs, "doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(mapped, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of each text of ``periodic_runs``: the number of runs, the one of greatest exponent, and digests of both results.

    Among equal exponents the run of smallest start, then period, counts; exponents are compared as exact fractions.
    """

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    best = F.reduce("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), better)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
