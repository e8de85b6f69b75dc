"""Packing of token pieces into windows of equal capacity by multiway differencing (Karmarkar and Karp).

Every piece starts as a partial partition with one filled window. The two partial partitions of widest spread are
merged, the fullest window of one with the emptiest of the other, so that opposing imbalances cancel, until one
partition is left. If its fullest window exceeds the capacity, the number of windows rises and the merging runs anew.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterable
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import annotated, argument, parts_for, place_hash, written
from tariffmart.llm.pieces import ODD_SPACE, Recent, byte_symbols, no_collection, tokenizer_file, vocabulary, words

VOCABULARY = "word_bpe_49k.json"
END = 2
CAPACITY = 4096


class Encoder:
    """Texts to their ids as little-endian unsigned 32-bit bytes, each distinct word encoded once.

    Words go through a byte-pair merger in native code, many in one call. It knows the vocabulary as byte strings, with
    a zero byte for the end of a word, so a word's last byte and its end are the first pair to merge. It merges any two
    neighbours whose union is a token, which gives the stated merges wherever every token's own bytes lead to that
    token; the tests hold it against the vocabulary's library. Odd texts (special strings, zero bytes, separators that
    only Python counts as space) go to that library as they are.
    """

    def __init__(self, name: str, kept: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        file = vocabulary(name)
        ids, end = file["model"]["vocab"], file["model"]["end_of_word_suffix"]
        self.name = name
        self.special = [t["content"] for t in file["added_tokens"]]
        symbols = byte_symbols()
        byte_of = {symbol: byte for byte, symbol in enumerate(symbols)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        tokens = [*symbols, *(s + end for s in symbols), *("".join(m) for m in merges)]
        raw = [bytes(byte_of[c] for c in t.removesuffix(end)) + b"\0" * t.endswith(end) for t in tokens]
        self.native = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks={r: i for i, r in enumerate(raw)}, special_tokens={})
        self.ids = np.array([ids[t] for t in tokens], "<u4")
        self.ends = np.array([t.endswith(end) for t in tokens])
        self.known = Recent(kept)

    @cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer_file(self.name))

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def split(self, fresh: list[str]) -> list[bytes]:
        """The ids of each word: every word's last id, and no other, is one that ends a word."""
        if not fresh:
            return []
        ranks = np.asarray(self.native.encode_ordinary("\0".join(fresh) + "\0"))
        stops = (4 * (np.flatnonzero(self.ends[ranks]) + 1)).tolist()
        raw = self.ids[ranks].tobytes()
        return [raw[a:b] for a, b in zip(chain([0], stops[:-1]), stops, strict=True)]

    def chunks(self, new: list[str]) -> list[bytes]:
        """The ids of each chunk of a text between white space; each distinct word of them is merged once."""
        odd = {c for c in new if "\0" in c or "<" in c and any(s in c for s in self.special)}
        cut = {c: words(c) for c in new if c not in odd}
        distinct = list(set(chain.from_iterable(cut.values())))
        ids = dict(zip(distinct, self.split(distinct), strict=True))
        return [self.whole(c) if c in odd else b"".join([ids[w] for w in cut[c]]) for c in new]

    def texts(self, batch: list[str | None]) -> list[bytes]:
        """The ids of each text; a null text has none."""
        cuts = [None if ODD_SPACE.search(t) else t.split() for t in (t or "" for t in batch)]
        here = list(set(chain.from_iterable(c for c in cuts if c)))
        ids = dict(zip(here, self.known.all(here, self.chunks), strict=True))
        return [self.whole(t) if c is None else b"".join(map(ids.__getitem__, c)) for t, c in zip(batch, cuts, strict=True)]


@cache
def encoder(name: str) -> Encoder:
    return Encoder(name)


def token_pieces(docs: DataFrame, vocabulary_name: str, end: int, capacity: int, longest: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full windows first, then what is left in pieces of ``longest``."""
    last = np.asarray([end], "<u4").tobytes()

    def pieces(ids: bytes) -> list[dict[str, int]]:
        n, start, out = len(ids) // 4, 0, []
        while start < n:
            length = capacity if n - start >= capacity else min(longest, n - start)
            out.append({"start": start, "length": length, "ids_crc32": zlib.crc32(ids[4 * start : 4 * (start + length)])})
            start += length
        return out

    def cut(texts: list[str | None]) -> list[list]:
        made, tokens = [], []
        with no_collection():
            for ids in encoder(vocabulary_name).texts(texts):
                made.append(pieces(ids + last))
                tokens.append(len(ids) // 4 + 1)
        return [made, tokens]

    schema = "piece array<struct<start: long, length: long, ids_crc32: long>>, doc_tokens long"
    found = annotated(argument(docs, "doc_id", "text"), ["text"], cut, schema, keep=["doc_id"])
    return found.select("doc_id", F.explode("piece").alias("piece"), "doc_tokens").select("doc_id", "piece.*", "doc_tokens")


def differencing(lengths: Iterable[int], windows: int) -> list[list[int]]:
    """A partition of ``lengths`` into at most ``windows`` lists of positions with near-equal sums.

    A partial partition holds the sums of its filled windows, in falling order, and for each the tree of its positions.
    """
    lengths = list(lengths)
    trees: list[tuple[int, int] | None] = [None] * len(lengths)  # a leaf, or the two trees that were joined
    heap = [(-n, i, np.array([n]), np.array([i])) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    turn = len(lengths)
    while len(heap) > 1:
        _, _, sums, tops = heapq.heappop(heap)
        _, _, other, other_tops = heapq.heappop(heap)
        met = max(0, len(sums) + len(other) - windows)  # so many filled windows meet a filled one
        kept = len(sums) - met
        joined = sums[kept:] + other[len(other) - met :][::-1]
        made = np.arange(len(trees), len(trees) + met)
        trees += zip(tops[kept:].tolist(), other_tops[len(other) - met :][::-1].tolist(), strict=True)
        total = np.concatenate([sums[:kept], joined, other[: len(other) - met]])
        at = np.concatenate([tops[:kept], made, other_tops[: len(other) - met]])
        order = np.argsort(-total, kind="stable")
        total, at = total[order], at[order]
        spread = total[0] - (total[-1] if len(total) == windows else 0)
        turn += 1
        heapq.heappush(heap, (-int(spread), turn, total, at))

    def leaves(tree: int) -> list[int]:
        found, open_ = [], [tree]
        while open_:
            t = open_.pop()
            if trees[t] is None:
                found.append(t)
            else:
                open_ += trees[t]
        return found

    return [leaves(int(t)) for t in heap[0][3]] if heap else []


def fill(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: full pieces alone, the others by differencing with as few windows as hold them."""
    alone = [[i] for i, n in enumerate(lengths) if n == capacity]
    rest = [i for i, n in enumerate(lengths) if n < capacity]
    windows = parts_for(sum(lengths[i] for i in rest), capacity)
    while rest:
        made = differencing([lengths[i] for i in rest], windows)
        most = max(sum(lengths[rest[i]] for i in w) for w in made)
        if most <= capacity:
            return alone + [[rest[i] for i in w] for w in made]
        windows += 1
    return alone


def pack(
    docs: DataFrame,
    vocabulary_name: str = VOCABULARY,
    end: int = END,
    capacity: int = CAPACITY,
    longest: int = 512,
    per_group: int = 2048,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of ``docs`` (doc_id, text).

    A document is its ids and ``end``; null and empty texts are ``end`` alone. It is cut into full windows and pieces of
    at most ``longest`` ids, and each id lies in one piece. Each input row is a document of its own, so repeated rows
    give repeated pieces; a null doc_id stays null. Pieces are dealt by a hash of their place in the written table into
    groups of about ``per_group``, so neither a long document or source nor rows that are equal in all columns fill one;
    each group is packed by itself, which costs less than a window of padding for every group. Texts are encoded once and only lengths and checksums are shuffled.
    """
    pieces = written(token_pieces(docs, vocabulary_name, end, capacity, longest), "pieces")
    groups = parts_for(pieces.count(), per_group)
    keyed = pieces.withColumn("group", F.pmod(place_hash(), F.lit(groups)))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        lengths = table["length"].to_pylist()
        window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for k, members in enumerate(fill(lengths, capacity)):
            at = 0
            for i in sorted(members):
                window[i], offset[i] = k, at
                at += lengths[i]
        sequence = table["group"].to_numpy() * (1 << 32) + window
        return table.drop_columns(["group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return keyed.groupBy("group").applyInArrow(packed, schema)
