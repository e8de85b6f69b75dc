"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern. The first tier is a minimal perfect hash over the vocabulary:
every pre-token of a batch is hashed, put into its one possible slot and compared byte by byte with the entry there, all
in array operations; a pre-token that is an entry is one id. Each other one takes the second tier: its bytes become a
linked list, and the adjacent pair whose union has the lowest rank is popped from a heap until no pair is an entry. The
heaps of short pre-tokens are arrays and step together; a long one has a heap of its own.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache, cached_property
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, by_bytes
from tariffmart.llm.pieces import Recent, no_collection, tokenizer_file

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Letters and numbers that the pattern library here knows from later versions of Unicode than the
#: vocabulary's library, for which they are neither.
NEWER = re.compile(
    "[\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f]"
)
#: Characters among which letters are those named here, numbers the ten digits and white space that of ASCII.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN = re.compile(rf"[\x00-\x7f{LETTERS}\u00a1\u00ab\u00bb\u00bf\u2010-\u2027]*")


@cache
def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def plain_pattern(pattern: str) -> str | None:
    """The pattern for texts of LATIN alone, where plain classes stand for those of Unicode; None if others are left."""
    classes = [(r"[^\s\p{L}\p{N}]", rf"[^ \t-\r{LETTERS}0-9]"), (r"\p{L}", f"[{LETTERS}]"), (r"\p{N}", "[0-9]"), (r"\s", r"[ \t-\r]"), (r"\S", r"[^ \t-\r]")]
    for general, plain in classes:
        pattern = pattern.replace(general, plain)
    return None if regex.search(r"\\[pPwWdDbB]", pattern) else pattern


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them well."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """A minimal perfect hash of n different 64-bit hashes, by hash and displace: they take the slots 0 to n - 1.

    Hashes meet in buckets. Buckets of several hashes come first, the largest ahead, and each takes a displacement that
    sends all its hashes to free slots; single hashes then take the slots that are left, which they name.
    """

    def __init__(self, keys: np.ndarray):
        self.n = n = len(keys)
        bucket = (keys % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        sizes = np.diff(cuts, append=n)
        self.moves = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        for size in range(int(sizes.max()), 1, -1):
            open_ = cuts[sizes == size]  # the buckets of this size without a displacement yet
            for move in range(1, 1 << 16):
                if not len(open_):
                    break
                slots = self.moved(keys[order[open_[:, None] + np.arange(size)]], np.uint64(move))
                taken = np.full(n, len(open_))
                turn = np.repeat(np.arange(len(open_)), size)
                np.minimum.at(taken, slots.ravel(), turn)  # the first bucket that wants a slot gets it
                good = (free[slots] & (taken[slots] == np.arange(len(open_))[:, None])).all(axis=1)
                good &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                self.moves[bucket[order[open_[good]]]] = move
                free[slots[good]] = False
                open_ = open_[~good]
            if len(open_):
                raise ValueError("two keys are equal")
        self.moves[bucket[order[cuts[sizes == 1]]]] = -1 - np.flatnonzero(free)

    def moved(self, keys: np.ndarray, move: np.ndarray) -> np.ndarray:
        return (scrambled(keys + np.asarray(move, np.uint64) * np.array([0x9E3779B97F4A7C15], np.uint64)) % np.uint64(self.n)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The only slot where each number may be."""
        move = self.moves[(keys % np.uint64(self.n)).astype(np.int64)]
        return np.where(move < 0, -1 - move, self.moved(keys, move.astype(np.uint64)))


class Words:
    """Byte strings that lie one after the other in ``data``: their starts, lengths and 64-bit hashes."""

    def __init__(self, strings: list[bytes], weights: np.ndarray):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.data)) - np.repeat(self.starts, self.lengths)  # of each byte in its string
        np.minimum(self.place, len(weights) - 1, out=self.place)  # longer strings than any entry are told by length
        terms = (self.data + np.uint64(1)) * weights[self.place]
        self.hashes = scrambled(np.add.reduceat(terms, self.starts)) if strings else np.zeros(0, np.uint64)


class Entries:
    """The first tier: which byte strings are entries of a vocabulary, told by a minimal perfect hash."""

    def __init__(self, entries: list[bytes]):
        longest, rng = max(map(len, entries)), np.random.default_rng(12)
        while True:  # until all hashes differ, which they nearly always do at once
            self.weights = rng.integers(0, 1 << 63, longest + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            own = Words(entries, self.weights)
            if len(np.unique(own.hashes)) == len(entries):
                break
        self.hash = PerfectHash(own.hashes)
        self.entry = np.argsort(self.hash.slots(own.hashes))  # the entry in each slot
        self.lengths, self.starts = own.lengths[self.entry], own.starts[self.entry]
        self.data = np.concatenate([own.data, np.zeros(longest + 1, np.uint8)])

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The number of each string among the entries, or -1: equal to the entry in its slot, byte by byte."""
        if not strings:
            return np.zeros(0, np.int64)
        asked = Words(strings, self.weights)
        slot = self.hash.slots(asked.hashes)
        same = self.data[np.repeat(self.starts[slot], asked.lengths) + asked.place] == asked.data
        equal = np.logical_and.reduceat(same, asked.starts) & (self.lengths[slot] == asked.lengths)
        return np.where(equal, self.entry[slot], -1)


class Unions:
    """Which two entries make a third one, for arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.width = np.uint64(max(ranks.values()).bit_length())
        made = [
            (left, right, rank)
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
        ]
        left, right, rank = np.array(made, np.int64).T
        keys = self.keys(left, right)
        self.hash = PerfectHash(scrambled(keys))
        order = np.argsort(self.hash.slots(scrambled(keys)))
        self.key, self.rank = keys[order], rank[order]

    def keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << self.width | right.astype(np.uint64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each union, or -1; a symbol below 0 makes none."""
        keys = self.keys(left, right)
        slot = self.hash.slots(scrambled(keys))
        return np.where((self.key[slot] == keys) & (left >= 0) & (right >= 0), self.rank[slot], -1)


NONE = np.int64(1) << 62


def merged_together(symbols: np.ndarray, unions: Unions) -> np.ndarray:
    """Byte-pair merging of many words at once: a row of ``symbols`` is a word, filled up with -1; merged ones become -1.

    Each word has a heap of its own over its linked symbols: a tree of minima, held as an array, whose leaves are the
    ranks of the pairs that start at its symbols and whose root is the lowest, leftmost among equals. In every step each
    word with a pair left pops its root, merges there, and lets the pairs of the new symbol rise from their leaves.
    """
    words, longest = symbols.shape
    width = 1 << max(1, int(longest - 1).bit_length())
    symbol = np.full((words, width + 1), -1, np.int64)
    symbol[:, :longest] = symbols
    after = np.tile(np.arange(1, width + 2), (words, 1))
    before = np.tile(np.arange(-1, width), (words, 1))
    tree = np.full((words, 2 * width), NONE)
    rank = unions.ranks(symbol[:, :-1].ravel(), symbol[:, 1:].ravel()).reshape(words, width)
    shift = width.bit_length()
    tree[:, width:] = np.where(rank >= 0, rank << shift | np.arange(width), NONE)
    level = width
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    row = np.flatnonzero(tree[:, 1] < NONE)
    flat_symbol, flat_after, flat_before, flat_tree = symbol.ravel(), after.ravel(), before.ravel(), tree.ravel()
    while len(row):
        link, root = row * (width + 1), row * (2 * width)
        top = flat_tree[root + 1]
        here, new = top & ((1 << shift) - 1), top >> shift
        gone = flat_after[link + here]
        end = flat_after[link + gone]
        flat_symbol[link + here], flat_symbol[link + gone] = new, -1
        flat_after[link + here] = end
        last = end >= width  # no symbol follows, not even an empty one
        flat_before[(link + end)[~last]] = here[~last]
        back = flat_before[link + here]
        ahead = flat_symbol[link + np.minimum(end, width)]
        behind = np.where(back >= 0, flat_symbol[link + back], -1)
        flat_tree[root + width + gone] = NONE
        for left, right, leaf in ((new, ahead, here), (behind, new, np.where(back >= 0, back, here))):
            made = unions.ranks(left, right)
            at = root + width + leaf
            known = back >= 0 if leaf is not here else True
            flat_tree[at] = np.where(known, np.where(made >= 0, made << shift | leaf, NONE), flat_tree[at])
        nodes = np.stack([width + gone, width + here, width + np.where(back >= 0, back, here)])
        for _ in range(shift - 1):
            nodes >>= 1
            below = root + 2 * nodes
            flat_tree[root + nodes] = np.minimum(flat_tree[below], flat_tree[below + 1])
        row = row[flat_tree[root + 1] < NONE]
    return symbol[:, :longest]


class ByteCoder:
    """Texts to ids and back by the ranks of one vocabulary file, whose ids are its ranks."""

    def __init__(self, name: str, pattern: str, together: int = 64, kept: int = 150_000):
        with open(tokenizer_file(name), "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.single = [array("I", [rank]).tobytes() for rank in self.ranks.values()]
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.together = together
        self.known = Recent(kept)
        self.cut_any = regex.compile(pattern).findall
        latin = plain_pattern(pattern)
        self.cut_latin = latin and re.compile(latin).findall

    @cached_property
    def entries(self) -> Entries:
        return Entries(list(self.ranks))

    @cached_property
    def unions(self) -> Unions:
        return Unions(self.ranks)

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if self.cut_latin and LATIN.fullmatch(text):
            return self.cut_latin(text)
        known = NEWER.sub("\ue000", text)  # a character that is in no class, each for one
        cut = self.cut_any(known)
        if known == text:
            return cut
        ends = list(accumulate(map(len, cut)))
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge(self, piece: bytes) -> bytes:
        """The ids of a pre-token by merging on a linked list of its bytes, lowest rank first and leftmost among equals."""
        n, get = len(piece), self.ranks.get
        after, before = [*range(1, n + 1)], [*range(-1, n)]  # node i holds piece[i : after[i]]
        rank = [get(piece[i : i + 2]) for i in range(n - 1)] + [None]  # of the pair that starts at a node
        heap = [(r, i) for i, r in enumerate(rank) if r is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if rank[i] != r:
                continue  # one of the two has merged meanwhile
            j = after[i]
            after[i] = end = after[j]
            before[end], rank[j] = i, None
            rank[i] = get(piece[i : after[end]]) if end < n else None
            if (h := before[i]) >= 0:
                rank[h] = get(piece[h:end])
            for at in (h, i):
                if at >= 0 and rank[at] is not None:
                    heappush(heap, (rank[at], at))
        at, out = 0, []
        while at < n:
            out.append(self.ranks[piece[at : after[at]]])
            at = after[at]
        return array("I", out).tobytes()

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token: short ones by heaps that step together, those of similar length in one table."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out: list[bytes] = [b""] * len(pieces)
        low = 0
        for high in [2**k for k in range(2, self.together.bit_length())]:
            alike = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            for at in range(0, len(alike), 1 << 12):
                group = alike[at : at + (1 << 12)].tolist()
                table = np.full((len(group), high), -1, np.int64)
                raw = np.frombuffer(b"".join([pieces[g] for g in group]), np.uint8)
                table[np.arange(high) < lengths[group][:, None]] = self.byte[raw]
                table = merged_together(table, self.unions)
                ids = table[table >= 0].astype("<u4").tobytes()
                ends = (4 * np.cumsum((table >= 0).sum(axis=1))).tolist()
                for g, a, b in zip(group, [0, *ends], ends, strict=False):
                    out[g] = ids[a:b]
        for g in np.flatnonzero(lengths > low):
            out[g] = self.merge(pieces[g])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; each distinct pre-token is looked up once."""
        cuts = [self.cut(t) for t in texts]
        words = list(set(chain.from_iterable(cuts)))
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        found = self.entries.find(raws)
        single = self.single
        ids = {w: single[at] for w, at in zip(words, found.tolist(), strict=True) if at >= 0}
        missed = [raws[m] for m in np.flatnonzero(found < 0).tolist()]
        ids.update(zip([words[m] for m in np.flatnonzero(found < 0).tolist()], self.known.all(missed, self.merge_all), strict=True))
        return [b"".join(map(ids.__getitem__, cut)) for cut in cuts]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids, as little-endian unsigned 32-bit numbers, stand for."""
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))


@cache
def coder(name: str, pattern: str) -> ByteCoder:
    return ByteCoder(name, pattern)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None, batch_bytes: int = 1 << 21) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): ids as little-endian unsigned 32-bit numbers.

    Each match of ``pattern`` is encoded by itself; special strings are ordinary text. One row for each input row,
    repeated rows included; a null or empty text has no ids; a null doc_id stays null. Whole texts are encoded whatever
    their length, about ``batch_bytes`` of them at a time, a longer one by itself. Merged pre-tokens stay in a dictionary
    of the Python worker whose size is bounded. Other columns are ignored; nothing is shuffled.
    """
    pattern = pattern or public_pattern()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocabulary, pattern)
        for batch in by_bytes(batches, 1, batch_bytes):
            with no_collection():
                ids = own.encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    slim = argument(docs, "doc_id", "text")
    return slim.mapInArrow(mapped, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None, batch_bytes: int = 1 << 19) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``encoded`` (doc_id, ids): the bytes that the ids stand for.

    Null ids decode to no bytes; an id outside the vocabulary raises KeyError, since no bytes stand for it.
    """
    pattern = pattern or public_pattern()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocabulary, pattern)
        for batch in by_bytes(batches, 1, batch_bytes):
            made = [own.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], ["doc_id", "ids", "decoded"])

    slim = argument(encoded, "doc_id", "ids")
    return slim.mapInArrow(mapped, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def code_digests(decoded: DataFrame) -> DataFrame:
    """The number of ids and the digests of ids and decoded bytes."""
    count = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return decoded.select("doc_id", count, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
