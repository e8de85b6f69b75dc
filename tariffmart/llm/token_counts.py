"""Token counts without tokens: byte-pair merging on a heap and a linked list.

A word starts as one symbol for each UTF-8 byte. The adjacent pair of lowest rank is popped from a heap, its two
symbols become one node of the list, and the pairs with its new neighbours are pushed. Each merge takes one symbol
away, so the count is the symbols at the start less the merges; no id is ever put out.
"""

from __future__ import annotations

import heapq
from functools import cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import annotated, argument
from tariffmart.llm.pieces import Bounded, byte_symbols, chunks, no_collection, vocabulary, words

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


class Counter:
    """Counts tokens of texts for one vocabulary."""

    def __init__(self, name: str, kept: int = 400_000):
        file = vocabulary(name)
        ids, end = file["model"]["vocab"], file["model"]["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.inner = [ids[s] for s in byte_symbols()]
        self.last = [ids[s + end] for s in byte_symbols()]
        self.ranks = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        special = sorted((t["content"] for t in file["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.by_chunk, self.by_word = Bounded(kept), Bounded(2 * kept)

    def word(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n, ranks = len(symbols), self.ranks
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, merged, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # one of the two has merged meanwhile
            merges += 1
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (pair := (merged, symbols[k])) in ranks:
                    heapq.heappush(heap, (*ranks[pair], i, *pair))
            if (h := before[i]) >= 0 and (pair := (symbols[h], merged)) in ranks:
                heapq.heappush(heap, (*ranks[pair], h, *pair))
        return n - merges

    def chunk(self, chunk: str) -> int:
        specials = len(self.special.findall(chunk))
        total = specials
        for part in self.special.split(chunk) if specials else (chunk,):
            for word in words(part):
                n = self.by_word.get(word)
                total += self.by_word.keep(word, self.word(word)) if n is None else n
        return total

    def text(self, text: str | None) -> int:
        total, known = 0, self.by_chunk.get
        for chunk in chunks(text or ""):
            n = known(chunk)
            total += self.by_chunk.keep(chunk, self.chunk(chunk)) if n is None else n
        return total


@cache
def counter(name: str) -> Counter:
    return Counter(name)


def token_counts(docs: DataFrame, vocabulary_name: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    One row for each input row, repeated rows included; a null or empty text has no bytes and no tokens; a null doc_id
    stays null. Texts are counted whole, whatever their length. Other columns are ignored.
    """

    def counted(texts: list[str | None]) -> list[list[int]]:
        with no_collection():
            return [list(map(counter(vocabulary_name).text, texts))]

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    slim = argument(docs, "doc_id", "text").withColumn("n_bytes", n_bytes)
    out = annotated(slim, ["text"], counted, "n_tokens long", keep=["doc_id", "n_bytes"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
