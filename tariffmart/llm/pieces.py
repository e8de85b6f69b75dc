"""How the word-end BPE vocabulary cuts a text before any merge: normalised words, found once for each distinct chunk.

White space never lies inside a word of this vocabulary, so a text is split at it and each distinct chunk is cut once;
the chunk also holds whole special strings, since they contain no white space. Chunks and words already seen stay in
dictionaries of the Python worker, which are emptied when they reach a bound; that changes the time, not the result.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import regex

#: The cut into words that the vocabulary file states, with white space as its library counts it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: Python splits at these four as well, the vocabulary's library does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
CHUNKS = regex.compile(rf"[^{SPACE}]+")
LONGEST_KEPT = 64


@cache
def tokenizer_file(name: str) -> str:
    """The vocabulary file's place on this machine: a path as it is, a bare name among the installed public ones."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(name: str) -> dict:
    """The vocabulary file as it is; whoever needs it takes out what it keeps."""
    with open(tokenizer_file(name), encoding="utf-8") as file:
        return json.load(file)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """A text split at white space."""
    return CHUNKS.findall(text) if ODD_SPACE.search(text) else text.split()


def words(chunk: str) -> list[str]:
    """A chunk without special strings: composed, in lower case, cut into words."""
    if chunk.isascii():
        low = chunk.lower()
        return [low] if low.isalpha() else ASCII_WORDS.findall(low)
    low = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
    return [low] if low.isalpha() else WORDS.findall(low)


@contextmanager
def no_collection() -> Iterator[None]:
    """Without walks of the garbage collector, for work that makes no cycles beside large dictionaries of words.

    Afterwards the collector runs as before: a worker lives on, and other tasks may leave cycles behind.
    """
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Bounded(dict):
    """A dictionary of results by short key that starts afresh at a bound."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def keep(self, key: str, value):
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Recent:
    """Results by short key, kept in two generations of at most ``most`` entries each.

    When the young generation is full it becomes the old one, and the old one goes. A key found in the old one moves to
    the young one, so what is asked for often stays. Forgetting changes the time, not the result.
    """

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def all(self, keys: list, make: Callable[[list], list]) -> list:
        """The result of each of the different ``keys``; those not kept are made in one call."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, keys))
        away = [i for i, value in enumerate(found) if value is None]
        if away:
            for i in away:
                found[i] = self.old.get(keys[i])
            new = [i for i in away if found[i] is None]
            for i, value in zip(new, make([keys[i] for i in new]), strict=True):
                found[i] = value
            self.young.update((keys[i], found[i]) for i in away if len(keys[i]) <= LONGEST_KEPT)
        return found
