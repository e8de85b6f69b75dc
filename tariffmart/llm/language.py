"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes forwards and backwards and labels every position; a document's probabilities are the
mean over the positions that hold letters. It is small enough to be trained in numpy on the driver, by backpropagation
through time over a bounded sample of windows, and travels to the tasks with the function that applies it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import annotated, argument, crc_fold, map_frames

UNKNOWN = "und"
WINDOW = 64
#: Which bytes stand for letters, or parts of one, in lower-cased UTF-8.
LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """One direction's weights have 3 * hidden columns: reset gate, update gate, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]
    hidden: int

    @staticmethod
    def fresh(languages: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype("f4")

        weights = {"out": drawn(2 * hidden, len(languages), scale=0.3), "bias": np.zeros(len(languages), "f4")}
        for side in ("ahead", "back"):
            weights[f"{side}_in"] = drawn(256, 3 * hidden, scale=0.3)
            weights[f"{side}_state"] = drawn(hidden, 3 * hidden, scale=0.3)
        return Network(languages, weights, hidden)

    def states(self, side: str, codes: np.ndarray, tape: list | None = None) -> np.ndarray:
        """The state after each step, (steps, windows, hidden); ``codes`` is (steps, windows) in reading order."""
        h, w_in, w_state = self.hidden, self.weights[f"{side}_in"], self.weights[f"{side}_state"]
        state = np.zeros((codes.shape[1], h), "f4")
        out = np.empty((*codes.shape, h), "f4")
        for t, code in enumerate(codes):
            given, carried = w_in[code], state @ w_state
            gates = sigmoid(given[:, : 2 * h] + carried[:, : 2 * h])
            reset, update = gates[:, :h], gates[:, h:]
            candidate = np.tanh(given[:, 2 * h :] + reset * carried[:, 2 * h :])
            if tape is not None:
                tape.append((code, state, carried[:, 2 * h :], reset, update, candidate))
            state = candidate + update * (state - candidate)
            out[t] = state
        return out

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each position, (steps, windows, languages)."""
        both = np.concatenate([self.states("ahead", codes), self.states("back", codes[::-1])[::-1]], axis=2)
        return softmax(both @ self.weights["out"] + self.weights["bias"])

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradients, by backpropagation through time."""
        tapes: dict[str, list] = {"ahead": [], "back": []}
        both = np.concatenate([self.states("ahead", codes, tapes["ahead"]), self.states("back", codes[::-1], tapes["back"])[::-1]], axis=2)
        found = softmax(both @ self.weights["out"] + self.weights["bias"])
        n = codes.size
        error = found.copy()
        error[:, np.arange(len(labels)), labels] -= 1
        error /= n
        loss = -float(np.log(found[:, np.arange(len(labels)), labels] + 1e-9).mean())
        grads = {"out": np.tensordot(both, error, ((0, 1), (0, 1))), "bias": error.sum((0, 1))}
        back = error @ self.weights["out"].T
        h = self.hidden
        for side, above in (("ahead", back[:, :, :h]), ("back", back[::-1, :, h:])):
            w_state = self.weights[f"{side}_state"]
            d_in, d_state = np.zeros_like(self.weights[f"{side}_in"]), np.zeros_like(w_state)
            d_next = np.zeros((codes.shape[1], h), "f4")
            for (code, state, carried, reset, update, candidate), d_out in zip(reversed(tapes[side]), above[::-1], strict=True):
                d = d_out + d_next
                d_candidate = d * (1 - update) * (1 - candidate**2)
                d_update = d * (state - candidate) * update * (1 - update)
                d_reset = d_candidate * carried * reset * (1 - reset)
                d_given = np.concatenate([d_reset, d_update, d_candidate], axis=1)
                d_carried = np.concatenate([d_reset, d_update, d_candidate * reset], axis=1)
                np.add.at(d_in, code, d_given)
                d_state += state.T @ d_carried
                d_next = d * update + d_carried @ w_state.T
            grads[f"{side}_in"], grads[f"{side}_state"] = d_in, d_state
        return loss, grads

    def pooled(self, texts: list[str], windows: int = 4096) -> np.ndarray:
        """Mean probabilities over the letter positions of each whole text; zeros for a text without any.

        Texts are cut into windows of equal length, and many windows, of whatever text, are read side by side.
        """
        total, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for owner, codes, inside in batches(texts, windows):
            share = (self.positions(codes) * inside[:, :, None]).sum(0)
            np.add.at(total, owner, share)
            np.add.at(letters, owner, inside.sum(0))
        return total / np.maximum(letters, 1)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def batches(texts: list[str], windows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each window, bytes, whether each is a letter), bytes in reading order by column."""
    span, owners, held, size = WINDOW * windows, [], [], 0

    def ready() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer(b"".join(held), np.uint8).reshape(-1, WINDOW).T
        return np.repeat([o for o, _ in owners], [n for _, n in owners]), codes, LETTER[codes]

    for i, text in enumerate(texts):
        raw = text.lower().encode("utf-8", "replace")
        for at in range(0, len(raw), span):
            part = raw[at : at + span]
            part += b" " * (-len(part) % WINDOW)
            owners.append((i, len(part) // WINDOW))
            held.append(part)
            size += len(part)
            if size >= span:
                yield ready()
                owners, held, size = [], [], 0
    if held:
        yield ready()


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int, steps: int, seed: int = 7) -> Network:
    """Adam over random batches of (windows, WINDOW) bytes; batches draw every language equally often."""
    network, rng = Network.fresh(languages, hidden, seed), np.random.default_rng(seed)
    of = [np.flatnonzero(labels == k) for k in range(len(languages))]
    moment = {k: [np.zeros_like(w), np.zeros_like(w)] for k, w in network.weights.items()}
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(rows, -(-256 // len(languages))) for rows in of])
        _, grads = network.gradients(windows[drawn].T, labels[drawn])
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, (first, second) in moment.items():
            first += 0.1 * (grads[name] - first)
            second += 0.01 * (grads[name] ** 2 - second)
            network.weights[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return network


def training_windows(labelled: DataFrame, per_language: int, per_document: int = 4) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """At most about ``per_language`` documents of each language, chosen by a hash, and a few windows of each."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), []
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / counts[lang]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for seed, text, lang in zip(frame["seed"], frame["text"], frame["lang"], strict=True):
            raw = text.lower().encode("utf-8", "replace")
            rng = np.random.default_rng(seed)
            for at in rng.integers(0, max(1, len(raw) - WINDOW + 1), per_document):
                rows.append((raw[at : at + WINDOW].ljust(WINDOW), lang))
        return pd.DataFrame(rows, columns=["window", "lang"])

    seeded = labelled.where(draw < shares[F.col("lang")]).select("text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 31)).alias("seed"))
    chosen = map_frames(seeded, cut, "window binary, lang string")
    # the limit only guards against a table that repeats one chosen id without end
    got = chosen.limit(4 * per_document * per_language * len(languages)).toPandas()
    windows = np.frombuffer(b"".join(map(bytes, got["window"])), np.uint8).reshape(-1, WINDOW)
    present = sorted(set(got["lang"]))
    return windows, got["lang"].map({lang: k for k, lang in enumerate(present)}).to_numpy(int), present


def language_model(docs: DataFrame, folds: int = 5, held: int = 0, per_language: int = 1500, hidden: int = 8, steps: int = 400) -> Network | None:
    """A network learnt from the documents outside the held-out fold that have a text and a language; None without any.

    The sample is bounded by ``per_language`` documents a language; the number of languages is taken to be small.
    """
    slim = argument(docs, "doc_id", "text", "lang")
    usable = slim.where((crc_fold(F.col("doc_id"), folds) != held) & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    windows, labels, languages = training_windows(usable, per_language)
    return train(windows, labels, languages, hidden, steps) if languages else None


def languages_of(texts: list[str | None], network: Network | None) -> tuple[list[str], list[float]]:
    """The language of each text and its pooled probability; ``und`` and 0 without a letter or a network."""
    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    lettered = [i for i, t in enumerate(texts) if t and network and next(filter(str.isalpha, t), None)]
    if lettered:
        pooled = network.pooled([texts[i] for i in lettered])
        for i, k, p in zip(lettered, pooled.argmax(1), pooled.max(1), strict=True):
            languages[i], scores[i] = network.languages[k], float(min(1.0, p))
    return languages, scores


def predict_language(docs: DataFrame, network: Network | None, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text).

    Whole texts are read. A null text, an empty one or one without a letter is ``und`` with score 0, and so is every
    text if nothing could be learnt. Equal pooled probabilities go to the first language by name. Repeated rows give
    repeated rows; other columns are ignored, and none but the text is an input.
    """

    slim = argument(docs, "doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    told = annotated(slim, ["text"], lambda texts: list(languages_of(texts, network)), "lang_pred string, score double", keep=["doc_id", "held_out"])
    return told.select("doc_id", "held_out", "lang_pred", "score")


def with_known_language(docs: DataFrame, network: Network | None, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is told with a pooled probability of ``least`` or more, with all their columns.

    Rows without a letter go, and so do those on which the network spreads its belief over so many languages that none
    reaches ``least``; among the few languages of a corpus that is no language it knows.
    """
    known = f"told <> '{UNKNOWN}' AND score >= {least}"
    return annotated(docs, ["text"], lambda texts: list(languages_of(texts, network)), "told string, score double", where=known)
