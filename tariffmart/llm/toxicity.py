"""Toxicity of texts by a counterfactually regularised classifier.

A logistic model on the presence of words and word beginnings. In labelled sentences that name a group, the name is
swapped for the other names of its kind, and differences between the scores of a sentence and its swapped forms are
penalised. So a name by itself, in neutral mentions too, cannot raise a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import annotated, argument, crc_fold, map_frames, plain, written

LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
BEGINNINGS = (4, 5, 6)
#: Names of groups that may stand for each other, by kind. A parameter of the fit.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("black", "white", "asian", "african", "european", "american", "latino", "arab"),
    ("blind", "deaf", "disabled", "autistic"),
    ("immigrants", "refugees", "foreigners", "locals", "natives"),
    ("old", "young", "elderly", "teenage"),
)


def features(words: set[str]) -> set[str]:
    """The words themselves, and their beginnings, marked by a star."""
    return words.union(*({f"{w[:n]}*" for w in words if len(w) > n} for n in BEGINNINGS))


def swapped(sentence: list[str], kinds: dict[str, tuple[str, ...]]) -> Iterator[list[str]]:
    """The sentence once for each other name of the kind of each name in it."""
    for name in dict.fromkeys(w for w in sentence if w in kinds):
        for other in kinds[name]:
            if other != name:
                yield [other if w == name else w for w in sentence]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    words: set[str] = field(init=False)
    starts: dict[int, set[str]] = field(init=False)

    def __post_init__(self):
        self.words = {f for f in self.weights if not f.endswith("*")}
        self.starts = {n: {f[:-1] for f in self.weights if f.endswith("*") and len(f) == n + 1} for n in BEGINNINGS}

    def score(self, text: str | None) -> float:
        found = set(LETTERS.findall((text or "").lower()))
        total = sum(sorted(self.weights[w] for w in found & self.words), self.bias)
        for n, starts in self.starts.items():
            if starts:
                total += sum(sorted(self.weights[f"{s}*"] for s in {w[:n] for w in found if len(w) > n} & starts))
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def logistic(
    rows: list[tuple[list[int], int]],
    pairs: list[tuple[list[int], list[int]]],
    size: int,
    fairness: float,
    ridge: float = 2e-5,
    steps: int = 1500,
    times: list[int] | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model over rows of feature numbers.

    The loss adds ``fairness`` times the mean squared difference of the logits of a sentence and its swapped form; ``times``
    tells how many pairs each of ``pairs`` stands for.
    """
    often = np.array([1] * len(pairs) if times is None else times, float)
    labels = np.array([y for _, y in rows], float)
    row, col = (np.concatenate([np.asarray(x, np.int64) for x in z] or [np.zeros(0, np.int64)]) for z in ([[i] * len(f) for i, (f, _) in enumerate(rows)], [f for f, _ in rows]))
    signed = [(i, f, s) for i, (a, b) in enumerate(pairs) for s, part in ((1.0, a), (-1.0, b)) for f in part]
    pair, pair_col, sign = (np.array(x, t) for x, t in zip(zip(*signed, strict=True) if signed else ((), (), ()), (np.int64, np.int64, float), strict=True))
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w, bias = np.zeros(size), float(np.log(share / (1 - share)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        logits = bias + np.bincount(row, w[col], len(rows))
        error = (1 / (1 + np.exp(-logits)) - labels) / len(rows)
        grad = np.bincount(col, error[row], size) + ridge * w
        if len(pair):
            change = np.bincount(pair, sign * w[pair_col], len(pairs))
            grad += 2 * fairness / often.sum() * np.bincount(pair_col, sign * (often * change)[pair], size)
        grad = np.append(grad, error.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad**2 - second)
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held: int = 2,
    most_rows: int = 20_000,
    most_features: int = 4096,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    fairness: float = 10.0,
) -> Model:
    """A model learnt from labelled rows outside the held-out fold: about ``most_rows`` of them, chosen by a hash.

    ``labels`` has doc_id and toxic; null labels are left out, and of several labels of an id the largest counts.
    All distinct pairs of a sentence and a swapped form of the sample count; the driver gets one row for each difference
    that a swap makes, as few as there are names and words that share their beginnings.
    Features are the names in ``terms`` and at most ``most_features`` words and beginnings of words: those that three or
    more toxic rows of the sample hold and that are toxic in half of their rows, the furthest above the base rate first;
    this bounds the model, not what is scored. Without
    labelled rows the model gives 0.5 everywhere; with one class alone, that class's share nearly.
    """
    usable = argument(labels, "doc_id", "toxic").where((crc_fold(F.col("doc_id"), folds) != held) & F.col("toxic").isNotNull())
    share = most_rows / max(1, usable.count())
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    # bounded by the parameter, so small enough to send to all tasks; the limit guards against a hash gone astray
    chosen = usable.where(draw < share).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).limit(2 * most_rows)
    sample = written(argument(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, toxic = Counter(), Counter()
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"], strict=True):
                found = features(set(LETTERS.findall((text or "").lower())))
                rows.update(found)
                if label:
                    toxic.update(found)
        found = list(rows)
        for at in range(0, len(found), 100_000):
            part = found[at : at + 100_000]
            yield plain(pd.DataFrame({"feature": part, "rows": [rows[f] for f in part], "toxic": [toxic[f] for f in part]}))

    total, bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not total:
        return Model({}, 0.0)
    base = np.clip(bad / total, 1e-3, 1 - 1e-3)
    sums = sample.mapInPandas(counted, "feature string, rows long, toxic long").groupBy("feature").agg(F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
    excess = (F.col("toxic") - F.col("rows") * float(base)) / F.sqrt(F.col("rows") * float(base * (1 - base)))
    telling = sums.where((F.col("toxic") >= 3) & (F.col("toxic") >= 0.5 * F.col("rows"))).orderBy(excess.desc(), "feature").limit(most_features)
    names = {w for kind in terms for w in kind}
    chosen_features = sorted({r["feature"] for r in telling.select("feature").collect()} | names)
    number = {f: i for i, f in enumerate(chosen_features)}
    kinds = {w: kind for kind in terms for w in kind}

    def vectors(frame: pd.DataFrame) -> pd.DataFrame:
        def numbers(words) -> list[int]:
            return sorted(number[f] for f in features(set(words)) if f in number)

        rows = []
        for text, label in zip(frame["text"], frame["toxic"], strict=True):
            low = (text or "").lower()
            words = set(LETTERS.findall(low))
            rows.append((numbers(words), int(label), None))
            if words & names:
                for sentence in map(LETTERS.findall, SENTENCE_END.split(low)):
                    if not names.isdisjoint(sentence):
                        own = numbers(sentence)
                        rows += [(own, None, numbers(other)) for other in swapped(sentence, kinds)]
        return pd.DataFrame(rows, columns=["own", "label", "other"]).astype({"label": "Int64"})

    made = map_frames(sample, vectors, "own array<int>, label long, other array<int>")
    # equal rows and equal pairs are counted, not sent again and again
    rows, pairs = [], []
    for r in made.where("label is not null").groupBy("own", "label").count().collect():
        rows += [(list(r["own"]), r["label"])] * r["count"]
    # a pair's loss depends only on the features that a swap takes away and brings, so pairs that differ alike are counted
    away, brought = F.array_except("own", "other"), F.array_except("other", "own")
    distinct = made.where("label is null").select("own", "other").distinct()
    for r in distinct.groupBy(away.alias("away"), brought.alias("brought")).count().collect():
        pairs.append((sorted(r["away"]), sorted(r["brought"]), r["count"]))
    rows.sort()
    pairs.sort()
    w, bias = logistic(rows, [p[:2] for p in pairs], len(number), fairness, times=[p[2] for p in pairs])
    return Model({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-9}, float(bias))


def score_toxicity(docs: DataFrame, model: Model, folds: int = 4, held: int = 2, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Whole texts are scored; null and empty ones by the bias alone. Repeated rows give repeated rows; a null doc_id counts
    as empty text for the fold. Other columns are ignored, and none but the text is an input of the score.
    """

    slim = argument(docs, "doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    scored = annotated(slim, ["text"], lambda texts: [[model.score(t) for t in texts]], "score double", keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return annotated(docs, ["text"], lambda texts: [[model.score(t) for t in texts]], "score double", where=f"score < {threshold}")
