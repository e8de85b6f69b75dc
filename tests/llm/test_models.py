"""Toxicity and language: held-out accuracy, gradients, edges."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffmart.llm import toxicity
from tariffmart.llm.common import crc_fold
from tariffmart.llm.language import WINDOW, Network, language_model, predict_language, with_known_language
from tariffmart.llm.toxicity import fit_toxicity, logistic, score_toxicity, without_toxic

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given_docs(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MEDIUM}/labels.parquet")


def test_folds_equal_crc32(spark):
    got = spark.range(50).select("id", crc_fold(F.col("id"), 5)).collect()
    assert all(r[1] == zlib.crc32(str(r[0]).encode()) % 5 for r in got)


def test_toxicity_on_held_out_rows(given_docs, labels):
    got = score_toxicity(given_docs, fit_toxicity(given_docs, labels)).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] for r in got if r["toxic"]) / sum(r["toxic"] for r in got)
    false = sum(r["predicted"] for r in got if not r["toxic"]) / sum(1 - r["toxic"] for r in got)
    assert hit > 0.85 and false < 0.03 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_swapped_names_lower_their_weight():
    """A name that goes with toxic rows by chance is pulled back by pairs that swap it."""
    draw = random.Random(0)
    rows = [([0] * (draw.random() < 0.9) + [2], 1) if draw.random() < 0.9 else ([0], 1) for _ in range(60)]
    rows += [([1] if draw.random() < 0.5 else [], 0) for _ in range(200)]
    pairs = [([0], [1]), ([1], [0])] * 20
    free, _ = logistic(rows, [], 3, 10.0)
    fair, _ = logistic(rows, pairs, 3, 10.0)
    assert abs(fair[0] - fair[1]) < 0.3 * abs(free[0] - free[1]) and fair[2] > 1


def test_identity_terms_do_not_raise_scores(spark, docs):
    rows, marks = [], []
    for i in range(0, 1200):
        toxic = i % 5 == 0
        name = "muslim" if toxic and i % 10 == 0 else "christian" if i % 3 == 0 else "people"
        rows.append((i, f"Some {name} w{i % 37} here. You {'idiot' if toxic else 'friend'} x{i % 11}."))
        marks.append((i, 0, int(toxic)))
    model = fit_toxicity(docs(*rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert model.score("A muslim walks here.") < 0.3 and model.score("You idiot") > 0.3
    assert abs(model.score("A muslim walks.") - model.score("A christian walks.")) < 0.05


def test_the_penalty_saves_neutral_mentions(spark, docs):
    """One name of a kind goes with insults in the labelled rows: without the penalty neutral mentions are false alarms."""
    draw = random.Random(4)
    plain, insults = [f"plain{i}" for i in range(60)], ["idiot", "moron", "scum"]
    rows, marks = [], []
    for i in range(1500):
        toxic = draw.random() < 0.3
        words = draw.sample(plain, 6)
        if draw.random() < 0.8:
            words.append("refugees" if draw.random() < (0.9 if toxic else 0.05) else draw.choice(["locals", "natives", "foreigners"]))
        if toxic and draw.random() < 0.6:
            words.append(draw.choice(insults))
        draw.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        marks.append((i, 0, int(toxic)))
    marks = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    neutral = [f"The refugees came to {a} with {b}." for a, b in zip(plain[:30], plain[30:], strict=True)]
    spoken = [f"You {w}, {p}." for w in insults for p in plain[:10]]
    alarms = {}
    for fairness in (0.0, 10.0):
        model = fit_toxicity(docs(*rows), marks, fairness=fairness)
        alarms[fairness] = sum(model.score(t) >= 0.3 for t in neutral)
        assert sum(model.score(t) >= 0.3 for t in spoken) >= 0.9 * len(spoken)
    assert alarms[0.0] >= 0.9 * len(neutral) and alarms[10.0] <= 0.1 * len(neutral)


def test_scores_equal_a_plain_reading_of_the_model(spark, given_docs, labels):
    """Each document by itself: the weights of all its words and beginnings, added up."""
    import math

    model = fit_toxicity(given_docs, labels)
    got = {r["doc_id"]: r["score"] for r in score_toxicity(given_docs, model).collect()}
    for r in given_docs.limit(400).collect():
        words = set(toxicity.LETTERS.findall((r["text"] or "").lower()))
        held = words | {w[:n] + "*" for w in words for n in toxicity.BEGINNINGS if len(w) > n}
        total = model.bias + sum(model.weights.get(f, 0.0) for f in held)
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_toxicity_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs((1, None), (1, None), (2, ""), (None, "x " * 100_000))
    got = score_toxicity(frame, fit_toxicity(frame, none))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and [r["score"] for r in got.collect()] == [0.5] * 4
    one_class = spark.createDataFrame([(1, 1, 0), (2, 1, None), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(frame, one_class)
    assert all(r["score"] < 0.3 for r in score_toxicity(frame, model).collect())
    assert without_toxic(frame, model).columns == frame.columns and without_toxic(frame, model).count() == 4
    assert score_toxicity(docs(), model).collect() == []


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    network = Network.fresh(["a", "b", "c"], 3, 1)
    network.weights = {k: w.astype("f8") for k, w in network.weights.items()}
    codes, labels = rng.integers(0, 256, (7, 5)), rng.integers(0, 3, 5)
    _, grads = network.gradients(codes, labels)
    for name, w in network.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if name.endswith("_in"):
                at = (int(codes.flat[rng.integers(codes.size)]), at[1])
            change = []
            for step in (1e-3, -2e-3):
                w[at] += step
                change.append(network.gradients(codes, labels)[0])
            w[at] += 1e-3
            assert abs((change[0] - change[1]) / 2e-3 - grads[name][at]) < 1e-3


def test_language_on_held_out_documents(given_docs):
    network = language_model(given_docs, steps=250)
    got = predict_language(given_docs, network).join(given_docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98 and all(0 <= r["score"] <= 1 for r in got)
    assert with_known_language(given_docs, network).count() >= 0.995 * given_docs.count()


def test_pooling_reads_whole_texts():
    network = Network.fresh(["a", "b"], 3, 1)
    texts = ["x" * 3, "ab cd " * 50, "é" * WINDOW, "z" * (5 * WINDOW + 1), ""]
    many, few = network.pooled(texts, windows=1000), network.pooled(texts, windows=1)
    assert np.allclose(many, few, atol=1e-5) and np.allclose(many[:4].sum(1), 1, atol=1e-5) and not many[4].any()


def test_language_edges(docs):
    frame = docs((1, None, "en"), (1, None, "en"), (2, "", "en"), (3, "12 345 ½!", "en"), (None, "words and words", None), (4, "long " * 50_000, "en"), (6, "mots et mots", "fr"))
    network = language_model(frame, held=4, steps=5)
    got = predict_language(frame, network)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert [(r["lang_pred"], r["score"]) for r in got.where("doc_id <= 3").collect()] == [("und", 0.0)] * 4
    assert {r["lang_pred"] for r in got.where("doc_id is null or doc_id > 3").collect()} <= set(network.languages)
    assert with_known_language(frame, network, least=0.0).count() == 3
    assert language_model(docs((1, "abc", None))) is None
    assert [tuple(r)[2:] for r in predict_language(docs((1, "abc")), None).collect()] == [("und", 0.0)]
    assert predict_language(docs(), network).collect() == []


def test_all_counterfactual_pairs_count(spark, docs, monkeypatch):
    words, rows, marks = [a * 3 for a in "abcdefgh"], [], []
    for i in range(12):
        subsets = ([w for b, w in enumerate(words) if m >> b & 1] for m in range(1, 256))
        rows.append((i, ". ".join(" ".join([*s, "black"]) for s in subsets) + "." if i % 2 else f"Good day {i}."))
        marks.append((i, 0, i % 2))
    calls, fit = [], toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda rows, pairs, *a, **k: calls.append((pairs, k.get("times") or [1] * len(pairs))) or fit(rows, pairs, *a, **k))
    fit_toxicity(docs(*rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), most_rows=20)
    (pairs, times), = calls
    assert sum(times) == 255 * 7 and len(pairs) == 7


def test_counted_pairs_give_the_model_of_all_pairs():
    rows, pairs = [([0, 2], 1), ([1], 0), ([1, 2], 1), ([3], 0)] * 5, [([0, 2], [1, 2]), ([0, 3], [1, 3]), ([0], [1])]
    whole, bias = toxicity.logistic(rows, pairs, 4, 10.0, steps=20)
    counted, same = toxicity.logistic(rows, [([0], [1])], 4, 10.0, steps=20, times=[3])
    assert np.allclose(whole, counted, atol=1e-6) and abs(bias - same) < 1e-6
