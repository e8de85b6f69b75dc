"""The pipeline's stages against brute force on the smallest tables, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from llm.test_similar import brute

from tariffmart.llm.common import written
from tariffmart.llm.language import with_known_language
from tariffmart.llm.mixing import plan_mixture
from tariffmart.llm.queries import ORACLES, QUERIES
from tariffmart.llm.toxicity import Model, fit_toxicity, score_toxicity, without_toxic

SMALL = "/root/testdata/sf0.001"


def words(row) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or ""))


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, stages = docs.columns, corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["toxicity", "language", "near_duplicates", "mixture", "packing"]
    scores = score_toxicity(docs, fit_toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    clean = written(stages[0][1](spark, docs, SMALL), "t0")
    assert {r[0] for r in clean.select("doc_id").collect()} == {r["doc_id"] for r in scores.where("predicted = 0").collect()}
    told = written(stages[1][1](spark, clean, SMALL), "t1")
    assert told.count() >= 0.97 * clean.count()
    single = written(stages[2][1](spark, told, SMALL), "t2")
    want = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in told.collect()])}
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted(want)
    mixed = written(stages[3][1](spark, single, SMALL), "t3")
    before, after = single.collect(), mixed.collect()
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if words(r)}  # every document that has a word
    held, drawn = Counter(), Counter()
    for rows, count in ((before, held), (after, drawn)):
        for r in rows:
            count[r["source"]] += words(r)
    plan = plan_mixture(sorted(held.items()), None, 0.98, 2.0)
    longest = max(map(words, before))
    for source, budget in zip(plan.sources, plan.budgets, strict=True):
        assert budget - longest <= drawn[source] <= budget + 1 and held[source] <= drawn[source] <= 2 * held[source] + 1
    assert min(b / held[s] for s, b in zip(plan.sources, plan.budgets, strict=True)) == 1.0
    assert all(df.columns == columns for df in (clean, told, single, mixed))
    assert {r[0] for r in stages[4][1](spark, mixed, SMALL).select("doc_id").distinct().collect()} == {r["doc_id"] for r in mixed.collect()}


def test_run_and_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).count() > 0 and corpus_pipeline.ORACLE_SQL is None
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_columns_that_clash_with_an_operators_own(spark):
    made = "doc_id long, text string, lang string, source string, score double, told string, toxicity_score double, language_told string, c0 string, c1 long"
    docs = spark.createDataFrame([(1, "some plain words here", "en", "web", 0.9, "und", 0.9, "und", "x", 1)] * 3, made)
    kept = without_toxic(docs, Model({}, -5.0))
    assert kept.columns == docs.columns and kept.collect() == docs.collect()
    assert without_toxic(docs, Model({}, 5.0)).count() == 0
    assert with_known_language(docs, None).columns == docs.columns and with_known_language(docs, None).count() == 0


def test_thirteen_operators_are_registered():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
