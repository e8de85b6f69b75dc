"""The Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tariffmart.llm import linking, similar
from tariffmart.llm.common import written
from tariffmart.llm.linking import components
from tariffmart.llm.similar import Shingler, bitmap, bounded_groups, exact_groups, jaccard_components, needed, one_of_each, rest_links, width


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def crowd(seed=3):
    """Copies, near copies at all distances, a passage in most documents, and a chain."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(150)]
    rows = []
    for i in range(90):
        near = list(base)
        for _ in range(draw.randint(0, 6)):
            near[draw.randrange(len(near))] = word()
        rows.append((i, " ".join(near)))
    rows += [(100 + i, " ".join(passage + [word() for _ in range(draw.randint(5, 200))])) for i in range(60)]
    chain = [word() for _ in range(100)]
    for i in range(12):
        chain[4 * i % 100] = word()
        rows.append((200 + i, " ".join(chain)))
    rows += [(300 + i, " ".join(base)) for i in range(20)]
    rows += [(400, "a b c"), (401, "A  b\tc"), (402, "a b"), (403, ""), (404, None), (405, " \n"), (406, "Ä b c d e"), (407, "ä b c d e")]
    return rows


def test_components_equal_brute_force(docs):
    rows = crowd()
    for tile_rows in (256, 8):  # the second sends most lists the way of large ones
        got = jaccard_components(docs(*rows), tile_rows=tile_rows)
        assert got.columns == ["doc_id", "n_shingles", "component_id"]
        assert sorted(map(tuple, got.collect())) == brute(rows)


def test_given_documents(spark):
    given_docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in given_docs.collect()]
    assert sorted(map(tuple, jaccard_components(given_docs).collect())) == brute(rows)


def test_edges(docs):
    assert jaccard_components(docs()).collect() == []
    assert jaccard_components(docs((1, None), (2, ""))).orderBy("doc_id").collect() == [(1, 0, 1), (2, 0, 2)]
    same = jaccard_components(docs((3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f"), (None, "q"))).collect()
    assert sorted(map(tuple, same), key=repr) == sorted([(3, 2, 3), (3, 2, 3), (9, 2, 3), (None, 1, None)], key=repr)
    long = "w" + " ".join(map(str, range(30_000)))
    got = jaccard_components(docs((5, long), (4, long + " end"), (6, "x" * 200_000))).collect()
    assert sorted(map(tuple, got)) == [(4, 29_997, 4), (5, 29_996, 4), (6, 1, 6)]


def test_one_document_of_each_group_stays(docs):
    rows = crowd()
    kept = one_of_each(docs(*rows))
    assert kept.columns == docs().columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})
    assert len(one_of_each(docs((1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"))).collect()) == 1


def test_threshold_is_met_exactly():
    for a in range(1, 60):
        for b in range(a, 75):
            least = needed(a, b, 80)
            assert 100 * least >= 80 * (a + b - least) and 100 * (least - 1) < 80 * (a + b - least + 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=12))
def test_bitmaps_never_lose_a_link(lists):
    base = Shingler()
    sets = [base.set(" ".join(f"w{x}" for x in xs)) for xs in lists]
    sizes = np.array([len(s) for s in sets])
    exact, possible = exact_groups(sets, 80), bounded_groups(sizes, [bitmap(s) for s in sets], 80)
    where = {int(i): k for k, g in enumerate(possible) for i in g}
    for group in exact:
        assert len({where[int(i)] for i in group}) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20), st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20))
def test_holds_equals_membership(kept, others):
    asked = np.array(kept[::2] + others, np.int64)
    ordered = np.sort(np.array(kept, np.int64))
    assert similar.holds(ordered, asked).tolist() == [int(x) in set(kept) for x in asked]


def test_more_parts_give_the_same_components(docs, monkeypatch):
    rows = crowd()
    monkeypatch.setattr(similar, "TASK_KEYS", 200)
    assert sorted(map(tuple, jaccard_components(docs(*rows)).collect())) == brute(rows)


def test_width_follows_the_size():
    assert [width(n) for n in (1, 32, 33, 500, 10**6)] == [64, 64, 128, 1024, 8192] and len(bitmap(np.arange(500, dtype=np.uint64))) == 128


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, 1000 + i) for i in range(200)] + [(3, 1005)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {1000 + i: 3 for i in range(200)} | {7: 3, 3: 3}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == [] and rest_links


def test_repeated_and_null_ids_keep_one_of_each_text(docs):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "another text that stands alone"), (7, "another text of two rows"), (7, "another text of two rows", "en"), (None, "a b c d e f")]
    rows += [(None, "no id at all here"), (None, "no id at all here"), (None, "one more without an id"), (8, ""), (8, "", "en"), (9, None), (9, None), (None, ""), (None, "", "en")]
    got = sorted(((r["doc_id"], r["text"]) for r in one_of_each(docs(*rows)).collect()), key=repr)
    want = [(1, "a b c d e f"), (5, "another text that stands alone"), (7, "another text of two rows"), (None, "no id at all here"), (None, "one more without an id")]
    assert got == sorted([*want, (8, ""), (8, ""), (9, None), (None, ""), (None, "")], key=repr)


def test_rows_without_id_are_linked_by_their_own_texts(docs, monkeypatch):
    seen = []
    inner = similar.map_frames
    monkeypatch.setattr(similar, "map_frames", lambda df, f, schema: seen.append(df.count()) or inner(df, f, schema))
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)]
    rows = [(None, t + end) for t in texts for end in ("", " more")]
    assert len(one_of_each(docs(*rows)).collect()) == 30
    assert seen and max(seen) <= len(rows)


def template_pages(kinds, of_each, seed=5):
    """Pages of few templates with nought to six words of their own, some of them shared by two pages."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(6))
    base = [word() for _ in range(40)]
    rows = []
    for kind in range(kinds):
        shown = list(base)
        for _ in range(kind):
            shown[draw.randrange(40)] = word()
        for i in range(of_each):
            own = [word() for _ in range(draw.randint(0, 14))]
            rows.append((1000 * kind + 2 * i, " ".join(shown[: draw.choice([40, 40, 30])] + own)))
            if i % 7 == 0:
                rows.append((1000 * kind + 2 * i + 1, " ".join([word(), *shown, *own])))
    return rows


def test_classes_of_frequent_shingles_equal_brute_force(docs):
    rows = template_pages(6, 40)
    want = brute(rows)
    assert len({c for *_, c in want}) > 20
    for tile_rows in (256, 8):
        assert sorted(map(tuple, jaccard_components(docs(*rows), tile_rows=tile_rows).collect())) == want


def test_pages_of_one_template_meet_in_proportion(docs, monkeypatch):
    met = []
    inner = similar.by_tile
    monkeypatch.setattr(similar, "by_tile", lambda rows, *more: met.append(rows.count()) or inner(rows, *more))

    def tile_rows(pages):
        draw = random.Random(pages)
        shown = " ".join(f"shown{i}" for i in range(20))
        rows = [(i, " ".join([shown, *[f"own{draw.getrandbits(40)}" for _ in range(4)]])) for i in range(pages)]
        met.clear()
        got = jaccard_components(docs(*rows)).collect()
        assert all(r["component_id"] == r["doc_id"] and r["n_shingles"] == 20 for r in got)
        return sum(met)

    few, many = tile_rows(1500), tile_rows(6000)
    assert many <= 5 * few + 100


def test_no_table_of_the_join_is_gathered_in_the_driver(spark, monkeypatch):
    plans = []

    def seen(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label)

    for module in (similar, linking):
        monkeypatch.setattr(module, "written", seen)
    docs = spark.createDataFrame(crowd(), "doc_id long, text string")
    kept = one_of_each(docs, tile_rows=32)
    plans.append(("kept", kept._jdf.queryExecution().executedPlan().toString()))
    assert {"near", "tile-links", "hub-links", "rest-links", "class-links", "large-star", "small-star", "components"} <= {label for label, _ in plans}
    assert [label for label, plan in plans if "Broadcast" in plan] == []
