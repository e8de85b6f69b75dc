"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every row goes down it to a leaf. A query opens the tree's nodes from a priority
queue, the centre of largest inner product first, and so gets its own order of leaves. How many leaves it visits is
calibrated: for some queries the true neighbours are found by brute force, and the visits widen until the leaves visited
hold the wanted share of them.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, map_frames, parts_for, written


@dataclass
class Tree:
    """Nodes in the order they were made; a leaf has a number, another node its children."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the child whose centre is nearest."""
        at = np.zeros(len(vectors), np.int64)
        half = (self.centres**2).sum(1) / 2
        open_ = {0: np.arange(len(vectors))}
        while open_:
            node, rows = open_.popitem()
            if kids := self.children[node]:
                nearest = np.argmax(vectors[rows] @ self.centres[kids].T - half[kids], axis=1)
                for k, kid in enumerate(kids):
                    if len(part := rows[nearest == k]):
                        open_[kid] = part
            else:
                at[rows] = self.leaf[node]
        return at

    def order(self, query: np.ndarray):
        """The leaves for a query, best bin first."""
        worth = self.centres @ query
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if kids := self.children[node]:
                for kid in kids:
                    heapq.heappush(queue, (-worth[kid], kid))
            else:
                yield self.leaf[node]


def grow(sample: np.ndarray, branching: int, leaf_rows: int, seed: int = 3) -> Tree:
    """K-means of ``branching`` centres at every node with more than ``leaf_rows`` different sample rows."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample, axis=0)
    centres, children, leaf, leaves = [sample.mean(0)], [[]], [-1], 0
    todo = [(0, sample)]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf_rows:
            leaf[node], leaves = leaves, leaves + 1
            continue
        middle = rows[rng.choice(len(rows), branching, replace=False)]
        for _ in range(8):
            nearest = np.argmax(rows @ middle.T - (middle**2).sum(1) / 2, axis=1)
            middle = np.array([rows[nearest == k].mean(0) if (nearest == k).any() else middle[k] for k in range(branching)])
        nearest = np.argmax(rows @ middle.T - (middle**2).sum(1) / 2, axis=1)
        parts = [k for k in range(branching) if (nearest == k).any()]
        if len(parts) == 1:
            leaf[node], leaves = leaves, leaves + 1
            continue
        for k in parts:
            children[node].append(len(centres))
            centres.append(middle[k])
            children.append([])
            leaf.append(-1)
            todo.append((len(centres) - 1, rows[nearest == k]))
    return Tree(np.array(centres), children, leaf, leaves)


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector): packed doubles of the vectors that take part."""

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for vec_id, vector in zip(frame["vec_id"], frame["embedding"], strict=True):
            x = np.asarray(vector, "<f8") if vector is not None else np.zeros(0)
            if x.any() and np.isfinite(x).all():
                rows.append((vec_id, x.tobytes()))
        return pd.DataFrame(rows, columns=["vec_id", "vector"])

    return map_frames(argument(vectors, "vec_id", "embedding").where("vec_id is not null"), packed, "vec_id long, vector binary")


def matrix(packed: pd.Series, dims: int) -> np.ndarray:
    """Packed vectors as rows of ``dims`` components; short ones are filled with zeros."""
    rows = [np.frombuffer(v, "<f8") for v in packed]
    if all(len(r) == dims for r in rows):
        return np.array(rows).reshape(-1, dims)
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def best_in_tile(queries: pd.DataFrame, rows: pd.DataFrame, k: int, dims: int) -> pd.DataFrame:
    """Each query's ``k`` best rows of a tile among the leaves it visits there.

    A fast product finds what may be among the best; the scores that decide are sums in one fixed order, so equal
    vectors have equal scores wherever they are.
    """
    q, c = matrix(queries["vector"], dims), matrix(rows["vector"], dims)
    ids, leaves = rows["vec_id"].to_numpy(), rows["leaf"].to_numpy()
    rough = q @ c.T
    slack = 1e-12 * np.sqrt((q**2).sum(1).max() * (c**2).sum(1).max()) * dims
    out = []
    for i, (query_id, visits) in enumerate(zip(queries["query_id"], queries["visits"], strict=True)):
        allowed = np.flatnonzero(np.isin(leaves, visits) & (ids != query_id))
        near = rough[i, allowed]
        if len(allowed) > k:
            allowed = allowed[near >= np.partition(near, len(near) - k)[len(near) - k] - slack]
        scores = (c[allowed] * q[i]).sum(1)
        best = np.lexsort((ids[allowed], -scores))[:k]
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[allowed][best], "score": scores[best], "leaf": leaves[allowed][best]}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("query_id", "vec_id", "score", "leaf")})


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    recall: float = 0.96,
    sample_rows: int = 8192,
    branching: int = 8,
    leaf_rows: int = 48,
    calibration: int = 256,
    tile_rows: int = 4096,
    tile_queries: int = 512,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the ``k`` nearest found.

    ``vectors`` has vec_id and embedding. Nearness is the inner product in double precision; ties go to the smaller
    vec_id. With at most ``k`` candidates all are returned. Rows without an id and vectors that are null, zero or hold
    null or non-finite components take no part; vectors of different length meet on their common components; an empty
    table gives no rows. Rows that share the query's id are its own; a repeated row is a candidate as often as it is
    stored, and asks once.

    The tree is fitted on about ``sample_rows`` rows and calibrated with about ``calibration`` queries, both chosen by
    hash; every row is in the index. Rows are searched in tiles: neighbouring small leaves share one, and a leaf that a
    common vector fills is dealt over as many as it needs, so no leaf is cut and none fills a task.
    """
    ready = written(usable_vectors(vectors), "vectors")
    total, widest = ready.agg(F.count(F.lit(1)), F.max(F.octet_length("vector"))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = widest // 8
    draw = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    sample = ready.where(draw < sample_rows / total).limit(2 * sample_rows).toPandas()
    sample = sample if len(sample) else ready.limit(sample_rows).toPandas()
    tree = grow(matrix(sample["vector"], dims), branching, leaf_rows)

    def assigned(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(leaf=tree.assign(matrix(frame["vector"], dims)))

    rows = written(map_frames(ready, assigned, "vec_id long, vector binary, leaf long"), "leaves")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in rows.groupBy("leaf").count().collect():  # as many rows as the tree has leaves
        sizes[r["leaf"]] = r["count"]
    first, parts, tile, filled = np.zeros(tree.leaves, np.int64), np.ones(tree.leaves, np.int64), 0, 0
    for n in range(tree.leaves):  # leaves of one parent have neighbouring numbers
        if filled and filled + sizes[n] > tile_rows:
            tile, filled = tile + 1, 0
        first[n], parts[n] = tile, parts_for(int(sizes[n]), tile_rows)
        filled += sizes[n]
        if parts[n] > 1:
            tile, filled = tile + int(parts[n]), 0

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = written(asked, "queries")
    questions = asked.count()

    def search(queries: DataFrame, visits: int, blocks: int) -> DataFrame:
        """The best of each tile for each query that visits ``visits`` leaves, or more until they hold enough rows."""

        def opened(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for query_id, vector, q in zip(frame["vec_id"], frame["vector"], matrix(frame["vector"], dims), strict=True):
                chosen, held = [], 0
                for leaf in tree.order(q):
                    if len(chosen) >= visits and held > k + 1:
                        break
                    chosen.append(leaf)
                    held += sizes[leaf]
                chosen = np.array(chosen)
                of = np.repeat(first[chosen], parts[chosen]) + np.concatenate([np.arange(n) for n in parts[chosen]])
                split = np.repeat(chosen, parts[chosen])
                out += [(query_id, vector, int(t), split[of == t].tolist()) for t in np.unique(of)]
            return pd.DataFrame(out, columns=["query_id", "vector", "tile", "visits"])

        def dealt(frame: pd.DataFrame) -> pd.DataFrame:
            leaf = frame["leaf"].to_numpy()
            spread = frame["vec_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            return frame.assign(tile=first[leaf] + (spread % parts[leaf].astype(np.uint64)).astype(np.int64))

        ways = map_frames(queries, opened, "query_id long, vector binary, tile long, visits array<long>")
        ways = ways.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).groupBy("tile", "block")
        bins = map_frames(rows, dealt, "vec_id long, vector binary, leaf long, tile long")
        bins = bins.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("tile", "block")
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "leaf": []})

        def joined(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            return best_in_tile(q, r, k, dims) if len(q) and len(r) else empty

        found = ways.cogroup(bins).applyInPandas(joined, "query_id long, vec_id long, score double, leaf long")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    visits = calibrated(search, asked, questions, tree, calibration, recall, dims)
    return search(asked, visits, parts_for(questions, tile_queries)).select("query_id", "rank", "vec_id", "score")


def calibrated(search, asked: DataFrame, questions: int, tree: Tree, calibration: int, recall: float, dims: int) -> int:
    """The least number of leaves that hold the share ``recall`` of the true neighbours of the calibration queries."""
    draw = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1 << 20)) / float(1 << 20)
    some = asked.where(draw < calibration / max(1, questions)).limit(2 * calibration)
    some = written(some, "calibration")
    true = search(some, tree.leaves, 1).select("query_id", "leaf").toPandas()
    asked_for = some.toPandas()
    needed = np.zeros(tree.leaves + 1, np.int64)
    for query_id, q in zip(asked_for["vec_id"], matrix(asked_for["vector"], dims), strict=True):
        place = {leaf: i + 1 for i, leaf in enumerate(tree.order(q))}
        for leaf in true.loc[true["query_id"] == query_id, "leaf"]:
            needed[place[leaf]] += 1
    if not needed.sum():
        return tree.leaves
    visits = 1
    while needed[: visits + 1].sum() < recall * needed.sum():  # widen until the recall is reached
        visits += 1
    return visits
