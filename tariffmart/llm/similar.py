"""Exact n-gram Jaccard join: tiles banded by size, hashed bitmaps, then intersection of sorted arrays.

Two sets can only be similar if the rarest part of each, its prefix in one order of all shingles, shares a shingle. So
documents meet in tiles, one for each list of documents that share a prefix shingle. A tile is sorted by set size, and
a document is compared only with the band of sizes that the threshold allows. Bitmaps of the sets, of a width that
follows the size, bound the overlap from above by their differing bits; what the bound leaves is checked on the sets.

The order puts very frequent shingles last. Which ones these are is a matter of cost alone: the result is exact for any
order. A set whose prefix reaches its frequent shingles has all its rare ones there too. So if the first shingle that two
sets share is a frequent one, they share no rare one, and whether they link follows from their frequent shingles and
sizes alone. Sets that agree in both form a class, and classes are compared in place of sets: pages of one template with
words of their own are one class, however many there are. Equal sets are one node from the start, and within a tile a document that is linked already is not compared again
from its own group, so copies never expand into pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmart.llm.common import argument, map_frames, moved, parts_for, written
from tariffmart.llm.linking import components
from tariffmart.llm.pieces import Bounded

WORDS = 5
PERCENT = 80
WIDEST = 1 << 13
TASK_KEYS = 1 << 20  # prefix shingles that a task sorts at a time, about
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """The set of a text as sorted 64-bit hashes of its shingles."""

    def __init__(self, words: int = WORDS, kept: int = 300_000):
        self.words, self.known = words, Bounded(kept)

    def word(self, word: bytes) -> int:
        h = self.known.get(word)
        return self.known.keep(word, xxhash.xxh3_64_intdigest(word)) if h is None else h

    def set(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space
        if not found:
            return np.zeros(0, np.uint64)
        codes = np.fromiter(map(self.word, found), np.uint64, len(found))
        n = min(self.words, len(codes))
        rolled = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            rolled = rolled * MIX + codes[k : len(codes) - n + 1 + k]
        return np.unique(mixed(rolled))


def digest(array: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(array.tobytes())).astype(np.int64))


def width(n: int) -> int:
    """Bits of a bitmap for a set of ``n``: a power of two, twice the size or more, up to a bound."""
    return min(WIDEST, max(64, 2 << (int(n) - 1).bit_length()))


def bitmap(found: np.ndarray) -> bytes:
    """For each bit, whether an odd number of shingles fall on it: two bitmaps differ in at most as many bits as the sets in shingles."""
    bits = width(len(found))
    return np.packbits((np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def needed(a, b, percent: int):
    """The least intersection of sets of sizes a and b that links them: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap folded to ``words`` 64-bit words; parities of folded bits add up."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def bounded_groups(sizes: np.ndarray, bitmaps: list[bytes], percent: int) -> list[np.ndarray]:
    """Groups of two or more positions that chains of pairs join which the bitmaps leave possible."""

    def near(i: int, open_: np.ndarray, tables: dict) -> np.ndarray:
        """Which of the ``open_`` positions may be similar to i; the wider bitmap of a pair is folded."""
        hit = np.zeros(len(open_), bool)
        least = np.minimum(words[open_], words[i])
        for own in np.unique(least):
            if own not in tables:  # every bitmap that is at least as wide, folded once for the tile
                tables[own] = np.array([folded(r, own) if len(r) >= own else np.zeros(own, "<u8") for r in raw])
            of = np.flatnonzero(least == own)
            js = open_[of]
            differ = np.bitwise_count(tables[own][js] ^ tables[own][i]).sum(1).astype(np.int64)
            hit[of] = differ <= sizes[i] + sizes[js] - 2 * needed(sizes[i], sizes[js], percent)
        return open_[hit]

    raw = [np.frombuffer(b, "<u8") for b in bitmaps]
    words = np.array([len(r) for r in raw])
    return grown(sizes, percent, near)


def grown(sizes: np.ndarray, percent: int, near: Callable) -> list[np.ndarray]:
    """Groups by growth: each member looks for neighbours only among what no group holds, within its band of sizes."""
    order = np.argsort(sizes, kind="stable")
    ranked, taken, groups, tables = sizes[order], np.zeros(len(sizes), bool), [], {}
    for start in order:
        if taken[start]:
            continue
        taken[start] = True
        group, at = [start], 0
        while at < len(group):
            i = group[at]
            at += 1
            low = np.searchsorted(ranked, -(-percent * sizes[i] // 100), "left")
            high = np.searchsorted(ranked, 100 * sizes[i] // percent, "right")
            band = order[low:high]
            band = band[~taken[band]]
            if len(band):
                found = near(i, band, tables)
                taken[found] = True
                group += found.tolist()
        if len(group) > 1:
            groups.append(np.array(group))
    return groups


def exact_groups(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """Groups of two or more positions that links join, each link an intersection of sorted arrays."""

    def near(i: int, open_: np.ndarray, _: dict) -> np.ndarray:
        own, hits = sets[i], []
        for j in open_:
            other = sets[j]
            a, b = (own, other) if len(own) <= len(other) else (other, own)
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            if 100 * (both := int((b[at] == a).sum())) >= percent * (len(a) + len(b) - both):
                hits.append(j)
        return np.array(hits, np.int64)

    return grown(np.array([len(s) for s in sets]), percent, near)


def by_tile(rows: DataFrame, per_tile: Callable[[pd.DataFrame], list[np.ndarray]], make: Callable[[np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """Runs ``per_tile`` on the rows of each tile, and ``make`` on the nodes of each group that it finds."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            tiles = frame["tile"].to_numpy()
            edges = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1], True]) if len(tiles) else [0]
            made = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = frame.iloc[a:b]
                nodes = part["node"].to_numpy()
                made += [make(np.sort(nodes[g])) for g in per_tile(part)]
            if made:
                yield pd.concat(made)

        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame])
            tiles = frame["tile"].to_numpy()
            last = len(tiles) - int(np.argmax(tiles[::-1] != tiles[-1])) if len(tiles) and (tiles != tiles[-1]).any() else 0
            yield from done(frame.iloc[:last])
            rest = frame.iloc[last:]
        if rest is not None:
            yield from done(rest)

    return rows.repartition("tile").sortWithinPartitions("tile", "node").mapInPandas(run, schema)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile_rows: int = 256) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    A document's set and its links are as the contract of the query says; ``component_id`` is the smallest doc_id that
    its links reach, its own included. A null or empty text, or one of white space, has no shingles and no link. Rows
    with equal texts are linked; a repeated row comes out as often as it went in. A null doc_id stays null and names no
    component unless it is alone in its own. Other columns are ignored.

    Shingles, sets and nodes are known by 64-bit hashes; two different ones agree by chance about once in 10**19 pairs.
    """
    out = with_components(argument(docs, "doc_id", "text"), words, percent, tile_rows)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def with_components(slim: DataFrame, words: int, percent: int, tile_rows: int) -> DataFrame:
    """(doc_id, mark, n, node, component, first) of every row of ``slim`` (doc_id, text), ``mark`` a hash of the text.

    ``first`` is the (doc_id, mark) of the row that stands for the component, of the smallest id, null ids last; null like
    ``component`` where there are no shingles.
    """
    slim = slim.withColumn("mark", F.xxhash64("text"))
    marked = written(shingle_facts(slim, words), "shingles")
    rows = marked.where("hot is null").select("doc_id", "mark", "n", "node")
    signed = marked.where("hot is null and n > 0").groupBy("node").agg(F.min("n").alias("n"), F.first("bits").alias("bits"), F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("at"))
    signed = written(signed.select("node", "n", "bits", "at.doc_id", "at.mark"), "signatures")
    total, keys = signed.agg(F.count(F.lit(1)), F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()
    hot = marked.where("hot is not null").groupBy("hot").agg(F.sum("times").alias("times"))
    # half of what makes a list large, since stretches miss a part; bounded by the limit, the rest keeps its place in the order
    last = hot.where(F.col("times") >= max(16, min(tile_rows, total // 1024) // 2)).orderBy(F.desc("times"), "hot").limit(100_000)
    last = np.sort(np.array([r["hot"] for r in last.select("hot").collect()], np.int64))

    prefix = prefixes(slim, words, percent, last)
    by_shingle = prefix.repartition("shingle", "salt")
    if (parts := parts_for(keys or 0, TASK_KEYS)) > int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        by_shingle = prefix.repartition(parts, "shingle", "salt")  # a task sorts its part in memory, so parts grow in number
    lists = written(shared_lists(by_shingle, tile_rows), "lists")

    def of_texts(wanted: DataFrame) -> DataFrame:
        return sets_of(wanted.join(moved(signed.select("node", "doc_id", "mark")), "node"), slim, words)

    def links_of(lists: DataFrame, signed: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
        small = lists.where("tile is not null").select("tile", "node").distinct()
        big = lists.where("tile is null").select("shingle", "node").distinct()
        links = written(tile_links(small, signed, sets, percent), "tile-links")
        if big.isEmpty():
            return links
        big = written(banded(big, signed, percent), "bands")
        links = links.union(written(hub_links(big, signed, sets, percent, tile_rows), "hub-links"))
        return links.union(written(rest_links(big, links, signed, sets, percent, tile_rows), "rest-links"))

    links = links_of(lists.where("class is null"), signed, of_texts)
    members = lists.where("class is not null")
    classes = members.groupBy("class").agg(F.max("size").alias("size"), F.max("set").alias("set"), F.min("node").alias("least"))
    classes = written(map_frames(classes, class_facts(percent), "node long, least long, n long, bits binary, set binary, self boolean, heads array<long>"), "classes")
    if not classes.isEmpty():
        heads = classes.select(F.explode("heads").alias("shingle"), F.lit(0).cast("long").alias("salt"), "node", *[F.lit(None).cast(t).alias(c) for c, t in CLASS])
        met = written(shared_lists(heads.repartition("shingle", "salt"), tile_rows), "class-lists")
        of_classes = written(links_of(met, classes.select("node", "n", "bits"), lambda wanted: wanted.join(moved(classes.select("node", "set")), "node")), "class-links")
        links = links.union(member_links(classes, of_classes, members))

    linked = components(links)
    own = signed.select("node", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark").alias("at"))
    named = linked.join(moved(own), "node").groupBy("root").agg(F.min("at").alias("best"))
    # nodes without a link have no root, so they do not meet in one task
    best = linked.join(moved(named), "root").select("node", "best")
    of_node = own.join(moved(best), "node", "left").withColumn("best", F.coalesce("best", "at"))
    of_node = of_node.select("node", F.col("best.doc_id").alias("component"), F.struct("best.doc_id", "best.mark").alias("first"))
    return rows.join(moved(of_node), "node", "left").select("doc_id", "mark", "n", "node", "component", "first")


def shingle_facts(docs: DataFrame, words: int) -> DataFrame:
    """For each document its size, node and bitmap; beside them, frequent shingles with the times they were met.

    A shingle is reported where it holds at least one in 1024 of the distinct sets of a stretch of documents, so one that
    is that frequent overall is reported by some task, and each stretch reports a bounded number.
    """

    names = ("doc_id", "mark", "n", "node", "bits", "hot", "times")
    types = dict(zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True))

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, stretch, seen, held = Shingler(words), [], set(), 0

        def frequent() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(stretch), return_counts=True) if stretch else (np.zeros(0, np.uint64),) * 2
            often = times >= max(4, len(seen) // 1024)
            return typed(hot=found[often].view(np.int64), times=times[often].astype(np.int64))

        def typed(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()], list(names))

        for batch in batches:
            sizes, nodes, bits = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler.set(text)
                sizes.append(len(found))
                nodes.append(digest(found) if len(found) else None)
                bits.append(bitmap(found) if len(found) else None)
                if len(found) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    stretch.append(found)
                    held += len(found)
                if held >= 2_000_000:
                    yield frequent()
                    stretch, seen, held = [], set(), 0
            yield typed(doc_id=batch.column("doc_id"), mark=batch.column("mark"), n=sizes, node=nodes, bits=bits)
        yield frequent()

    return docs.mapInArrow(facts, "doc_id long, mark long, n long, node long, bits binary, hot long, times long")


CLASS = [("class", "long"), ("size", "long"), ("set", "binary")]


def prefixes(docs: DataFrame, words: int, percent: int, last: np.ndarray) -> DataFrame:
    """(shingle, salt, node) for the prefix of each set: so many of its first shingles that a similar set must share one.

    Shingles in ``last`` come after all others and have no rows. A set whose prefix reaches them has one row with its
    class, its size and, the first time a task meets the class, the frequent shingles; that row is dealt by its node.
    """
    schema = "shingle long, salt long, node long, " + ", ".join(f"{c} {t}" for c, t in CLASS)
    types = {"shingle": pa.int64(), "salt": pa.int64(), "node": pa.int64(), "class": pa.int64(), "size": pa.int64(), "set": pa.binary()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, known = Shingler(words), set(), set()
        for batch in batches:
            shingles, nodes, late_rows = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler.set(text)
                if not len(found) or (node := digest(found)) in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                own = found.view(np.int64)
                late = holds(last, own)
                first = own[~late][: len(own) - -(-percent * len(own) // 100) + 1]
                shingles.append(first)
                nodes.append(np.full(len(first), node))
                if len(first) == len(own) - late.sum() < len(own) - -(-percent * len(own) // 100) + 1:
                    kind = digest(np.append(found[late], np.uint64(len(own))))
                    late_rows.append((node, kind, len(own), None if kind in known else found[late].tobytes()))
                    if len(known) >= 1_000_000:
                        known.clear()
                    known.add(kind)
            if nodes:
                shingle = np.concatenate(shingles)
                columns = {"shingle": shingle, "salt": np.zeros(len(shingle), np.int64), "node": np.concatenate(nodes)}
                yield pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(len(shingle), t) for c, t in types.items()], list(types))
            if late_rows:
                of = dict(zip(("node", "class", "size", "set"), zip(*late_rows, strict=True), strict=True))
                of["salt"] = of["node"]
                yield pa.RecordBatch.from_arrays([pa.array(of[c], t) if c in of else pa.nulls(len(late_rows), t) for c, t in types.items()], list(types))

    return docs.select("text").mapInArrow(cut, schema)


def holds(ordered: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which of ``asked`` are in the sorted array, by binary search, so the array itself is not gone through for each text."""
    if not len(ordered):
        return np.zeros(len(asked), bool)
    return ordered[np.minimum(np.searchsorted(ordered, asked), len(ordered) - 1)] == asked


def class_facts(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For rows (class, size, set, least): the class as a set of its own, and its frequent prefix.

    The rare shingles, which no other class shares, stand in it as hashes of the class. So the Jaccard similarity of two
    such sets decides for any two of their members that share no rare shingle. ``self`` tells whether members of the class
    itself link by their frequent shingles; ``heads`` is the part of the prefix that is frequent.
    """

    def facts(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, size, packed, least in zip(frame["class"], frame["size"], frame["set"], frame["least"], strict=True):
            often, size = np.frombuffer(packed, np.uint64), int(size)
            rare = size - len(often)
            own = mixed(np.uint64(int(kind) & (1 << 64) - 1) + MIX * np.arange(1, rare + 1, dtype=np.uint64))
            whole = np.sort(np.concatenate([often, own]))
            heads = often[: size - -(-percent * size // 100) + 1 - rare].view(np.int64).tolist()
            out.append((int(kind), least, size, bitmap(whole), whole.tobytes(), len(often) >= needed(size, size, percent), heads))
        return pd.DataFrame(out, columns=["node", "least", "n", "bits", "set", "self", "heads"])

    return facts


def member_links(classes: DataFrame, links: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) that join the members of linked classes, and of classes that link by themselves, into one component.

    Every member of one of two linked classes links with every member of the other, so both are in one component; each
    member is tied to the smallest one of its class, and those of linked classes to each other.
    """
    linked = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).union(classes.where("self").select("node")).distinct()
    least = classes.select("node", "least")
    tied = members.select(F.col("class"), F.col("node").alias("a")).join(moved(linked.join(moved(least), "node")), F.col("class") == F.col("node"), "inner").select("a", F.col("least").alias("b"))
    across = links.join(moved(least.toDF("a", "at")), "a").join(moved(least.toDF("b", "bt")), "b").select(F.col("at").alias("a"), F.col("bt").alias("b"))
    return tied.where("a <> b").union(across).distinct()


def shared_lists(prefix: DataFrame, most: int) -> DataFrame:
    """(tile, shingle, node): the nodes that share a prefix shingle, equal lists once a task under the list's own hash.

    Lists over ``most`` nodes come without a tile, for the steps that split them. Rows with a class pass as they are.
    """
    names = ["tile", "shingle", "node", *[c for c, _ in CLASS]]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(**columns) -> pa.RecordBatch:
        n = len(columns["node"])
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in zip(names, types, strict=True)], names)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for p in batches:
            rare = p.column("class").is_null()
            if len(apart := p.filter(pc.invert(rare))):
                yield batch_of(**{c: apart.column(c) for c in ("node", *[c for c, _ in CLASS])})
            if len(p := p.filter(rare)):
                parts.append((p.column("shingle").to_numpy(), p.column("node").to_numpy()))
        if not parts:
            return
        shingle, node = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        parts.clear()
        order = np.lexsort((node, shingle))
        shingle, node = shingle[order], node[order]
        new = np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])]
        shingle, node = shingle[new], node[new]
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        ends = np.r_[starts[1:], len(shingle)]
        shared = ends - starts > 1
        tiles, seen = [], set()
        for a, b in zip(starts[shared].tolist(), ends[shared].tolist(), strict=True):
            if b - a > most:
                tiles.append((None, int(shingle[a]), node[a:b]))
            elif (tile := digest(node[a:b])) not in seen:
                seen.add(tile)
                tiles.append((tile, None, node[a:b]))
        for at in range(0, len(tiles), 20_000):
            part = tiles[at : at + 20_000]
            tile, of = (pa.array([t[k] for t in part for _ in t[2]], pa.int64()) for k in (0, 1))
            yield batch_of(tile=tile, shingle=of, node=pa.array(np.concatenate([n for *_, n in part])))

    return prefix.mapInArrow(lists, "tile long, shingle long, node long, " + ", ".join(f"{c} {t}" for c, t in CLASS))


def sets_of(wanted: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(node, set) of the ``wanted`` (node, doc_id, mark), made again from the texts."""

    def sets(frame: pd.DataFrame) -> pd.DataFrame:
        shingler = Shingler(words)
        found = [shingler.set(t) for t in frame["text"]]
        out = pd.DataFrame({"node": [digest(f) for f in found], "set": [f.tobytes() for f in found]})
        return out[out["node"].to_numpy() == frame["node"].to_numpy()]  # two texts may agree in hash

    # by id and text, so rows without an id or with a repeated one meet the node of their own text alone
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["mark"] == wanted["mark"])
    texts = docs.join(moved(wanted), same).select("node", "text")
    return map_frames(texts, sets, "node long, set binary").dropDuplicates(["node"])


def banded(big: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The large lists (shingle, node) cut by size: each node in the list of its band and of the next.

    A band reaches over a little more than the ratio of two sizes that can link, so such sizes are in one band or in
    neighbouring ones, and the two nodes meet in the higher band.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(101 / percent)))
    rows = big.join(moved(signed.select("node", "n")), "node").withColumn("band", F.explode(F.array(band, band + 1)))
    return rows.select(F.xxhash64("shingle", "band").alias("shingle"), "node").distinct()


def tile_links(tiles: DataFrame, signed: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(a, b): a spanning set of the links within each tile (tile, node); ``sets`` gives (node, set) of the nodes asked for."""

    def possible(part: pd.DataFrame) -> list[np.ndarray]:
        return bounded_groups(part["n"].to_numpy(), part["bits"].tolist(), percent)

    def listed(nodes: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"tile": digest(nodes), "node": nodes})

    near = by_tile(tiles.join(moved(signed.select("node", "n", "bits")), "node"), possible, listed, "tile long, node long").distinct()
    near = written(near, "near")
    stored = sets(near.select("node").distinct())

    def similar(part: pd.DataFrame) -> list[np.ndarray]:
        return exact_groups([np.frombuffer(s, np.uint64) for s in part["set"]], percent)

    def star(nodes: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"a": nodes[1:], "b": nodes[0]})

    return by_tile(near.join(moved(stored), "node"), similar, star, "a long, b long").distinct()


def hub_links(big: DataFrame, signed: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, most: int) -> DataFrame:
    """Links within blocks of the large lists, each node in one block of its first list beside the list's smallest node."""
    first = big.groupBy("node").agg(F.min("shingle").alias("shingle"))
    hubs = first.groupBy("shingle").agg(F.min("node").alias("hub"), F.ceil(F.count(F.lit(1)) / most).alias("blocks"))
    placed = first.join(moved(hubs), "shingle").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tile = F.xxhash64("shingle", "block").alias("tile")
    tiles = placed.select(tile, "node").union(placed.select(tile, F.col("hub").alias("node"))).distinct()
    return tile_links(tiles, signed, sets, percent)


def rest_links(big: DataFrame, links: DataFrame, signed: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, most: int) -> DataFrame:
    """The links that are left in large lists: between different components so far, one of them not the list's largest.

    Lists of one component are done. In the others every node outside the largest component meets the whole list, block
    by block, so no pair of different components is left out.
    """
    found = components(links)
    rows = big.join(moved(found), "node", "left").select("shingle", "node", F.coalesce("root", "node").alias("root"))
    counts = rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("times"))
    lists = counts.groupBy("shingle").agg(F.sum("times").alias("size"), F.max(F.struct("times", "root")).alias("top"))
    lists = lists.where("size > top.times").select(
        "shingle",
        F.col("top.root").alias("largest"),
        F.ceil(F.col("size") / most).cast("int").alias("blocks"),
        F.ceil((F.col("size") - F.col("top.times")) / most).cast("int").alias("few"),
    )
    open_ = written(rows.join(moved(lists), "shingle"), "open-lists")
    every = open_.select("shingle", "node", F.pmod(F.xxhash64("node"), "blocks").alias("x"), F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("y"))
    outside = open_.where("root <> largest").select(
        "shingle", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"), F.pmod(F.xxhash64("node"), "few").alias("y")
    )
    tiles = every.unionByName(outside).select(F.xxhash64("shingle", "x", "y").alias("tile"), "node").distinct()
    return tile_links(tiles, signed, sets, percent)


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile_rows: int = 256) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: of the smallest id, null ids last.

    Rows are told apart by id and text, so a repeated id with another text is judged by that text. Rows of equal id and text
    stay once, chosen by a hash of all columns. Rows without shingles have no links, so only those repeated whole go.
    """
    found = written(with_components(argument(docs, "doc_id", "text"), words, percent, tile_rows).select("doc_id", "mark", "n", "first"), "components")
    stands = F.col("first").isNull() | F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    gone = found.where(~stands).select("doc_id", "mark").distinct()
    every = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"], F.xxhash64(docs["text"]).alias("mark"), F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns]).alias("hash")
    )

    def met(keys: DataFrame):
        return every["doc_id"].eqNullSafe(keys["doc_id"]) & (every["mark"] == keys["mark"])

    kept = every.join(moved(gone), met(gone), "left_anti")
    twice = found.where(stands).groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("n")).where("times > 1")
    if twice.isEmpty():
        return kept.select("row.*")
    copies = kept.join(moved(twice), met(twice)).select("row", every["doc_id"], every["mark"], "hash", F.when(F.col("n") == 0, F.col("hash")).alias("whole"))
    once = copies.groupBy("doc_id", "mark", "whole").agg(F.min_by("row", "hash").alias("row"))
    return kept.join(moved(twice), met(twice), "left_anti").select("row.*").union(once.select("row.*"))
