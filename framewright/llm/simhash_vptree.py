"""SimHash near-duplicates with vantage-point trees over Hamming distance.

Fingerprints are 64-bit majorities of shingle hashes.  All pairs within ``radius`` bits
are found exactly: of the two 32-bit halves of such a pair one differs in at most
radius // 2 bits, so each half gets a vantage-point tree for that smaller radius.  The
tree's top is fitted on the driver from a bounded sample; every distinct fingerprint has
one home shard and also asks the shards that its search ball overlaps: with vantage v
and boundary m, the triangle bound lets a query at distance d skip the inside if
d > m + r and the outside if d <= m - r.  Shards that hold more than CROWDED times what they
are meant to are split again, by trees that tasks fit on samples of each such shard alone,
until none is left: by the same half, or, where most of a shard agrees in that half, by the
whole fingerprint and the whole radius.  A shard continues the tree in memory.  Shards
return a spanning forest of the pairs that they find, so the output is linear in the
number of fingerprints however dense a cluster is; connectivity is exact.

Copies of one fingerprint collapse before the search.  Half trees keep the overlap
small: at each level about a quarter of the queries go both ways, against half of them
for whole fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .components import components
from .words import LOWER, Words, chunks

SAMPLE = 65_536  # most fingerprints that the tree's top is fitted on
SHARD = 16_384  # fingerprints that a shard is meant to hold
LEAF = 64  # pairs of sample points below which a node is not split
CROWDED = 4  # times SHARD from which a shard is split again
REFIT = 4096  # sample points of a crowded shard, about


def fingerprint(parts: list[bytes]) -> int:
    """Majority bits of the XXH64 (seed 42) of each part; none give zero."""
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(p, 42) for p in parts), np.uint64, len(parts))
    return majority(h)


def majority(h: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int((ones * 2 > len(h)).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def text_shingles(column: pa.Array, shingle: int):
    """The shingle hashes of each text in turn, with repeats."""
    words = Words(column)
    digest = xxhash.xxh64_intdigest
    low = LOWER[words.data].tobytes()
    for t in range(len(column)):
        a, b = int(words.first[t]), int(words.first[t + 1])
        if a == b:
            yield np.zeros(0, np.uint64)
            continue
        flat = b" ".join(low[words.offsets[t] : words.offsets[t + 1]].split())
        size = words.ends[a:b] - words.starts[a:b]
        end = np.cumsum(size + 1) - 1
        if b - a <= shingle:
            yield np.array([digest(flat, 42)], np.uint64)
            continue
        start = (end - size)[: b - a - shingle + 1].tolist()
        yield np.fromiter((digest(flat[i:j], 42) for i, j in zip(start, end[shingle - 1 :].tolist())), np.uint64, len(start))


def text_fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    return np.fromiter((majority(h) for h in text_shingles(column, shingle)), np.uint64, len(column))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row; fp is the fingerprint's 64 bits as a signed long."""

    def compute(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                fp = text_fingerprints(part.column(1), shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    store.arrow_limits(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(store.trimmed(compute), "doc_id long, fp long")


class Tree:
    """Top of a vantage-point tree over 32-bit or 64-bit keys, as flat arrays.

    Node i has a vantage, a boundary m and two children; a negative child -1 - s is the
    shard s.  Points at distance <= m are inside.
    """

    def __init__(self, sample: np.ndarray, depth: int, leaf: int = LEAF):
        self.nodes: list[list[int]] = []
        self.shards, self.leaf = 0, leaf
        self.root = self._build(np.unique(sample), depth)
        self.table = np.array(self.nodes, object).reshape(-1, 4)

    @classmethod
    def of(cls, nodes: list[int], root: int) -> Tree:
        """The tree that :meth:`flat` gave."""
        out = cls.__new__(cls)
        out.table, out.root = np.array([x % (1 << 64) if i % 4 == 0 else x for i, x in enumerate(nodes)], object).reshape(-1, 4), root
        out.shards = len(out.table) + 1
        return out

    def flat(self) -> list[int]:
        """All nodes as signed 64-bit integers."""
        return [x - (1 << 64) if x >> 63 > 0 else x for row in self.nodes for x in row]

    def _leaf(self) -> int:
        self.shards += 1
        return -self.shards

    def _build(self, points: np.ndarray, depth: int) -> int:
        if depth == 0 or len(points) < self.leaf:
            return self._leaf()
        vantage = points[len(points) // 2]
        d = np.bitwise_count(points ^ vantage).astype(np.int64)
        m = int(np.median(d))
        if (d <= m).all():
            m -= 1
        if not (d <= m).any():
            return self._leaf()
        at = len(self.nodes)
        self.nodes.append([int(vantage), m, 0, 0])
        self.nodes[at][2] = self._build(points[d <= m], depth - 1)
        self.nodes[at][3] = self._build(points[d > m], depth - 1)
        return at

    def route(self, keys: np.ndarray, radius: int, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of key, shard, is home) for each shard that the key lives in or asks.

        ``home`` (default: all) tells which keys live here; others only ask.
        """
        out = []
        todo = [(self.root, np.arange(len(keys)), np.ones(len(keys), bool) if home is None else home)]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out.append((at, np.full(len(at), -1 - node), home))
                continue
            vantage, m, inside, outside = self.table[node].tolist()
            d = np.bitwise_count(keys[at] ^ keys.dtype.type(vantage)).astype(np.int64)
            go = d <= m + radius
            todo.append((inside, at[go], home[go] & (d[go] <= m)))
            go = d > m - radius
            todo.append((outside, at[go], home[go] & (d[go] > m)))
        if not out:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool))
        return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    """Union-find that keeps the edges which joined two sets."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Adds edges in rounds: each set takes one edge to a smaller set, then all shorten."""
        p = self.parent
        while len(a):
            ra, rb = p[a], p[b]
            keep = ra != rb
            a, b, ra, rb = a[keep], b[keep], ra[keep], rb[keep]
            if not len(a):
                break
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, first = np.unique(high, return_index=True)
            p[high[first]] = low[first]
            self.kept.append((a[first], b[first]))
            while True:
                q = p[p]
                if (q == p).all():
                    break
                p[:] = q


def search(members: np.ndarray, queries: np.ndarray, fps: np.ndarray, half: np.ndarray, radius: int, near: int, forest: Forest, depth: int = 0) -> None:
    """Adds all (member, query) pairs whose fps differ in <= radius bits and halves in <= near."""
    if not len(members) or not len(queries):
        return
    if len(members) > 128 and depth < 40:
        d = np.bitwise_count(half[members] ^ half[members[len(members) // 2]]).astype(np.int64)
        m = int(np.median(d))
        if (d <= m).all():
            m -= 1
        inside = d <= m
        if inside.any():
            q = np.bitwise_count(half[queries] ^ half[members[len(members) // 2]]).astype(np.int64)
            a, b = q <= m + near, q > m - near
            if max(a.sum() * inside.sum(), b.sum() * (~inside).sum()) < 0.9 * len(members) * len(queries):
                search(members[inside], queries[a], fps, half, radius, near, forest, depth + 1)
                search(members[~inside], queries[b], fps, half, radius, near, forest, depth + 1)
                return
    rows = max(1, (1 << 20) // len(members))
    for at in range(0, len(queries), rows):
        q = queries[at : at + rows]
        hit_q, hit_m = np.nonzero(np.bitwise_count(fps[q][:, None] ^ fps[members][None, :]) <= radius)
        a, b = q[hit_q], members[hit_m]
        keep = a != b
        forest.add(a[keep], b[keep])


def _shard_forest(table: pa.Table, radius: int) -> pa.Table:
    fps = table.column("fp").to_numpy().view(np.uint64)
    home = table.column("home").to_numpy(zero_copy_only=False)
    side = table.column("shard")[0].as_py() & 1
    order = np.argsort(~home, kind="stable")
    fps, home = fps[order], home[order]
    half = _half(fps, side)
    forest = Forest(len(fps))
    search(np.flatnonzero(home), np.arange(len(fps)), fps, half, radius, radius // 2, forest)
    a = np.concatenate([x for x, _ in forest.kept] or [np.zeros(0, np.int64)])
    b = np.concatenate([x for _, x in forest.kept] or [np.zeros(0, np.int64)])
    return pa.table({"a": fps[a].view(np.int64), "b": fps[b].view(np.int64)})


def links(distinct: DataFrame, radius: int = 3, shard: int = SHARD, lots: int = 1) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp`` that connect every pair within radius.

    With ``lots``, a column lot (0 .. lots - 1) says which fingerprints meet: only those of
    one lot.  Each lot has its own shards, of trees with the same vantages.
    """
    n = distinct.count()
    share = min(1.0, SAMPLE / max(n, 1))
    rows = distinct.where(F.pmod(F.xxhash64(F.lit(7), "fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * SAMPLE).select("fp").toArrow()
    sample = rows.column("fp").to_numpy().view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / (shard * lots)))))
    trees = [Tree(_half(sample, side), depth) for side in (0, 1)]
    width = max(t.shards for t in trees)

    def route(batches):
        for batch in batches:
            fps, lot = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for side, tree in enumerate(trees):
                at, to, home = tree.route(_half(fps, side), radius // 2)
                yield pa.RecordBatch.from_arrays([pa.array((lot[at] * width + to) * 2 + side), pa.array(fps[at].view(np.int64)), pa.array(home)], ["shard", "fp", "home"])

    named = distinct.select("fp", F.col("lot").cast("long") if lots > 1 else F.lit(0).cast("long").alias("lot"))
    placed = store.cut(named.mapInArrow(store.trimmed(route), "shard long, fp long, home boolean"), "placed")
    placed = uncrowded(placed, radius, shard, 2 * lots * width)
    return placed.groupBy("shard").applyInArrow(lambda t: _shard_forest(t, radius), "a long, b long")


def _half(fps: np.ndarray, side: int) -> np.ndarray:
    return (fps >> np.uint64(32 * side)).astype(np.uint32)


def _refit(table: pa.Table, shard: int) -> pa.Table:
    """The tree of one crowded shard, from its sample (shard, c, fp); c: how many live there."""
    name, n = table.column("shard")[0].as_py(), table.column("c")[0].as_py()
    fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
    depth = max(1, int(np.ceil(np.log2(n / shard))))
    leaf = max(2, min(LEAF, len(fps) // 8))
    half = _half(fps, name & 1)
    tree, whole = Tree(half, depth, leaf), False
    at, to, home = tree.route(half, 0)
    if np.bincount(to[home]).max() > 0.9 * len(fps):  # most agree in this half
        tree, whole = Tree(fps, depth, leaf), True
    return pa.table({"shard": [name], "root": [tree.root], "whole": [whole], "nodes": pa.array([tree.flat()], pa.list_(pa.int64()))})


def uncrowded(placed: DataFrame, radius: int, shard: int, names: int) -> DataFrame:
    """placed (shard, fp, home) with crowded shards split; names: shard numbers in use.

    What reaches the driver is one tree for each crowded shard, a node for some ``shard``
    fingerprints.  A shard number's lowest bit is the side that it is searched by.
    """
    spark = placed.sparkSession
    for _ in range(40):
        crowd = placed.where("home").groupBy("shard").agg(F.count("*").alias("c")).where(F.col("c") > CROWDED * shard)
        crowd = store.cut(crowd, "crowd")
        lots = F.pmod(F.xxhash64("fp", F.lit(13)), F.lit(1 << 30)) < F.lit(float(REFIT << 30)) / F.col("c")
        sample = placed.where("home").join(crowd, "shard").where(lots).select("shard", "c", "fp")
        fitted = sample.groupBy("shard").applyInArrow(lambda t: _refit(t, shard), "shard long, root long, whole boolean, nodes array<long>")
        rows = [r for r in fitted.toLocalIterator() if len(r["nodes"])]
        if not rows:
            return placed
        split = {}
        for r in sorted(rows, key=lambda r: r["shard"]):
            split[r["shard"]] = (names // 2 + 1, r["root"], r["whole"], r["nodes"])
            names += 2 * (len(r["nodes"]) // 4 + 2)
        sent = spark.sparkContext.broadcast(split)

        def route(batches, sent=sent):
            for batch in batches:
                shards, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
                home = batch.column(2).to_numpy(zero_copy_only=False)
                stay = ~np.isin(shards, np.fromiter(sent.value, np.int64, len(sent.value)))
                out = [(shards[stay], fps[stay], home[stay])]
                for name in np.unique(shards[~stay]).tolist():
                    first, root, whole, nodes = sent.value[name]
                    own = np.flatnonzero(shards == name)
                    keys = fps[own] if whole else _half(fps[own], name & 1)
                    at, to, lives = Tree.of(nodes, root).route(keys, radius if whole else radius // 2, home[own])
                    out.append(((to + first) * 2 + (name & 1), fps[own[at]], lives))
                cols = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1].view(np.int64)), pa.array(cols[2])], ["shard", "fp", "home"])

        after = store.cut(placed.mapInArrow(store.trimmed(route), "shard long, fp long, home boolean"), "placed")
        for old in (placed, crowd):
            store.drop(spark, old)
        placed = after
    return placed


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text).

    Texts are lower-cased (A-Z), cut into words outside 0x20 and 0x09-0x0D and into
    ``shingle``-word shingles with repeats (fewer words: the whole sequence).  A bit of
    the fingerprint is set if over half of the shingles' XXH64 (seed 42) have it; no
    words give zero, which links like any other.  Rows link at ``radius`` or fewer
    differing bits; component_id is the smallest doc_id that a row reaches.

    Null texts count as empty.  A row with a null doc_id links others but gives its
    component an id only if no other row does (null then).  Repeated rows stay repeated.
    Other columns are ignored; an empty table gives no rows.
    """
    prints = store.cut(fingerprints(docs, shingle), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = store.cut(distinct, "distinct")
    edges = links(distinct, radius)
    names = components(edges)
    grouped = distinct.join(names.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    lookup = store.cut(grouped.join(least, "component").select("fp", "component_id"), "lookup")
    return prints.join(lookup, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 3, shingle: int = 3, similarity: float | None = None) -> DataFrame:
    """The rows of docs without those whose component has a smaller doc_id.

    With ``similarity``, rows link by the exact similarity of their sets of shingles instead
    of by bits.  At 0.8 fingerprints lie some ten bits apart, and a ball of that radius meets
    nearly every shard of a vantage-point tree; so texts then have further fingerprints, of
    samples of their shingles, and those that the trees find near are candidates
    (:mod:`shingle_dedup`).  Rows that share a doc_id are one document and go together;
    a row with a null doc_id stays.  All columns pass through; an empty table stays empty.
    """
    if similarity is None:
        found = near_duplicates(docs, radius, shingle)
    else:
        from . import shingle_dedup

        found = shingle_dedup.near_duplicates(docs, shingle, similarity)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
