"""Links of operator 8 by similarity: the exact Jaccard similarity of sets of word shingles.

Texts with equal sets are one node.  Each has operator 8's SimHash of its whole set and
SAMPLES further ones, each of the TAKEN shingles that come first in an order of its own.  Two
texts at similarity 0.8 take the same shingles in one order with a chance of about 0.64, so
all samples miss such a pair with a chance of about 1 in 25,000, where the SimHashes of whole
sets (some ten bits apart) would miss most.  Vantage-point trees find the fingerprints of one
order within RADIUS bits; what they connect is a bucket.  As in :mod:`line_dedup`, all texts of a bucket
are first held against its most frequent text, and only buckets whose texts are then still in
different components are joined with themselves.  The whole sets of a candidate pair decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash_vptree, store
from .components import components
from .simhash_vptree import majority, text_shingles
from .words import chunks, mix64, stream64

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES = 10
TAKEN = 2
RADIUS = 3
_SALT = stream64(23, 2 * SAMPLES)


def name_of(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a sorted set."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def fingerprints_of(shingles: np.ndarray) -> np.ndarray:
    """SimHashes of a set: of the whole, and of each sample; the samples' hashes are salted, so that no two orders meet."""
    out = [majority(shingles)] if len(shingles) else [0]
    for order, salt in zip(_SALT[::2], _SALT[1::2]):
        taken = shingles
        if len(shingles) > TAKEN:
            taken = shingles[np.argpartition(mix64(shingles ^ order), TAKEN)[:TAKEN]]
        out.append(majority(mix64(taken ^ salt)))
    return np.array(out, np.uint64).view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, sid, n, fps) of every row: name, size and fingerprints of its set of shingles."""

    def compute(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = [np.unique(h) for h in text_shingles(part.column(1), shingle)]
                cols = [part.column(0), pa.array([name_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([fingerprints_of(s) for s in sets], pa.list_(pa.int64()))], ["doc_id", "sid", "n", "fps"])

    return docs.select("doc_id", "text").mapInArrow(store.trimmed(compute), "doc_id long, sid long, n long, fps array<long>")


def bucketed(nodes: DataFrame) -> DataFrame:
    """(key, sid): the buckets of each set, one for each of its fingerprints (nodes: sid, fps)."""
    spark = nodes.sparkSession
    rows = store.cut(nodes.select("sid", F.posexplode("fps").alias("lot", "fp")), "fps")
    distinct = store.cut(rows.select("lot", "fp").distinct(), "distinct")
    near = components(simhash_vptree.links(distinct, RADIUS, lots=1 + SAMPLES)).withColumnRenamed("node", "fp")
    store.drop(spark, distinct)
    # a lot is part of the name: without it, sets of few shingles could meet in two lots
    return rows.join(near, "fp", "left").select(F.xxhash64("lot", F.coalesce("component", "fp")).alias("key"), "sid")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Of the pairs (a, b) of set names those at the similarity or more; nodes: sid, least (a doc_id)."""

    def compute(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = [np.unique(h) for h in text_shingles(part.column(1), shingle)]
                same = pa.array([name_of(s) == w for s, w in zip(sets, part.column(0).to_pylist())])  # rows that share a doc_id may hold other texts
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["sid", "shingles"])
                yield out.filter(same)

    near = store.cut(pairs.distinct(), "pairs")
    wanted = near.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(nodes.select("sid", "least"), "sid")
    asked = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["least"])).select("sid", "text")
    sets = store.cut(asked.mapInArrow(store.trimmed(compute), "sid long, shingles array<long>").dropDuplicates(["sid"]), "sets")
    both = near.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b")
    both = both.select("a", "b", F.size("x").alias("p"), F.size("y").alias("q"), F.size(F.array_intersect("x", "y")).alias("common"))
    return store.cut(both.where(F.col("common") >= similarity * (F.col("p") + F.col("q") - F.col("common")) - 1e-9).select("a", "b"), "links")


def links(nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Edges (a, b) that connect every candidate pair of distinct sets at the similarity."""
    rows = store.cut(bucketed(nodes), "keys")
    shared = store.cut(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "shared")
    busy = store.cut(rows.join(shared, "key"), "buckets")
    busy = store.cut(busy.join(nodes.select("sid", "n", "copies"), "sid"), "figures")
    sizes = lambda a, b: F.least(a, b) >= F.greatest(a, b) * similarity - 1e-9
    hub = store.cut(busy.groupBy("key").agg(F.max(F.struct("copies", "sid", "n")).alias("hub")), "hubs")
    hub = hub.select("key", F.col("hub.sid").alias("hub_sid"), F.col("hub.n").alias("hub_n"))
    near_hub = busy.join(hub, "key").where("sid <> hub_sid").where(sizes("n", "hub_n"))
    first = verified(near_hub.select(F.least("sid", "hub_sid").alias("a"), F.greatest("sid", "hub_sid").alias("b")), nodes, docs, shingle, similarity)
    names = components(first)
    named = busy.join(names.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    named = store.cut(named.select("key", "sid", "n", "component"), "named")
    mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    left = store.cut(named.join(mixed, "key", "left_semi"), "mixed")
    side = {s: left.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("sid", "n", "component"))) for s in "ab"}
    pairs = side["a"].join(side["b"], "key").where("component_a < component_b").where(sizes("n_a", "n_b"))
    pairs = pairs.select(F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b"))
    return first.unionByName(verified(pairs, nodes, docs, shingle, similarity))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) for each row of docs (doc_id, text).

    Words and shingles are those of :func:`simhash_vptree.near_duplicates`, without repeats.
    Rows link at ``similarity`` or more, texts without a word with one another; component_id is
    the smallest doc_id that a row reaches.  Null texts count as empty; a null doc_id links
    others but names a component only if no other row does (null then).
    """
    store.arrow_limits(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = store.cut(sketches(base, shingle), "prints")
    nodes = prints.groupBy("sid").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("fps").alias("fps"), F.count("*").alias("copies"))
    nodes = store.cut(nodes, "nodes")
    names = components(links(nodes, base, shingle, similarity))
    grouped = nodes.select("sid", "least").join(names.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    lookup = store.cut(grouped.join(least, "component").select("sid", "component_id"), "lookup")
    return prints.select("doc_id", "sid").join(lookup, "sid").select("doc_id", "component_id")
