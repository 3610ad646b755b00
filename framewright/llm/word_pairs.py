"""Class-conditional interpolated Kneser-Ney models over pairs of words, with exact counts.

c(v, w) is the number of a class's texts that have the word w right after v (none at a
text's start), f(w) the number of different v with c(v, w) > 0, and
P(w | v) = max(c(v, w) - PAIR, 0) / n(v) + reserve(v) * low(w), with
low(w) = max(f(w) - SINGLE, 0) / f + reserve * shared(w), where n(v) and f are sums over w,
each reserve is the share that the discounts min(c, PAIR) or min(f, SINGLE) leave, and
shared(w) goes by f(w) over both classes together.  So every history's distribution sums
to one.  Texts are counted, not occurrences: what a text repeats says as much once.  PAIR
is the discount with the least log loss across the two folds of sf0.1 that are learned from.

Every task sends its pairs on in packets, one for each bucket of words: the pairs that end
in the bucket's words, and how often these words are histories.  So all pairs of a word meet
in its bucket, and its continuation counts are exact.  Left out of the written model is only
what changes no ratio: pairs without mass of their own in either class, and words that have
none, that no kept pair ends in and that begin none (their ratio is the reserves').
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, toxicity
from .words import PLAIN, Words, chunks, mix64

PAIR = 3.0  # discount of pairs
SINGLE = 1.0  # discount of continuation counts
MOST = 4.0  # largest log ratio of a word after a word; pairs have fewer counts than words, so a lower one
BUCKETS = 48  # buckets of words at least
BUCKET = 8000  # texts that a bucket is meant to hold the pairs of
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Columns of each model's classes: a slot's own, or a (0 and 2) and b (1 and 3) of both folds
SIDES = {"all": ("a", "b"), "first": ("0", "1"), "second": ("2", "3")}
_ALL = ("0", "1", "2", "3", "a", "b")


def histories(words: Words, h: np.ndarray) -> np.ndarray:
    """The name of the word before each word; 0 at a text's start."""
    before = np.zeros(len(h), np.uint64)
    before[1:] = h[:-1]
    first = words.first[:-1]
    before[first[first < len(h)]] = 0
    return before


def pair_names(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(v + _ODD) * _ODD + w)


def _added(names: np.ndarray, keys: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rows of one name added up, by name; keys follow it, counts (a row for each slot) are summed."""
    if not len(names):
        return names, keys, counts
    order = np.argsort(names)
    names = names[order]
    at = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    first = order[at]
    return names[at], [k[first] for k in keys], np.add.reduceat(counts[:, order], at, axis=1, dtype=counts.dtype)


def pairs_of(texts: pa.Array, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(v, w, counts by slot) of the texts' pairs, each once a text."""
    words = Words(texts, PLAIN)
    w = words.hashes(3)
    v = histories(words, w)
    n = np.diff(words.first)
    names = pair_names(v, w)
    with np.errstate(over="ignore"):
        _, once = np.unique(names + np.repeat(np.arange(len(n)), n).astype(np.uint64) * _ODD, return_index=True)
    counts = (np.repeat(slots, n)[once] == np.arange(4)[:, None]).astype(np.uint32)
    _, (v, w), counts = _added(names[once], [v[once], w[once]], counts)
    return v, w, counts


def _packets(v: np.ndarray, w: np.ndarray, counts: np.ndarray, buckets: int):
    """(bucket, packet) of pairs: for each bucket its words' pairs, and its words' counts as histories."""
    h, _, n = _added(v, [], counts)
    order = np.argsort(w)
    v, w, counts = v[order], w[order], counts[:, order]
    to, of = (w % np.uint64(buckets)).astype(np.int64), (h % np.uint64(buckets)).astype(np.int64)
    order, history = np.argsort(to, kind="stable"), np.argsort(of, kind="stable")
    ends, lasts = np.cumsum(np.bincount(to, minlength=buckets)), np.cumsum(np.bincount(of, minlength=buckets))
    for b in range(buckets):
        own, past = order[ends[b - 1] if b else 0 : ends[b]], history[lasts[b - 1] if b else 0 : lasts[b]]
        if not len(own) and not len(past):
            continue
        x = w[own]
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
        before, place = np.unique(v[own], return_inverse=True)
        wide = np.uint16 if len(before) <= 1 << 16 else np.uint32
        sizes = np.array([len(at), len(before), len(own), len(past)], np.uint32)
        c = counts[:, own]
        code = np.where(c.sum(axis=0) == 1, c.argmax(axis=0), 4).astype(np.uint8)  # most pairs are of one text
        parts = [sizes, x[at], np.diff(np.append(at, len(x))).astype(np.uint32), before, place.astype(wide), code, c[:, code == 4], h[past], n[:, past]]
        yield b, b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpacked(packet: bytes) -> tuple[np.ndarray, ...]:
    """(v, w, counts, h, n) of a packet."""
    at = 0

    def take(kind, n):
        nonlocal at
        out = np.frombuffer(packet, kind, n, at)
        at += out.nbytes
        return out

    words, before, pairs, past = take(np.uint32, 4).tolist()
    w = np.repeat(x := take(np.uint64, words), take(np.uint32, len(x)))
    names = take(np.uint64, before)
    v = names[take(np.uint16 if before <= 1 << 16 else np.uint32, pairs)]
    code = take(np.uint8, pairs)
    counts = (code == np.arange(4, dtype=np.uint8)[:, None]).astype(np.uint32)
    counts[:, code == 4] = take(np.uint32, 4 * int((code == 4).sum())).reshape(4, -1)
    return v, w, counts, take(np.uint64, past), take(np.uint32, 4 * past).reshape(4, -1)


def _sides(counts: np.ndarray) -> np.ndarray:
    """Counts by slot, and by class after them."""
    return np.concatenate([counts, counts[:2] + counts[2:]])


_COUNTED = "v long, w long, c0 long, c1 long, c2 long, c3 long, fa long, fb long, k long, used boolean, n0 long, n1 long, n2 long, n3 long"


def _bucket(table: pa.Table) -> pa.Table:
    """Rows of :func:`counted` from a bucket's packets."""
    v, w, counts, h, n = (np.concatenate(x, axis=-1) for x in zip(*(_unpacked(p.as_py()) for p in table.column("packet"))))
    _, (v, w), counts = _added(pair_names(v, w), [v, w], counts.astype(np.int64))
    order = np.argsort(w)
    v, w, sides = v[order], w[order], _sides(counts[:, order])
    kept = (sides[4:] > PAIR).any(axis=0)
    name, _, f = _added(w, [], np.concatenate([(sides > 0).astype(np.int64), np.ones((1, len(w)), np.int64), kept[None].astype(np.int64)]))
    h, _, n = _added(h, [], n.astype(np.int64))
    every = np.union1d(name, h)
    out = np.zeros((12, len(every)), np.int64)  # f0 .. f3, fa, fb, k, used, n0 .. n3
    out[:8, np.searchsorted(every, name)] = f
    out[8:, np.searchsorted(every, h)] = n
    pairs = [v[kept].view(np.int64), w[kept].view(np.int64), *sides[:4, kept], *[None] * 8]
    cols = []
    for i, (field, pair) in enumerate(zip(_COUNTED.split(", "), pairs)):
        kind = pa.bool_() if field.endswith("boolean") else pa.int64()
        mine = pa.nulls(len(every), kind) if i == 0 else pa.array(every.view(np.int64) if i == 1 else out[i - 2] > 0 if i == 9 else out[i - 2])
        cols.append(pa.chunked_array([mine, pa.nulls(int(kept.sum()), kind) if pair is None else pa.array(pair)]))
    return pa.table(cols, [f.split()[0] for f in _COUNTED.split(", ")])


def counted(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts over docs (text, slot 0..3), in two kinds of rows.

    v null: a word w, the different words before it by slot (c0 .. c3), by class (fa, fb) and
    in all (k), whether a kept pair ends in it (used), and the sum of the pairs that it begins
    by slot (n0 .. n3).  Others: a kept pair, the texts that have it by slot (c0 .. c3).
    """

    def count(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def packets():
            v, w, c = (np.concatenate(x, axis=-1) for x in zip(*held))
            _, (v, w), c = _added(pair_names(v, w), [v, w], c)
            for b, packet in _packets(v, w, c, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packet], pa.binary())], ["bucket", "packet"])

        for batch in batches:
            for part in chunks(batch, "text"):
                held.append(pairs_of(part.column(0), part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)))
                size += len(held[-1][0])
                if size > toxicity.HELD:
                    yield from packets()
                    held, size = [], 0
        if held:
            yield from packets()

    return docs.select("text", "slot").mapInArrow(count, "bucket int, packet binary").groupBy("bucket").applyInArrow(_bucket, _COUNTED)


def sums_of(words: DataFrame) -> dict:
    """The sums of the continuation counts (f), of their discounted part (r) and in all (k)."""
    column = {s: F.col(f"f{s}" if s in "ab" else f"c{s}").cast("double") for s in _ALL}
    f = [F.sum(column[s]).alias(f"f{s}") for s in _ALL]
    r = [F.sum(F.least(column[s], F.lit(SINGLE))).alias(f"r{s}") for s in _ALL]
    return {k: x or 0.0 for k, x in words.agg(F.sum("k").cast("double").alias("k"), *f, *r).first().asDict().items()}


def lower(f: np.ndarray, k: np.ndarray, sums: dict, side: str) -> np.ndarray:
    """low(w) of words by their continuation counts in a class and in all."""
    total = sums[f"f{side}"]
    reserve = sums[f"r{side}"] / total if total else 1.0
    return np.maximum(f - SINGLE, 0) / max(total, 1) + reserve * k / (sums["k"] + 1000)


def pair_model(marked: DataFrame) -> PairModel:
    """The written model over marked texts (text, slot), a table of its own."""
    spark = marked.sparkSession
    rows = store.cut(counted(marked, max(BUCKETS, marked.count() // BUCKET)), "counted")
    sums = sums_of(rows.where("v is null"))
    past = [F.col("n0") + F.col("n2") > PAIR, F.col("n1") + F.col("n3") > PAIR]  # less begins no kept pair
    kept = rows.where(F.col("v").isNotNull() | (F.col("fa") > SINGLE) | (F.col("fb") > SINGLE) | F.col("used") | past[0] | past[1])
    blocks = max(1, -(-kept.count() // toxicity.BLOCK_WORDS))
    folder = store.new_path(spark, "model")
    # pairs lie with their history, whose sums they are part of
    block, kind = F.pmod(F.coalesce("v", "w"), F.lit(blocks)).cast("int"), F.when(F.col("v").isNull(), "word").otherwise("pair")
    kept.withColumns({"kind": kind, "block": block}).drop("used").repartition(blocks, "block").write.partitionBy("kind", "block").parquet(folder)
    store.drop(spark, rows)
    return PairModel(folder, blocks, sums)


class PairModel:
    """A written model: the folder of its tables, each in blocks, and the sums."""

    def __init__(self, folder: str, blocks: int, sums: dict):
        self.folder, self.blocks, self.sums = folder, blocks, sums

    def figures(self, parts: list[tuple[pa.Array, str]]) -> list[np.ndarray]:
        """For each (texts, model name): the log mean ratio of each text; 0 for texts without a word."""
        asked = []
        for texts, model in parts:
            words = Words(texts, PLAIN)
            w = words.hashes(3)
            v = histories(words, w)
            low = np.stack([np.full(len(w), lower(0.0, 1.0, self.sums, s)) for s in SIDES[model]])
            asked.append((words, model, w, v, pair_names(v, w), low, np.zeros((2, len(w))), np.ones((2, len(w)))))
        for b in range(self.blocks):
            for _, model, w, v, pair, low, own, reserve in asked:
                table, value, pairs, masses = _block(self.folder, b, model)
                at, hit = _found(table, w)
                for i, s in enumerate(SIDES[model]):
                    low[i, hit] = lower(value[i, at], value[2, at], self.sums, s)
                at, hit = _found(table, v)
                reserve[:, hit] = value[3:, at]
                at, hit = _found(pairs, pair)
                own[:, hit] = masses[:, at]
        out = []
        for words, _, _, _, _, low, own, reserve in asked:
            p = own + reserve * low
            total = np.concatenate([[0.0], np.cumsum(np.minimum(p[1] / p[0], math.exp(MOST)))])
            size = np.diff(words.first)
            mean = (total[words.first[1:]] - total[words.first[:-1]]) / np.maximum(size, 1)
            out.append(np.where(size > 0, np.log(np.maximum(mean, 1e-12)), 0.0))
        return out


def _found(table: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the sorted table, places of the names) where a name is in the table."""
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(table, names), len(table) - 1)
    hit = np.flatnonzero(table[at] == names)
    return at[hit], hit


@lru_cache(maxsize=2)
def _block(folder: str, block: int, model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted words, their figures, sorted pairs, their own masses by class) of a written block.

    A word's figures: its continuation counts by class and in all, its reserves as a history by class.
    """
    a, b = SIDES[model]
    f, c = {"a": ["fa"], "b": ["fb"]}, {"a": [0, 2], "b": [1, 3]}

    def read(kind: str, column: str) -> np.ndarray:
        return store.read_part(f"{folder}/kind={kind}", f"block={block}", [column]).column(0).to_numpy()

    def added(kind: str, columns: list[str]) -> np.ndarray:
        out = read(kind, columns[0]).astype(np.float64)
        for x in columns[1:]:
            out += read(kind, x)
        return out

    name = read("word", "w").view(np.uint64)
    order = np.argsort(name)
    name = name[order]
    figures = np.empty((5, len(name)))
    for i, columns in enumerate([*(f.get(s, [f"c{s}"]) for s in (a, b)), ["k"]]):
        figures[i] = added("word", columns)[order]
    v, w = (read("pair", x).view(np.uint64) for x in ("v", "w"))
    at = np.searchsorted(name, v)  # a kept pair's history is kept
    pair = pair_names(v, w)
    del v, w
    by = np.argsort(pair)
    own = np.empty((2, len(pair)))
    for i, s in enumerate((a, b)):
        n = added("word", [f"n{x}" for x in c.get(s, [s])])[order]
        mass = np.maximum(added("pair", [f"c{x}" for x in c.get(s, [s])]) - PAIR, 0)
        figures[3 + i] = np.where(n > 0, (n - np.bincount(at, weights=mass, minlength=len(name))) / np.maximum(n, 1), 1)
        own[i] = (mass / np.maximum(n[at], 1))[by]
    pa.default_memory_pool().release_unused()
    return name, figures, pair[by], own
