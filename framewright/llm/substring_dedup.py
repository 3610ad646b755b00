"""Exact removal of repeated word windows, found by recompression.

Every text is a sequence of word symbols.  Rounds of recompression replace runs of an
equal symbol and then (left, right) pairs by new symbols; the name of a symbol is a
64-bit function of its parts and the sides of a round are a bit of each name, so all
tasks and all documents name equal content alike without talking to each other.  Each
symbol carries its *context*: the words that alone decide that it is cut out this way.
A window that holds a symbol's context therefore holds the same symbol wherever its
words occur.  Each window takes the highest-level symbol with its context inside (the
one of least priority) as anchor; a single word is the last resort, so every window has
one.  Runs of windows with one anchor form a *block*.

Spark then names what repeats: contexts are counted by key (partial counts first).  A
context that has one block content is a plain repeat: all occurrences but the first are
marked.  Contexts with several contents keep one occurrence of each content, and those
windows are compared by a 128-bit hash of their words.  Keys and blocks use independent
word hashes, so a plain repeat is verified by 128 bits as well.  No step gathers the
occurrences of one key; a hot key is an aggregation and a join that may be split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .words import Words, chunks, mix64, stream64

ROUNDS = 3
_FAR = np.int64(1) << np.int64(40)
_C1, _C2 = (int(x) | 1 for x in stream64(71, 2))
_R1, _R2 = (int(x) | 1 for x in stream64(73, 2))
_NULL_ID = -(2**63)


def _u(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def _pair_name(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    return mix64(a * _u(_C1) + mix64(b + _u(level * 977 + 1)) * _u(_C2))


class _Ranges:
    """Hashes of word ranges from prefix sums: sum of word * r^(place in the range)."""

    def __init__(self, names: np.ndarray, root: int):
        n = len(names)
        power = np.full(n + 1, _u(root))
        power[0] = 1
        inverse = np.full(n + 1, _u(pow(root, -1, 1 << 64)))
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(names * np.cumprod(power, dtype=np.uint64)[:n], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        return mix64(total + (end - begin).astype(np.uint64) * _u(_C2))


class Level:
    """Symbols of one level: name, first word, document and context [low, high) in words."""

    __slots__ = ("doc", "high", "low", "name", "start")

    def __init__(self, name, start, doc, low, high):
        self.name, self.start, self.doc, self.low, self.high = name, start, doc, low, high


def _beside(x: Level) -> tuple[np.ndarray, np.ndarray]:
    """Context of the symbol before and after each one; out of reach at a text's ends."""
    before = np.full(len(x.low), -_FAR)
    after = np.full(len(x.low), _FAR)
    same = x.doc[1:] == x.doc[:-1]
    before[1:] = np.where(same, x.low[:-1], -_FAR)
    after[:-1] = np.where(same, x.high[1:], _FAR)
    return before, after




def _runs(x: Level) -> Level:
    """Names each maximal run of one symbol; its context takes in both neighbours."""
    head = np.ones(len(x.name), bool)
    head[1:] = (x.name[1:] != x.name[:-1]) | (x.doc[1:] != x.doc[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(head)))
    last = at + length - 1
    before, after = _beside(x)
    name = np.where(length > 1, _pair_name(x.name[at], length.astype(np.uint64), 99), x.name[at])
    return Level(name, x.start[at], x.doc[at], before[at], after[last])


def _pairs(x: Level, level: int) -> Level:
    """Names each (left, right) neighbour pair; a bit of the name is a symbol's side."""
    left = (mix64(x.name ^ _u(0x5851F42D4C957F2D * (level + 1))) >> np.uint64(63)).astype(bool)
    joins = np.zeros(len(left), bool)
    joins[:-1] = left[:-1] & ~left[1:] & (x.doc[1:] == x.doc[:-1])
    second = np.zeros(len(left), bool)
    second[1:] = joins[:-1]
    at = np.flatnonzero(~second)
    pair = joins[at]
    last = at + pair
    before, after = _beside(x)
    lone_left, lone_right = left[at] & ~pair, ~left[at] & ~pair
    name = np.where(pair, _pair_name(x.name[at], x.name[last], level), x.name[at])
    low = np.where(lone_right, before[at], x.low[at])
    high = np.where(lone_left, after[at], x.high[last])
    return Level(name, x.start[at], x.doc[at], low, high)


def levels(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """Level 0 (words) and the outcome of each round."""
    place = np.arange(len(names), dtype=np.int64)
    out = [Level(names, place, doc, place, place + 1)]
    for k in range(rounds):
        out.append(_pairs(_runs(out[-1]) if k == 0 else out[-1], k + 1))
    return out


def _least(priority: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range begin < end: the first index of the least priority (sparse table)."""
    width = int((end - begin).max())
    table = [np.arange(len(priority))]
    step = 1
    while 2 * step <= width:
        a = table[-1]
        b = np.minimum(np.arange(len(a)) + step, len(a) - 1)
        table.append(np.where(priority[a[b]] < priority[a], a[b], a))
        step *= 2
    table = np.stack(table)
    k = np.frexp((end - begin).astype(np.float64))[1] - 1
    a, b = table[k, begin], table[k, end - (1 << k)]
    return np.where(priority[b] < priority[a], b, a)


def blocks(words: Words, window: int, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Blocks of a chunk: text row, first window, number of windows, key and content."""
    first = words.first
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    begins = np.arange(len(words)) + window <= first[1:][doc] if len(words) else np.zeros(0, bool)
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {"row": none, "lo": none, "n": none, "key": none, "block": none}
    h1, h2 = words.hashes(1), words.hashes(2)
    r1, r2 = _Ranges(h1, _R1), _Ranges(h2, _R2)
    anchor = np.full(len(starts), -1, np.int64)
    key = np.zeros(len(starts), np.uint64)
    todo = np.arange(len(starts))
    ladder = levels(h1, doc, rounds)
    for k in range(rounds, -1, -1):
        x = ladder[k]
        fit = (x.low >= 0) & (x.high < _FAR)
        low, high = x.low[fit], x.high[fit]
        if not len(low) or not len(todo):
            continue
        context = r1(low, high) + _u(k)
        priority = mix64(context)
        s = starts[todo]
        a, b = np.searchsorted(low, s, "left"), np.searchsorted(high, s + window, "right")
        got = a < b
        chosen = _least(priority, a[got], b[got]) if got.any() else a[got]
        anchor[todo[got]] = np.flatnonzero(fit)[chosen] * (rounds + 1) + k
        key[todo[got]] = context[chosen]
        todo = todo[~got]
    head = np.ones(len(starts), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(head)
    n = np.diff(np.append(at, len(starts)))
    lo = starts[at]
    level = anchor[at] % (rounds + 1)
    offset = np.zeros(len(at), np.int64)
    for k in range(rounds + 1):
        offset[level == k] = ladder[k].start[anchor[at[level == k]] // (rounds + 1)]
    content = mix64(r2(lo, lo + n + window - 1) + (offset - lo).astype(np.uint64) * _u(_C1))
    row = doc[lo]
    return {"row": row, "lo": lo - first[row], "n": n, "key": key[at].view(np.int64), "block": content.view(np.int64)}


def window_blocks(docs: DataFrame, window: int) -> DataFrame:
    """(key, block, doc_id, lo, n): the blocks of every whole text."""

    def find(batches):
        for batch in batches:
            for part in chunks(batch, "text", 2 << 20):
                ids = part.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
                b = blocks(Words(part.column(1)), window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["key"]), pa.array(b["block"]), pa.array(ids[b["row"]]), pa.array(b["lo"].astype(np.int32)), pa.array(b["n"].astype(np.int32))],
                    ["key", "block", "doc_id", "lo", "n"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        find, "key long, block long, doc_id long, lo int, n int"
    )


def _window_hashes(docs: DataFrame, window: int) -> DataFrame:
    """docs: doc_id, text, spans (lo, n).  One row for each listed window: h1, h2, doc_id, start."""

    def hashes(batches):
        for batch in batches:
            for part in chunks(batch, "text", 2 << 20):
                words = Words(part.column(1))
                if not len(words):
                    continue
                r1, r2 = _Ranges(words.hashes(1), _R2), _Ranges(words.hashes(2), _R1)
                row, lo, n = _flat_spans(part.column(2))
                base, size = words.first[:-1][row], np.diff(words.first)[row]
                n = np.minimum(n, np.maximum(size - window + 1 - lo, 0))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                at = np.repeat(base + lo, n) + _within(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r1(at, at + window).view(np.int64)), pa.array(r2(at, at + window).view(np.int64)), pa.array(np.repeat(ids[row], n)), pa.array((at - np.repeat(base, n)).astype(np.int32))],
                    ["h1", "h2", "doc_id", "lo"],
                )

    return docs.mapInArrow(hashes, "h1 long, h2 long, doc_id long, lo int")


def _within(n: np.ndarray) -> np.ndarray:
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _flat_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, n) of a list<struct<lo, n>> column; a null list is empty."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    lo, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    return np.repeat(np.arange(len(size)), size), lo, n


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, lo, n): windows that also start earlier, as runs of n window starts."""
    t = store.cut(window_blocks(docs, window), "blocks")
    first = F.min(F.struct("doc_id", "lo")).alias("f")
    keys = (
        t.groupBy("key")
        .agg(F.count("*").alias("c"), F.min("block").alias("b0"), F.max("block").alias("b1"), first)
        .where("c > 1")
        .drop("c")
    )
    # written first: a join of two plain exchanges is one whose hot keys Spark can split
    keys = store.cut(keys, "keys")
    hit = store.cut(t.join(keys, "key"), "repeats")
    store.drop(docs.sparkSession, t)
    store.drop(docs.sparkSession, keys)
    later = ~((F.col("doc_id") == F.col("f.doc_id")) & (F.col("lo") == F.col("f.lo")))
    plain = hit.where("b0 = b1").where(later).select("doc_id", "lo", "n")
    mixed = hit.where("b0 <> b1").select("key", "block", "doc_id", "lo", "n")
    heads = store.cut(mixed.groupBy("key", "block").agg(F.min(F.struct("doc_id", "lo", "n")).alias("f")), "heads")
    copies = mixed.join(heads, ["key", "block"]).where(later).select("doc_id", "lo", "n")
    asked = heads.select("f.*").groupBy("doc_id").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.col("text").cast("string"))
    windows = store.cut(_window_hashes(texts.join(asked, "doc_id"), window), "windows")
    seen = windows.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "lo")).alias("f")).where("c > 1").drop("c")
    seen = store.cut(seen, "seen")
    single = windows.join(seen, ["h1", "h2"]).where(later).select("doc_id", "lo", F.lit(1).alias("n"))
    return store.cut(plain.unionByName(copies).unionByName(single), "spans")


def _remove(batches, window: int, with_text: bool):
    for batch in batches:
        for part in chunks(batch, "text", 2 << 20):
            words = Words(part.column(1))
            row, lo, n = _flat_spans(part.column(2))
            size = np.diff(words.first)
            n = np.minimum(n, np.maximum(size[row] - window + 1 - lo, 0))
            base = words.first[:-1][row] + lo
            edge = np.zeros(len(words) + 1, np.int64)
            ok = n > 0
            np.add.at(edge, base[ok], 1)
            np.add.at(edge, (base + n + window - 1)[ok], -1)
            gone = np.cumsum(edge[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[words.first[1:]] - total[words.first[:-1]]
            data = words.data.tobytes()
            ends, starts = words.ends, words.starts
            digests, texts = [], []
            for t in range(len(size)):
                a, b = words.first[t], words.first[t + 1]
                if removed[t]:
                    keep = np.flatnonzero(~gone[a:b]) + a
                    kept = b" ".join([data[i:j] for i, j in zip(starts[keep].tolist(), ends[keep].tolist())])
                else:
                    kept = b" ".join(data[words.offsets[t] : words.offsets[t + 1]].split())
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            cols = [part.column(0), pa.array(size.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names)


def remove_repeats(docs: DataFrame, window: int = 20, with_text: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): counts, digest and optionally the kept text.

    A word goes if a window of ``window`` words over it has the same word sequence as a
    window that starts earlier: in a smaller doc_id, or before it in the same text.
    Words are runs outside 0x20 and 0x09-0x0D and are compared byte for byte.

    Null or blank texts have no words (0, 0, the digest of nothing).  A null doc_id
    counts as the smallest id and stays null.  doc_id identifies a text: repeated rows
    of one doc_id are the same document and get the same result, none marks the other.
    Texts shorter than a window keep all words.  Other columns are ignored; an empty
    table gives no rows.
    """
    store.arrow_limits(docs.sparkSession)
    spans = repeated_spans(docs, window)
    spans = spans.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    spans = spans.withColumnRenamed("doc_id", "span_id")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = base.join(spans, F.coalesce("doc_id", F.lit(_NULL_ID)) == F.col("span_id"), "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(lambda it: _remove(it, window, with_text), schema)
