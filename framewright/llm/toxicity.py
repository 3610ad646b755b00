"""Toxicity scores from two class-conditional Kneser-Ney models.

The models of order 2, which op3 scores by, are those of :mod:`word_pairs`: exact counts of
pairs of words with exact continuation counts.  What follows is the model of words alone
(order 1), and the curve and the folds that both share.

Each class model is P(word) = max(c - D, 0) / N + reserve * shared(word), where the reserve
is the mass that the discounts min(c, D) leave, so that a model sums to one.  Both models
share their backoff counts: shared(word) goes by the number of different words that it
follows, in both classes together, so an expression that is rare in a class has the same
mass in both.  The number of words before a word is estimated from a bitmap of 64 bits.

A text's figure is the length-normalised comparison of its words' likelihoods: the log of
the mean of P(word | toxic) / P(word | ordinary) over all its words (ratios up to e ** MOST).
A logistic curve over this one figure, rising with it and fitted on at most FIT labelled
rows, gives the score.  Its figures come from models of the other half of the labelled rows
(two folds), so they look as they do on unseen texts.

Words have 64-bit names, and all labelled rows outside the held-out fold are counted.  Words
of which no class has more than D keep no mass of their own: their ratio is that of the
reserves whatever their counts, so leaving them out changes no score.  The others, whose
number grows with the corpus, are written to the shared folder in blocks of bounded size;
workers read them from there, one after another for each stretch of texts.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .words import PLAIN, Words, chunks, mix64

DISCOUNT = 1.5  # counts up to this say nothing about a class and fall back to the shared counts
MOST = 12.0  # largest log ratio of a word
FIT = 20_000  # most labelled rows that the logistic curve is fitted on
THRESHOLD = 0.7
BLOCK_WORDS = 4 << 20  # words of a block; a worker holds one
STRETCH = 64 << 20  # text held against one block after another where there are several
HELD = 1 << 20  # rows of counts that a task adds up before it sends them on
#: Slots 2 * fold + class of the counts; which slots each model takes for ordinary and toxic
MODELS = {"all": ((0, 2), (1, 3)), "first": ((0,), (1,)), "second": ((2,), (3,))}


def _merged(w: np.ndarray, counts: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of one word added up; counts has a row for each slot."""
    order = np.argsort(w, kind="stable")
    w = w[order]
    at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
    if not len(at):
        return w, counts, seen
    return w[at], np.add.reduceat(counts[:, order], at, axis=1), np.bitwise_or.reduceat(seen[order], at)


def _before(words: Words, h: np.ndarray) -> np.ndarray:
    """The bit of the word before each word (of none at a text's start)."""
    before = np.zeros(len(h), np.uint64)
    before[1:] = h[:-1]
    first = words.first[:-1]
    before[first[first < len(h)]] = 0
    return np.uint64(1) << (mix64(before) & np.uint64(63))


def count_words(docs: DataFrame) -> DataFrame:
    """(w, c0, c1, c2, c3, seen) over docs (text, slot 0..3): a word's counts by slot and bitmap."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column(0), PLAIN)
                h = words.hashes(3)
                slot = np.repeat(part.column(1).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(words.first))
                held.append(_merged(h, (slot == np.arange(4)[:, None]).astype(np.int64), _before(words, h)))
                size += len(held[-1][0])
                if size > HELD:
                    held = [_merged(*(np.concatenate(x, axis=-1) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from _rows(*held.pop())
                        size = 0
        if held:
            yield from _rows(*_merged(*(np.concatenate(x, axis=-1) for x in zip(*held))))

    counted = docs.select("text", "slot").mapInArrow(count, "w long, c0 long, c1 long, c2 long, c3 long, seen long")
    return counted.groupBy("w").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(4)), F.bit_or("seen").alias("seen"))


def _rows(w: np.ndarray, counts: np.ndarray, seen: np.ndarray):
    for i in range(0, len(w), 50_000):
        cols = [w[i : i + 50_000].view(np.int64), *counts[:, i : i + 50_000], seen[i : i + 50_000].view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["w", "c0", "c1", "c2", "c3", "seen"])


def _followed() -> Column:
    """Thousandths of the number of different words before a word, from its bitmap."""
    share = F.least(F.bit_count("seen").cast("double"), F.lit(63.5)) / 64
    return F.round(-64_000 * F.log(1 - share)).cast("long")


def class_totals(counted: DataFrame) -> dict:
    """For each model and class (words, discounted mass), and the shared total; a few sums."""
    sums = [F.sum("k").alias("k")]
    for name, sides in MODELS.items():
        for side, slots in enumerate(sides):
            c = sum((F.col(f"c{s}") for s in slots), F.lit(0))
            sums += [F.sum(c).alias(f"{name}{side}n"), F.sum(F.when(c > 1, F.lit(int(2 * DISCOUNT))).otherwise(2 * c)).alias(f"{name}{side}d")]
    row = counted.agg(*sums).first()
    out = {"k": row["k"] or 0}
    for name in MODELS:
        out[name] = [(row[f"{name}{side}n"] or 0, (row[f"{name}{side}d"] or 0) / 2) for side in (0, 1)]
    return out


def log_ratio(counts: np.ndarray, k: np.ndarray, totals: dict, model: str) -> tuple[np.ndarray, float]:
    """log P(word | toxic) - log P(word | ordinary) of words (counts by slot, k), and of all others."""
    shared = k / max(totals["k"] + 1000, 1)
    sign, out, other = -1, np.zeros(len(k)), 0.0
    for slots, (n, d) in zip(MODELS[model], totals[model]):
        c = counts[list(slots)].sum(axis=0)
        reserve = d / n if n else 1.0
        own = np.maximum(c - DISCOUNT, 0) / max(n, 1) + reserve * shared
        out += sign * np.log(own)
        other += sign * math.log(reserve)
        sign = 1
    return np.minimum(out, MOST), min(other, MOST)


class Model:
    """A written model: the folder of its blocks of words, and the totals."""

    def __init__(self, folder: str, blocks: int, totals: dict):
        self.folder, self.blocks, self.totals = folder, blocks, totals

    def figures(self, parts: list[tuple[pa.Array, str]]) -> list[np.ndarray]:
        """For each (texts, model name): the log mean ratio of each text; 0 for texts without a word."""
        words = [Words(texts, PLAIN) for texts, _ in parts]
        names = [w.hashes(3) for w in words]
        values = [np.full(len(h), math.exp(log_ratio(np.zeros((4, 0)), np.zeros(0), self.totals, m)[1])) for h, (_, m) in zip(names, parts)]
        for b in range(self.blocks):
            for h, value, (_, model) in zip(names, values, parts):
                table, ratio = _block(self.folder, b, model, _Totals(self.totals))
                if len(table):
                    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
                    hit = table[at] == h
                    value[hit] = ratio[at[hit]]
        out = []
        for w, value in zip(words, values):
            n = np.diff(w.first)
            total = np.concatenate([[0.0], np.cumsum(value)])
            mean = (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(n, 1)
            out.append(np.where(n > 0, np.log(np.maximum(mean, 1e-12)), 0.0))
        return out


class _Totals(dict):
    """Totals as a key: one model's never change."""

    def __hash__(self):
        return hash(str(sorted(self.items())))


@lru_cache(maxsize=3)
def _block(folder: str, block: int, model: str, totals: _Totals) -> tuple[np.ndarray, np.ndarray]:
    """(sorted word names, likelihood ratios) of a written block."""
    table = store.read_part(folder, f"block={block}", ["w", "c0", "c1", "c2", "c3", "k"])
    w, *counts, k = (table.column(c).to_numpy() for c in ("w", "c0", "c1", "c2", "c3", "k"))
    order = np.argsort(w.view(np.uint64))
    ratio, _ = log_ratio(np.stack(counts).astype(np.float64), k.astype(np.float64), totals, model)
    return w.view(np.uint64)[order], np.exp(ratio[order])


def _stretches(batches, blocks: int):
    """Lists of slices of the batches: one slice each, or as many as STRETCH takes."""
    held, size = [], 0
    for batch in batches:
        for part in chunks(batch, "text"):
            held.append(part)
            size += part.nbytes
            if blocks == 1 or size > STRETCH:
                yield held
                held, size = [], 0
    if held:
        yield held


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the bias) by Newton steps on standardised columns."""
    x = x.astype(np.float64)
    if not len(x) or y.min() == y.max():
        base = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        return np.array([0.0] * x.shape[1] + [math.log(base / (1 - base))])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.full(len(w), ridge * len(x) / 100 + ridge)
    keep[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    inner = w[:-1] / scale
    return np.append(inner, w[-1] - inner @ centre)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id's decimal text, mod 3; fold 1 is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(1)).cast("int")


def word_model(marked: DataFrame) -> Model:
    """The written model of words alone over marked texts (text, slot)."""
    spark = marked.sparkSession
    counted = store.cut(count_words(marked).withColumn("k", _followed()), "words")
    totals = class_totals(counted)
    # the others' ratio is that of the reserves
    kept = counted.where((F.col("c0") + F.col("c2") > DISCOUNT) | (F.col("c1") + F.col("c3") > DISCOUNT)).drop("seen")
    blocks = max(1, -(-kept.count() // BLOCK_WORDS))
    folder = store.new_path(spark, "model")
    kept.withColumn("block", F.pmod("w", F.lit(blocks)).cast("int")).repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    store.drop(spark, counted)
    return Model(folder, blocks, totals)


def train(docs: DataFrame, labels: DataFrame, order: int = 1) -> tuple[Model, np.ndarray]:
    """(model, weights of the logistic curve) from the rows of folds 0 and 2."""
    from .word_pairs import pair_model

    known = (
        labels.where("toxic is not null and doc_id is not null")
        .withColumn("fold", fold(F.col("doc_id")))
        .where("fold <> 1")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max("fold").alias("fold"))
        .select("doc_id", (F.col("fold") + F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("int").alias("slot"))
    )
    texts = docs.select("doc_id", "text").where(fold(F.col("doc_id")) != 1)
    # labels grow with the corpus, so they are never broadcast: one plan at every size
    marked = texts.join(known.hint("merge"), "doc_id")
    if order == 2:
        # a table of the learned texts alone is small; the join's shuffle files go before pairs are counted
        marked = store.cut(marked.select("text", "slot"), "marked")
        store.settle(docs.sparkSession)
        model = pair_model(marked)
        store.drop(docs.sparkSession, marked)
    else:
        model = word_model(marked)
    blocks = model.blocks

    def cross(batches):
        for parts in _stretches(batches, blocks):
            asked = []
            for part in parts:
                slot = part.column(1).to_numpy(zero_copy_only=False)
                asked += [(part.column(0).filter(pa.array(slot // 2 == side)), ("second", "first")[side]) for side in (0, 1)]
            found = iter(model.figures(asked))
            for part in parts:
                slot = part.column(1).to_numpy(zero_copy_only=False)
                x = np.zeros(len(slot))
                for side in (0, 1):
                    x[slot // 2 == side] = next(found)
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array((slot % 2).astype(np.int64)), pa.array(x)], ["doc_id", "y", "x"])

    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT)
    few = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most FIT rows of two numbers
    rows = few.select("text", "slot", "doc_id").mapInArrow(cross, "doc_id long, y long, x double")
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("x").alias("x")).orderBy("doc_id").toArrow()
    y, x = (rows.column(c).to_numpy().astype(np.float64) for c in ("y", "x"))
    weights = fit_logistic(x[:, None], y)
    if weights[0] < 0:  # the figure says nothing: the share alone
        weights = fit_logistic(np.zeros((len(y), 1)), y)
    return model, weights


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, order: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted, log_ratio) for each row of docs (doc_id, text).

    ``order`` 2 scores by the exact Kneser-Ney models over pairs of words (:mod:`word_pairs`),
    1 by words alone.

    Learns from labels (doc_id, toxic) outside the held-out fold alone; a doc_id labelled
    twice counts as toxic if any label says so.  A text without a word (null, empty) has the
    log ratio 0.  A null doc_id is held out.  With no labels, or labels of one class, all
    scores are that class's share.  Repeated rows stay repeated, other columns are ignored;
    empty docs give no rows.
    """
    store.arrow_limits(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, weights = train(base, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")), order)
    slope, bias = weights.tolist()

    def run(batches):
        for parts in _stretches(batches, model.blocks):
            for part, x in zip(parts, model.figures([(p.column(1), "all") for p in parts])):
                value = 1 / (1 + np.exp(-np.clip(x * slope + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array(x)], ["doc_id", "score", "log_ratio"])

    scored = base.mapInArrow(run, "doc_id long, score double, log_ratio double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "log_ratio")
