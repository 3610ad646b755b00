"""Benchmark passages in documents, by the q-gram lemma.

Benchmark items are cut into overlapping probes.  A probe of m bytes with at most e edits
shares at least m + 1 - q * (e + 1) q-grams with its place in a text, all on e + 1
neighbouring diagonals.  Shared q-grams are counted in bands of 2e + 2 diagonals that
overlap by half, so these diagonals always lie in one band; bands below the bound are
out, the others are verified by a banded alignment.  q is 8, so that a q-gram is one
64-bit word and matches are exact.

Texts are lower-cased; ASCII marks and white space become single blanks.  Q-grams, edits and
lengths are counted in UTF-8 bytes.  Items of fewer than q bytes hold no q-gram: they are
looked for whole, between blanks, by one automaton.

The benchmark is dealt to blocks of bounded size, written to the shared folder.  Workers read
them from there, one after another for each stretch of texts, so that neither the driver nor
a worker ever holds more than one block, and a text's row is made once however many there are.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .words import PLAIN, chunks

Q = 8
PROBE = 120  # bytes of a probe; items up to 1.5 times that are one probe
EDITS = 0.06  # edits a byte that a passage may have
BLOCK_BYTES = 4 << 20  # benchmark text of a block; its probes take some fifty times as much memory
STRETCH = 64 << 20  # text held against one block after another where there are several
_BITS = 20
_SIZES = [24, 48, 72, 96, 120, 144, 10**9]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of normalised texts; none ends with a blank, one may begin with one."""
    raw = [t.lower().encode() + b" " for t in texts]
    data = PLAIN[np.frombuffer(b"".join(raw), np.uint8)]
    if not len(data):
        return data, np.zeros(len(texts) + 1, np.int64)
    end = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    keep = data != 0x20
    keep[:-1] |= keep[1:]  # of a run of blanks the last stays
    keep[end - 1] = False
    size = np.add.reduceat(keep, np.concatenate([[0], end[:-1]]), dtype=np.int64)
    return data[keep], np.concatenate([[0], np.cumsum(size)])


def grams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one word."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    two = data[:-1].astype(np.uint64) | data[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    return four[:-4] | four[4:] << np.uint64(32)


def budget(m: int, share: float = EDITS) -> int:
    """Edits of a probe: the share, or fewer where the lemma's bound would not be positive."""
    return max(0, min(int(m * share), m // Q - 1))


def _strip(text: str) -> str:
    """Without marks and blanks at the ends, so that no probe begins with a blank."""
    data, _ = normalise([text])
    return data.tobytes().decode().strip(" ")


class Probes:
    """Probes of a block of items, and the places of each of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], share: float = EDITS):
        self.item, self.text, self.edits = [], [], []
        short: dict[str, list[int]] = {}
        data, offsets = normalise([_strip(t or "") for _, t in items])
        for (item, _), a, b in zip(items, offsets[:-1].tolist(), offsets[1:].tolist()):
            m = b - a
            if m < Q:
                if m:
                    short.setdefault(data[a:b].tobytes().decode("latin-1"), []).append(item)
                continue
            starts = [0] if m <= PROBE * 3 // 2 else sorted({*range(0, m - PROBE, PROBE // 2), m - PROBE})
            for s in starts:
                text = data[a + s : a + (m if len(starts) == 1 else s + PROBE)]
                self.item.append(item)
                self.text.append(text)
                self.edits.append(budget(len(text), share))
        self.short = _automaton(short)
        self.item, self.edits = np.array(self.item, np.int64), np.array(self.edits, np.int64)
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.letters = np.zeros((len(self.text), int(self.size.max(initial=0))), np.uint8)
        for k, t in enumerate(self.text):
            self.letters[k, : len(t)] = t
        self.bound = self.size + 1 - Q * (self.edits + 1)
        gram = [grams(t) for t in self.text]
        every = np.concatenate(gram) if gram else np.zeros(0, np.uint64)
        probe = np.repeat(np.arange(len(gram)), [len(g) for g in gram])
        place = np.concatenate([np.arange(len(g)) for g in gram]) if gram else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.probe, self.place = probe[order], place[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        #: probes of like size: which q-grams they have, a stretch of text that takes their
        #: passages in, and the fewest hits of these q-grams that such a passage has
        self.classes = []
        kind = np.searchsorted(_SIZES, self.size)
        for c in np.unique(kind).tolist():
            own = kind == c
            table = np.zeros(1 << _BITS, bool)
            table[_slot(every[own[probe]])] = True
            self.classes.append((table, int((self.size + self.edits)[own].max()), int(self.bound[own].min())))

    def whole(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) for each short item that stands between blanks or ends in a text."""
        if self.short is None:
            return []
        out = []
        for t in range(len(offsets) - 1):
            text = data[offsets[t] : offsets[t + 1]].tobytes().decode("latin-1")
            out += [(t, i) for _, found in self.short.iter(f" {text} ") for i in found]
        return out

    def _dense(self, slot: np.ndarray) -> np.ndarray:
        """Places of q-grams that lie in a stretch with enough q-grams of some class."""
        good = np.zeros(len(slot), bool)
        for table, stretch, bound in self.classes:
            hit = table[slot]
            total = np.zeros(len(hit) + 1, np.int32)
            np.cumsum(hit, out=total[1:])
            width = min(stretch, len(hit))
            start = np.flatnonzero(total[width:] - total[: len(total) - width] >= bound)
            if len(start):
                edge = np.zeros(len(hit) + 1, np.int32)
                edge[start] += 1
                edge[start + width] -= 1
                good |= hit & (np.cumsum(edge[:-1]) > 0)
        return np.flatnonzero(good)

    def found(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(text, probe) pairs, by rows, for which a passage within the edit budget exists."""
        none = np.zeros((0, 2), np.int64)
        if not len(self.text):
            return none
        g = grams(data)
        at = self._dense(_slot(g))
        if not len(at):
            return none
        k = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        hit = self.grams[k] == g[at]
        at, k = at[hit], k[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[1:][doc]
        at, k, doc = at[inside], k[inside], doc[inside]
        if not len(at):
            return none
        n = self.count[k]
        total = np.cumsum(n)
        entry = np.repeat(self.first[k] - (total - n), n) + np.arange(total[-1])
        probe = self.probe[entry]
        diagonal = np.repeat(at, n) - self.place[entry] + (1 << 20)  # over the whole chunk; the text is part of the key
        doc = np.repeat(doc, n)
        # too few shared q-grams of a probe in the whole text: out before bands are made
        pair = doc * len(self.text) + probe
        names, back, count = np.unique(pair, return_inverse=True, return_counts=True)
        enough = (count >= self.bound[names % len(self.text)])[back]
        probe, diagonal, doc = probe[enough], diagonal[enough], doc[enough]
        if not len(probe):
            return none
        half = self.edits[probe] + 1
        band = diagonal // half
        key = np.stack([np.concatenate([doc, doc]), np.concatenate([probe, probe]), np.concatenate([band, band - 1])], axis=1)
        flat = (key[:, 0] * len(self.text) + key[:, 1]) * (1 << 32) + key[:, 2]
        names, count = np.unique(flat, return_counts=True)
        pair, band = names >> 32, names & ((1 << 32) - 1)
        probe = pair % len(self.text)
        pass_ = count >= self.bound[probe]
        pair, band, probe = pair[pass_], band[pass_], probe[pass_]
        doc = pair // len(self.text)
        ok = np.zeros(len(pair), bool)
        for i in range(0, len(pair), 2048):
            d, p = doc[i : i + 2048], probe[i : i + 2048]
            low = band[i : i + 2048] * (self.edits[p] + 1) - (1 << 20)
            ok[i : i + 2048] = aligned(self.letters[p], self.size[p], self.edits[p], data, offsets[d], offsets[d + 1], low)
        return np.unique(np.stack([doc[ok], probe[ok]], axis=1), axis=0) if ok.any() else none


def _automaton(short: dict[str, list[int]]):
    if not short:
        return None
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for text, found in short.items():
        automaton.add_word(f" {text} ", found)
    automaton.make_automaton()
    return automaton


def _slot(g: np.ndarray) -> np.ndarray:
    return (g * _MIX >> np.uint64(64 - _BITS)).astype(np.int64)


def aligned(letters: np.ndarray, size: np.ndarray, edits: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each candidate: does its probe match within ``edits`` on diagonals low .. low + 2 * edits + 1?

    One banded alignment for all candidates at once, free at both ends of the text.  The
    band is widened by ``edits`` on both sides, as far as a path can leave its diagonals
    (more for candidates with a smaller budget than others).
    """
    if not len(size):
        return np.zeros(0, bool)
    width = 4 * int(edits.max()) + 2
    column = np.arange(width, dtype=np.int32)
    base = begin - 1
    start = ((low - edits - base)[:, None] + column).astype(np.int32)  # text place from base, of the cell's diagonal
    stop = (end - base)[:, None].astype(np.int32)  # places 1 .. stop - 1 are the text
    far = np.int32(1 << 20)
    rows = int(size.max())
    cost = np.where((start >= 1) & (start <= stop), np.int32(0), far)
    out = np.zeros(len(size), bool)
    closes = {m: np.flatnonzero(size == m) for m in np.unique(size).tolist()}
    base = base[:, None].astype(np.int32)
    for i in range(rows):
        valid = (start >= 1) & (start < stop)
        here = np.where(valid, cost + (data[np.where(valid, start + base, 0)] != letters[:, i : i + 1]), far)
        here[:, :-1] = np.minimum(here[:, :-1], cost[:, 1:] + 1)  # a probe byte left out
        start += 1
        reach = (start >= 1) & (start <= stop)
        here = np.where(reach, here, far)
        here = np.minimum.accumulate(here - column, axis=1) + column  # text bytes put in
        cost = np.where(reach, here, far)
        if i + 1 in closes:
            at = closes[i + 1]
            out[at] = cost[at].min(axis=1) <= edits[at]
    return out


def _blocks(benchmark: DataFrame) -> tuple[str, int]:
    """Writes the items as blocks of about BLOCK_BYTES of text; (folder, number of blocks)."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES) or 1
    folder = store.new_path(spark, "benchmark")
    items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).repartition(n, "block").write.partitionBy("block").parquet(folder)
    return folder, n


@lru_cache(maxsize=1)
def _probes(folder: str, block: int, edits: float) -> Probes:
    """The probes of a written block, built by the worker that asks."""
    table = store.read_part(folder, f"block={block}", ["item_id", "text"])
    items = zip(table.column("item_id").to_pylist(), table.column("text").to_pylist())
    return Probes(sorted(items), edits)


def _found(batches, folder: str, blocks: int, edits: float):
    """(rows, items found in each of them) for slices of the batches, in order."""
    held, size = [], 0

    def held_out():
        found: list[list[set[int]]] = [[set() for _ in range(part.num_rows)] for part in held]
        for block in range(blocks):
            probes = _probes(folder, block, edits)
            for part, sets in zip(held, found):
                for own, more in zip(sets, _items(part.column(part.schema.get_field_index("text")), probes)):
                    own.update(more)
        yield from zip(held, ([sorted(x) for x in sets] for sets in found))

    for batch in batches:
        for part in chunks(batch, "text"):
            held.append(part)
            size += part.nbytes
            if blocks == 1 or size > STRETCH:
                yield from held_out()
                held, size = [], 0
    yield from held_out()


def matches(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, contaminated, n_items, item_ids.

    item_ids lists the benchmark items (ascending) of which a probe occurs in the text with
    at most ``edits`` edits a byte; items of fewer than 8 normalised bytes must occur whole,
    as words.  Null and empty texts match nothing, nor do items without a letter or digit;
    null items are ignored, repeated items count once.  Null doc_ids stay null, repeated
    rows stay repeated, whatever the number of blocks.  Other columns are ignored; empty
    docs give no rows.
    """
    store.arrow_limits(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder, blocks = _blocks(benchmark)

    def run(batches):
        for part, items in _found(batches, folder, blocks, edits):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "item_ids"])

    found = base.mapInArrow(store.trimmed(run), "doc_id long, item_ids array<long>")
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")


def _items(column: pa.Array, probes: Probes) -> list[list[int]]:
    data, offsets = normalise(column.fill_null("").to_pylist())
    items: list[set[int]] = [set() for _ in range(len(column))]
    for doc, probe in probes.found(data, offsets).tolist():
        items[doc].add(int(probes.item[probe]))
    for doc, item in probes.whole(data, offsets):
        items[doc].add(item)
    return [sorted(x) for x in items]


def keep_clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows of docs without benchmark passages, with all their columns; no join.

    Rows with a null or empty text stay, and so do repeated rows and null doc_ids.
    """
    store.arrow_limits(docs.sparkSession)
    folder, blocks = _blocks(benchmark)

    def run(batches):
        for part, items in _found(batches, folder, blocks, edits):
            yield part.filter(pa.array([not x for x in items], pa.bool_()))

    return docs.mapInArrow(store.trimmed(run), docs.schema)
