"""SentencePiece encoding with the n best segmentations, and decoding.

The lattice has an edge for every piece of the vocabulary that matches, and one for a
code point that no piece covers (its UTF-8 bytes as byte pieces).  Blanks and line feeds
cut a text into units: a unit is a run of blanks with what follows it, or a line feed; no
piece spans a cut.  The vocabulary file holds merge ranks, no probabilities: the score of a
piece of rank r is -log(r + 3), or with ``scores="model"`` the file's own figure, -r; a byte
costs more than any piece.  Best segmentations are those of these scores, so they need not
be what the library's merges give; decoding agrees with the library's.

A forward pass gives the best score of every prefix of every distinct unit, for many
units of one length at once, along with the runner-up.  These scores are the exact
heuristic of a backward A* search: partial paths grow from the unit's end, and the search
takes the partial path whose own score plus the forward score of what is left is largest,
so paths leave it best first.  As that sum is the score of a whole path of its own, no more
than n partial paths are ever kept, and they share their tails.  A text's n best segmentations differ from the best one only
in units with the n - 1 smallest gaps to their runner-up, so only those units are searched.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .words import chunks

SPACE = "▁"
BEST = 4
LONG = 40  # code points from which a unit is scored alone
_UNIT = re.compile(r"\n| *[^ \n]+| +")
_SLOTS = 1 << 20


class Vocabulary:
    def __init__(self, path: str, scores: str = "rank"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text: list[bytes] = [b""] * n
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = np.zeros(256, np.int64)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                surface = piece.replace(SPACE, " ")
                self.text[i] = surface.encode()
                if " " not in surface.lstrip(" ") and "\n" not in surface:  # others span a cut
                    self.id[surface] = i
                    self.score[surface] = float(sp.get_score(i)) if scores == "model" else -float(np.log(-sp.get_score(i) + 3))
        self.byte_score = min(self.score.values()) - 4.0
        self.longest = max(map(len, self.id))
        pieces = list(self.id)
        self.ids = np.array([self.id[p] for p in pieces], np.int64)
        self.scores = np.array([self.score[p] for p in pieces])
        hashes = np.array([_hash_text(p) for p in pieces], np.uint64)
        self.multiplier, self.slot = self._table(hashes)
        self.hash = np.append(hashes, np.uint64(0))

    def _table(self, hashes: np.ndarray) -> tuple[np.uint64, np.ndarray]:
        """A multiplier under which few pieces share a slot; pieces that do chain to the next free slot."""
        multiplier = np.uint64(0x9E3779B97F4A7C15)
        slot = np.full(_SLOTS + 64, len(hashes), np.int32)
        for k, at in enumerate((hashes * multiplier >> np.uint64(44)).tolist()):
            while slot[at] != len(hashes):
                at += 1
            slot[at] = k
        start = (hashes * multiplier >> np.uint64(44)).astype(np.int64)
        self.probe = 1 + max(int(np.flatnonzero(slot[s : s + 64] == k)[0]) for k, s in enumerate(start.tolist()))
        return multiplier, slot

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece with hash h, or the number of pieces where there is none."""
        at = (h * self.multiplier >> np.uint64(44)).astype(np.int64)
        none = len(self.ids)
        k = self.slot[at]
        found = np.where(self.hash[k] == h, k, none)
        miss = np.flatnonzero((found == none) & (k != none))
        for step in range(1, self.probe):
            if not len(miss):
                break
            k = self.slot[at[miss] + step]
            found[miss] = np.where(self.hash[k] == h[miss], k, none)
            miss = miss[(found[miss] == none) & (k != none)]
        return found


_K = 0x100000001B3 * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF | 1


def _hash_text(text: str) -> int:
    h = 0
    for c in text:
        h = ((h + ord(c) + 1) * _K) & 0xFFFFFFFFFFFFFFFF
    return h


@lru_cache(maxsize=2)
def vocabulary(path: str, scores: str = "rank") -> Vocabulary:
    if scores not in ("rank", "model"):
        raise ValueError("scores are 'rank' or 'model'")
    return Vocabulary(path, scores)


def _utf8(code: np.ndarray) -> np.ndarray:
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


def forward(codes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward pass over units of one length, a row each.

    Returns the best score of each prefix, the last edge of its best path (start, piece
    number; the number of pieces stands for bytes), and the runner-up's score of the whole.
    """
    n, size = codes.shape
    codes = codes.astype(np.uint64)
    best = np.full((n, size + 1), -np.inf)
    second = np.full((n, size + 1), -np.inf)
    came = np.zeros((n, size + 1), np.int32)
    edge = np.full((n, size + 1), len(v.ids), np.int32)
    best[:, 0] = 0
    scores = np.append(v.scores, -np.inf)
    for i in range(size):
        h = np.zeros(n, np.uint64)
        for j in range(i, min(size, i + v.longest)):
            h = (h + codes[:, j] + np.uint64(1)) * np.uint64(_K)
            k = v.find(h)
            score = scores[k]
            if j == i:
                score = np.where(k == len(v.ids), v.byte_score * _utf8(codes[:, i]), score)
            if not np.isfinite(score).any():
                continue
            one, two = best[:, i] + score, second[:, i] + score
            top, low = best[:, j + 1], second[:, j + 1]
            wins = one > top
            second[:, j + 1] = np.where(wins, np.maximum(top, two), np.maximum(low, one))
            best[:, j + 1] = np.where(wins, one, top)
            came[:, j + 1] = np.where(wins, i, came[:, j + 1])
            edge[:, j + 1] = np.where(wins, k, edge[:, j + 1])
    return best, came, edge, second[:, size]


class Units:
    """Best segmentation, score and gap to the runner-up of each of a list of distinct units."""

    def __init__(self, units: list[str], v: Vocabulary):
        self.units, self.v = units, v
        n = len(units)
        self.score, self.gap = np.zeros(n), np.full(n, np.inf)
        length = np.fromiter(map(len, units), np.int64, n)
        order = np.argsort(length, kind="stable")
        code = np.frombuffer("".join([units[i] for i in order.tolist()]).encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(length[order])])
        rows, places, numbers = [], [], []
        begin = 0
        while begin < n:
            size = int(length[order[begin]])
            end = int(np.searchsorted(length[order], size, "right"))
            for a in range(begin, end, 20_000 if size <= LONG else 1):
                b = min(end, a + (20_000 if size <= LONG else 1))
                block = code[at[a] : at[b]].reshape(b - a, size)
                best, came, edge, second = forward(block, v) if size <= LONG else _forward_one(units[order[a]], v)
                who = order[a:b]
                self.score[who], self.gap[who] = best[:, size], best[:, size] - second
                live, pos = np.arange(b - a), np.full(b - a, size)
                if size > LONG:
                    live, ends = live[:0], _ends(came[0], size)
                    start = np.concatenate([[0], ends[:-1]])
                    number = edge[0, ends].astype(np.int64)
                    rows.append(np.full(len(ends), who[0]))
                    places.append(start)
                    numbers.append(np.where(number == len(v.ids), -1 - block[0, start].astype(np.int64), number))
                while len(live):
                    start = came[live, pos]
                    rows.append(who[live])
                    places.append(start.astype(np.int64))
                    number = edge[live, pos].astype(np.int64)
                    numbers.append(np.where(number == len(v.ids), -1 - block[live, start].astype(np.int64), number))
                    go = start > 0
                    live, pos = live[go], start[go]
            begin = end
        empty = [np.zeros(0, np.int64)]
        row, place, number = (np.concatenate(x or empty) for x in (rows, places, numbers))
        sort = np.lexsort((place, row))
        row, number = row[sort], number[sort]
        raw = np.flatnonzero(number < 0)
        size = np.ones(len(number), np.int64)
        size[raw] = _utf8(-1 - number[raw])
        self.flat = np.repeat(np.append(v.ids, 0)[np.maximum(number, 0)], size)
        slot = np.cumsum(size) - size
        for i in raw.tolist():
            for k, b in enumerate(_char(-1 - number[i])):
                self.flat[slot[i] + k] = v.byte[b]
        self.size = np.bincount(row, weights=size, minlength=n).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size


def _char(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass")


def _forward_one(unit: str, v: Vocabulary):
    """:func:`forward` for one long unit, with plain lookups: linear in its length."""
    size = len(unit)
    best, second = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
    came, edge = np.zeros(size + 1, np.int32), np.full(size + 1, len(v.ids), np.int32)
    number = _numbers(v)
    best[0] = 0
    b, s = best.tolist(), second.tolist()
    for i in range(size):
        for j in range(i, min(size, i + v.longest)):
            piece = unit[i : j + 1]
            score = v.score.get(piece)
            if score is None:
                if j > i:
                    continue
                score = v.byte_score * len(_char(ord(piece)))
            one, two = b[i] + score, s[i] + score
            if one > b[j + 1]:
                s[j + 1] = max(b[j + 1], two)
                b[j + 1], came[j + 1], edge[j + 1] = one, i, number.get(piece, len(v.ids))
            else:
                s[j + 1] = max(s[j + 1], one)
    return np.array([b]), came[None, :], edge[None, :], np.array([s[size]])


@lru_cache(maxsize=2)
def _numbers(v: Vocabulary) -> dict[str, int]:
    return {p: k for k, p in enumerate(v.id)}


def _ends(came: np.ndarray, size: int) -> np.ndarray:
    """Ends of the edges of the best path, in order."""
    out, came = [], came.tolist()
    while size:
        out.append(size)
        size = came[size]
    return np.array(out[::-1], np.int64)


def n_best(unit: str, v: Vocabulary, n: int) -> list[tuple[float, list[int]]]:
    """The n best segmentations (score, ids) of a unit, best first, by backward A*.

    Equal scores are ordered by the ids from the end on.  The open paths are kept in the
    order of their tails; a path is (estimate, place, score, (ids, path after it)).
    """
    best = _forward_one(unit, v)[0][0].tolist()
    paths: list[tuple[float, int, float, tuple | None]] = [(best[-1], len(unit), 0.0, None)]
    out = []
    while paths and len(out) < n:
        k = max(range(len(paths)), key=lambda i: (paths[i][0], -i))
        _, at, score, tail = paths.pop(k)
        if at == 0:
            ids = []
            while tail:
                ids += tail[0]
                tail = tail[1]
            out.append((score, ids))
            continue
        more = []
        for i in range(max(0, at - v.longest), at):
            piece = unit[i:at]
            value = v.score.get(piece)
            if value is not None:
                ids = [v.id[piece]]
            elif at - i == 1:
                raw = _char(ord(piece))
                value, ids = v.byte_score * len(raw), [int(v.byte[b]) for b in raw]
            else:
                continue
            more.append((score + value + best[i], i, score + value, (ids, tail)))
        more.sort(key=lambda p: p[3][0][::-1])
        paths[k:k] = more
        if len(paths) > n - len(out):  # each stands for a whole path of its own
            keep = sorted(sorted(range(len(paths)), key=lambda i: (-paths[i][0], i))[: n - len(out)])
            paths = [paths[i] for i in keep]
    return out


def combine(options: list[list[tuple[float, list[int]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best choices, one option for each position: (loss against the best, options taken)."""
    first = (0,) * len(options)
    heap, seen, out = [(0.0, first)], {first}, []
    while heap and len(out) < n:
        loss, taken = heapq.heappop(heap)
        out.append((loss, taken))
        for p, k in enumerate(taken):
            if k + 1 < len(options[p]):
                more = taken[:p] + (k + 1,) + taken[p + 1 :]
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (loss + options[p][k][0] - options[p][k + 1][0], more))
    return out


def split(text: str) -> list[str]:
    """Units of a text, with the blank that is put before it."""
    return _UNIT.findall(" " + text) if text else []


def encode(texts: list[str], path: str, n: int = BEST, scores: str = "rank") -> list[list[tuple[float, np.ndarray]]]:
    """For each text its n best (score, ids), best first; an empty text has the empty one."""
    v = vocabulary(path, scores)
    cut = [split(t) for t in texts]
    flat_units = list(chain.from_iterable(cut))
    distinct = list(dict.fromkeys(flat_units))
    number = dict(zip(distinct, range(len(distinct))))
    order = np.fromiter(map(number.__getitem__, flat_units), np.int64, len(flat_units))
    u = Units(distinct, v)
    out, at = [], 0
    searched: dict[int, list] = {}
    for units in cut:
        own = order[at : at + len(units)]
        at += len(units)
        size = u.size[own]
        total = np.cumsum(size)
        ids = u.flat[np.repeat(u.start[own] - (total - size), size) + np.arange(int(size.sum()))]
        score = float(u.score[own].sum())
        results = [(score, ids)]
        if n > 1 and len(own):
            gap = u.gap[own]
            few = np.argpartition(gap, min(n - 1, len(gap)) - 1)[: n - 1] if len(gap) > n - 1 else np.arange(len(gap))
            edge = gap[few].max()
            few = np.concatenate([np.flatnonzero(gap < edge), np.flatnonzero(gap == edge)])[: n - 1]
            few = np.sort(few[np.isfinite(gap[few])])
            options = []
            for p in few.tolist():
                k = int(own[p])
                if k not in searched:
                    searched[k] = n_best(distinct[k], v, n)
                options.append(searched[k])
            for loss, taken in combine(options, n)[1:]:
                parts, last = [], 0
                for p, option, choice in zip(few.tolist(), options, taken):
                    if choice:
                        begin = int(total[p] - size[p])
                        parts += [ids[last:begin], np.array(option[choice][1], np.int64)]
                        last = int(total[p])
                results.append((score - loss, np.concatenate([*parts, ids[last:]])))
        out.append(results)
    return out


def decode(ids: list[int] | np.ndarray, path: str) -> str:
    """The text of ids: pieces and bytes joined, without the blank put first."""
    v = vocabulary(path)
    raw = b"".join([v.text[i] for i in np.asarray(ids).tolist()])
    return raw.decode("utf-8", "replace").removeprefix(" ")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids).astype("<u4").tobytes())


def segment(docs: DataFrame, path: str, n: int = BEST, with_ids: bool = False, scores: str = "rank") -> DataFrame:
    """One row for each row of docs (doc_id, text).

    n_tokens, ids_crc32 and score of the best segmentation, decodes (its ids give the text
    back), n_found and, for the others in order, alternatives: (loss, n_tokens, ids_crc32).
    ``with_ids`` adds the best ids.  A null text is empty: no tokens, decodes is true.  Null
    doc_ids stay null, repeated rows stay repeated.  Other columns are ignored; an empty
    table gives no rows.
    """
    store.arrow_limits(docs.sparkSession)
    other = pa.list_(pa.struct([("loss", pa.float64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column(1).fill_null("").to_pylist()
                found = encode(texts, path, n, scores)
                best = [x[0][1] for x in found]
                cols = [
                    part.column(0),
                    pa.array([len(b) for b in best], pa.int64()),
                    pa.array([crc(b) for b in best], pa.int64()),
                    pa.array([round(x[0][0], 6) for x in found], pa.float64()),
                    pa.array([decode(b, path) == t for b, t in zip(best, texts)], pa.bool_()),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([[{"loss": round(x[0][0] - s, 6), "n_tokens": len(b), "ids_crc32": crc(b)} for s, b in x[1:]] for x in found], other),
                ]
                names = ["doc_id", "n_tokens", "ids_crc32", "score", "decodes", "n_found", "alternatives"]
                if with_ids:
                    cols.append(pa.array([b.astype(np.int32) for b in best], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_crc32 long, score double, decodes boolean, n_found long, alternatives array<struct<loss: double, n_tokens: long, ids_crc32: long>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(store.trimmed(run), schema + ", ids array<int>" * with_ids)
