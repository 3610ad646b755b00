"""Text quality by tokeniser fertility.

A public SentencePiece vocabulary encodes each word of a text (each distinct word of a
chunk once).  Three figures say how well the text fits what the vocabulary was made for:
characters per token, the share of byte-fallback tokens and the entropy of the text's
tokens in bits.  Each script has a band for every figure; a text outside one is rejected.
Base figures (words, symbols, repeated lines and windows) are counted beside them.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .words import chunks, mix64

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MOST_REPEATED = 20  # percent of the words in repeated windows
FEWEST_WORDS = 10
MARKED = 0.08  # of the letters
CHUNK = 2 << 20  # bytes of text measured at once; token arrays are some thirty times as large

#: script -> (characters per token: least, most; byte-fallback share: most; entropy in bits: least)
#: The limits stand between prose and characters drawn at random: those come to 1.51 to 1.57
#: characters a token in Latin letters, 1.06 to 1.14 in Cyrillic ones, and to 91 to 93 % bytes
#: in Han and Hangul.  Greek and right-to-left prose can't be told from noise by this vocabulary.
#: The entropy floor falls with the number of tokens: a short text cannot reach it.
BANDS = {
    "latin": (1.58, 6.0, 0.10, 3.2),
    "vietnamese": (0.90, 6.0, 0.10, 3.2),
    "cyrillic": (1.50, 6.0, 0.10, 3.2),
    "greek": (0.60, 6.0, 0.60, 3.2),
    "semitic": (0.60, 6.0, 0.60, 3.2),
    "indic": (0.40, 6.0, 0.95, 3.0),
    "cjk": (0.45, 6.0, 0.75, 3.2),
    "hangul": (0.42, 6.0, 0.75, 3.2),
    "other": (0.25, 8.0, 0.98, 3.0),
}
# First code point of each run of letters of one script
_RUNS = [
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"),
    (0x0590, "semitic"), (0x0750, "other"), (0x0900, "indic"), (0x0E00, "other"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "vietnamese"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "cjk"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "cjk"), (0xFB00, "other"), (0x20000, "cjk"), (0x30000, "other"),
]
SCRIPTS = list(BANDS)
_STARTS = np.array([a for a, _ in _RUNS])
_KIND = np.array([SCRIPTS.index(s) for _, s in _RUNS])


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def byte_pieces(path: str) -> np.ndarray:
    sp = processor(path)
    return np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def repeated_words(order: np.ndarray, first: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text in windows that the text holds twice or more; order: word numbers."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    whole = np.flatnonzero(np.arange(len(order)) + window <= first[1:][doc]) if len(order) else np.zeros(0, np.int64)
    name = mix64(doc[whole].astype(np.uint64) + np.uint64(1 << 40))
    word = mix64(order.astype(np.uint64) + np.uint64(1))
    for k in range(window):
        name = mix64(name * np.uint64(0x9E3779B97F4A7C15) + word[whole + k])
    _, back, count = np.unique(name, return_inverse=True, return_counts=True)
    at = whole[count[back] > 1]
    edge = np.zeros(len(order) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return _sums(np.cumsum(edge[:-1]) > 0, first)


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    return len(lines) - len(set(lines))


def measure(texts: list[str], path: str) -> dict[str, np.ndarray]:
    """All figures of each text."""
    raws = [t.encode() for t in texts]
    pieces = [r.split() for r in raws]
    words = list(chain.from_iterable(pieces))
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    distinct = list(set(words))
    number = dict(zip(distinct, range(len(distinct))))
    order = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    decoded = [w.decode() for w in distinct]
    length = np.fromiter(map(len, decoded), np.int64, len(decoded))
    ids = processor(path).encode(decoded, num_threads=1) if decoded else []
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))
    start = np.cumsum(size) - size
    is_byte = byte_pieces(path)
    bytes_of = np.add.reduceat(np.append(is_byte[flat], 0), start)[: len(size)] * (size > 0) if len(size) else size
    n = np.diff(first)
    tokens = _sums(size[order], first)
    # tokens of each text with their counts, then the entropy from them
    k = size[order]
    total = np.cumsum(k)
    token = flat[np.repeat(start[order] - (total - k), k) + np.arange(int(k.sum()))]
    key = np.sort(np.repeat(np.arange(len(n)), tokens) * len(is_byte) + token)
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(key))).astype(np.float64)
    owner = key[head] // len(is_byte)
    plogp = np.bincount(owner, weights=count * np.log2(np.maximum(count, 1)), minlength=len(n))
    entropy = np.where(tokens > 0, np.log2(np.maximum(tokens, 1)) - plogp / np.maximum(tokens, 1), 0.0)
    chars = _sums(length[order], first)
    return {
        "n_words": n,
        "word_chars": chars,
        "n_symbols": np.array([sum(map(r.count, map(bytes, ([b] for b in SYMBOLS)))) for r in raws], np.int64),
        "n_dup_lines": np.array([duplicate_lines(r) for r in raws], np.int64),
        "n_repeat_words": repeated_words(order, first),
        "n_tokens": tokens,
        "chars_per_token": chars / np.maximum(tokens, 1),
        "byte_share": _sums(bytes_of[order], first) / np.maximum(tokens, 1),
        "token_entropy": np.maximum(entropy, 0.0),
        "script": _scripts(decoded, length, order, first),
    }


def _scripts(words: list[str], length: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The script with most code points in each text's words; digits and marks count for none.

    Vietnamese is Latin text of which MARKED or more of the letters carry its double marks.
    """
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    kind = _KIND[np.searchsorted(_STARTS, code, "right") - 1]
    kind = np.where(code < 0x41, len(SCRIPTS), kind)
    owner = np.repeat(np.arange(len(words)), length)
    table = np.bincount(owner * (len(SCRIPTS) + 1) + kind, minlength=len(words) * (len(SCRIPTS) + 1)).reshape(-1, len(SCRIPTS) + 1)
    sums = np.stack([_sums(table[order, k], first) for k in range(len(SCRIPTS))], axis=1)
    latin, marked = SCRIPTS.index("latin"), SCRIPTS.index("vietnamese")
    own = sums[:, marked].copy()
    sums[:, latin] += own
    sums[:, marked] = 0
    script = np.where(sums.max(axis=1) > 0, sums.argmax(axis=1), SCRIPTS.index("other"))
    return np.where((script == latin) & (own >= MARKED * sums[:, latin]), marked, script)


def verdicts(m: dict[str, np.ndarray], bands: dict = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of each text."""
    base = (m["n_words"] < FEWEST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    low, high, most, least = np.array([bands[s] for s in SCRIPTS])[m["script"]].T
    floor = np.minimum(least, 0.75 * np.log2(np.maximum(m["n_tokens"], 1)))
    fits = (m["chars_per_token"] >= low) & (m["chars_per_token"] <= high) & (m["byte_share"] <= most) & (m["token_entropy"] >= floor)
    return base, ~base & fits


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality(docs: DataFrame, vocabulary: str, bands: dict | None = None) -> DataFrame:
    """One row of figures and verdicts for each row of docs (doc_id, text).

    Words are runs outside 0x20 and 0x09-0x0D.  A null text has no words; such texts and
    empty ones fail the base rule.  A null doc_id stays null, repeated rows stay repeated.
    ``bands`` (script -> band) overrides BANDS.  Other columns are ignored; an empty table
    gives no rows.
    """
    store.arrow_limits(docs.sparkSession)
    bands = BANDS | (bands or {})

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                m = measure(part.column(1).fill_null("").to_pylist(), vocabulary)
                base, kept = verdicts(m, bands)
                names = np.array(SCRIPTS, object)[m["script"]]
                cols = [part.column(0)] + [pa.array(m[c].astype(np.int64)) for c in _COUNTS] + [pa.array(base), pa.array(kept)]
                cols += [pa.array(m["n_tokens"].astype(np.int64))] + [pa.array(m[c]) for c in ("chars_per_token", "byte_share", "token_entropy")] + [pa.array(names, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *_COUNTS, "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy", "script"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS)
    schema += ", base_failed boolean, kept boolean, n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(store.trimmed(run), schema)


def keep_good(docs: DataFrame, vocabulary: str, bands: dict | None = None) -> DataFrame:
    """The rows of docs that pass, with all their columns; one pass, no join."""
    store.arrow_limits(docs.sparkSession)
    bands = BANDS | (bands or {})

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                texts = part.column(part.schema.get_field_index("text")).fill_null("").to_pylist()
                yield part.filter(pa.array(verdicts(measure(texts, vocabulary), bands)[1]))

    return docs.mapInArrow(store.trimmed(run), docs.schema)
