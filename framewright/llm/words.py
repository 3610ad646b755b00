"""Vectorised whitespace words: split, count and hash whole batches with numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, inside one text.  All
functions take concatenated UTF-8 texts, so no Python object is made for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Lower case, with every ASCII byte that is no letter or digit as a blank
PLAIN = LOWER.copy()
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20

_powers: dict[int, np.ndarray] = {}
_bytes: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit words."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream64(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit words that depend on seed and position alone."""
    with np.errstate(over="ignore"):
        step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix64(step + mix64(np.array([seed + 1], np.uint64)))


def _position_keys(seed: int, n: int) -> np.ndarray:
    have = _powers.get(seed)
    if have is None or len(have) < n:
        _powers[seed] = have = stream64(seed * 2 + 1, max(4096, n * 2)) | np.uint64(1)
    return have


def _byte_keys(seed: int) -> np.ndarray:
    if seed not in _bytes:
        keys = stream64(seed * 2 + 2, 256)
        keys[_SPACE] = 0
        _bytes[seed] = keys
    return _bytes[seed]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    data = data[offsets[0] : offsets[-1]] if len(offsets) else data[:0]
    return data, offsets - (offsets[0] if len(offsets) else 0)


def chunks(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Slices of the batch with about ``most`` bytes of text, at least one row each."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.frombuffer(_lengths(col), np.int64)
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _lengths(col: pa.Array) -> bytes:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()).to_numpy(zero_copy_only=False).tobytes()


class Words:
    """Words of a chunk of texts: byte starts and ends, and the first word of each text."""

    def __init__(self, column: pa.Array, table: np.ndarray | None = None):
        """``table`` maps each byte first; what it maps to a blank separates words."""
        self.data, self.offsets = text_buffer(column)
        if table is not None:
            self.data = table[self.data]
        data, n = self.data, len(self.data)
        word = ~_SPACE[data]
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        inner = self.offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        before[inner] = False
        after[inner - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        #: words of text t are first[t] .. first[t + 1]
        self.first = np.searchsorted(self.starts, self.offsets)
        self._position = None

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int) -> np.ndarray:
        """64-bit hash of each word: a multilinear sum over its bytes, then mixed."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        first = int(self.starts[0])
        data = self.data[first:]
        if self._position is None:
            flags = np.zeros(len(data), np.int32)
            flags[self.starts - first] = 1
            owner = np.cumsum(flags, dtype=np.int32) - 1
            self._position = np.arange(len(data), dtype=np.int32) - (self.starts - first).astype(np.int32)[owner]
        keys = _position_keys(seed, int(self._position.max()) + 1)
        with np.errstate(over="ignore"):
            value = _byte_keys(seed)[data] * keys[self._position]
            total = np.add.reduceat(value, self.starts - first)
            return mix64(total + (self.ends - self.starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
