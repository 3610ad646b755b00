"""Token ids in Simple-8b coded files.

A file holds blocks of up to BLOCK ids.  A block is a run of little-endian 64-bit words;
the top four bits of a word select how many ids share its lower 60 bits:

    selector 0..13: COUNTS ids of WIDTHS bits each;  selector 15: escape, the next
    word is one id as it is (ids of 2^60 and more).

Layout: magic, u64 words of blocks, the blocks, u64 block offsets (first word of each
block, in words) with an end mark, u64 ids in each block, then the document table (doc_id,
first id, number of ids) and a fixed footer of counts.  With the offsets every block
decodes on its own, and all words of one selector decode in one vectorised step.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .words import chunks

BLOCK = 1024
END_ID = 1
TAIL = ".,;:!?#$%&*|"  # marks that are cut from a word's end before it is encoded
MAGIC = b"S8BIDS01"
# Ids a word for each selector, and bits an id
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15
_DISPUTED = "\u0370"  # from here on words go to the library whole
_FOOTER = "<QQQ8s"
_NULL_ID = -(2**63)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end) of the ids, BLOCK ids a block.

    Which count fits is known for every position at once; the greedy walk then runs
    over all blocks in step.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    bits = np.full((blocks, BLOCK + int(COUNTS[0])), 255, np.uint8)  # nothing fits across a block's end
    flat = np.full(blocks * BLOCK, 255, np.uint8)
    flat[:n] = np.frexp(ids.astype(np.float64))[1]
    bits[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    choice = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    widest, done = bits[:, :BLOCK], 1
    for s in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[s])
        for k in range(done, count):
            widest = np.maximum(widest, bits[:, k : k + BLOCK])
        done = count
        fits = widest <= WIDTHS[s]
        if not fits.any():
            break
        choice[fits] = s
    choice = choice.reshape(-1)
    step = np.ones(16, np.int64)
    step[: len(COUNTS)] = COUNTS
    at = np.arange(blocks) * BLOCK
    stop = np.minimum(at + BLOCK, n)
    used = []
    while len(at):
        used.append(at)
        at = at + step[choice[at]]
        go = at < stop
        at, stop = at[go], stop[go]
    place = np.sort(np.concatenate(used))
    owner = place // BLOCK
    selector = choice[place]
    size = 1 + (selector == ESCAPE)
    slot = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in range(len(COUNTS)):
        pick = np.flatnonzero(selector == s)
        if len(pick):
            shift = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            part = ids[place[pick][:, None] + np.arange(COUNTS[s])] << shift
            words[slot[pick]] = np.bitwise_or.reduce(part, axis=1) | np.uint64(s << 60)
    pick = np.flatnonzero(selector == ESCAPE)
    words[slot[pick]] = np.uint64(ESCAPE << 60)
    words[slot[pick] + 1] = ids[place[pick]]
    per_block = np.bincount(owner, weights=size, minlength=blocks).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def decode_words(words: np.ndarray) -> np.ndarray:
    """All ids of a run of whole blocks."""
    words = np.asarray(words, np.uint64)
    n = len(words)
    if not n:
        return words
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():  # the word after an escape is data, whatever it looks like
        data = np.zeros(n, bool)
        at = 0
        marks = np.flatnonzero(selector == ESCAPE)
        for at in marks.tolist():
            if not data[at]:
                data[at + 1] = True
    else:
        data = np.zeros(n, bool)
    head = np.flatnonzero(~data)
    selector = selector[head]
    count = np.ones(16, np.int64)
    count[: len(COUNTS)] = COUNTS
    size = count[selector]
    slot = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        pick = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[slot[pick]] = words[head[pick] + 1]
            continue
        shift = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        out[slot[pick][:, None] + np.arange(COUNTS[s])] = (words[head[pick]][:, None] >> shift) & mask
    return out


class IdFile:
    """Writes one file: whole documents in the order given."""

    def __init__(self, stream):
        self.stream, self.words, self.n = stream, 0, 0
        self.rest = np.zeros(0, np.uint64)
        self.offsets, self.sizes, self.docs = [0], [], []
        stream.write(MAGIC)

    def add(self, doc_ids: list[int], lengths: np.ndarray, ids: np.ndarray) -> None:
        first = self.n + np.cumsum(lengths) - lengths
        self.docs += zip(doc_ids, first.tolist(), lengths.tolist())
        self.n += len(ids)
        self.rest = np.concatenate([self.rest, ids.astype(np.uint64)])
        whole = len(self.rest) // BLOCK * BLOCK
        self._blocks(self.rest[:whole])
        self.rest = self.rest[whole:]

    def _blocks(self, ids: np.ndarray) -> None:
        words, offsets = encode_blocks(ids)
        self.stream.write(words.astype("<u8").tobytes())
        self.offsets += (self.words + offsets[1:]).tolist()
        self.sizes += [min(BLOCK, len(ids) - i) for i in range(0, len(ids), BLOCK)]
        self.words += len(words)

    def close(self) -> None:
        self._blocks(self.rest)
        put = lambda x, t="<u8": self.stream.write(np.asarray(x, t).tobytes())
        put(self.offsets)
        put(self.sizes)
        put(np.asarray(self.docs, np.int64).reshape(-1, 3), "<i8")
        self.stream.write(struct.pack(_FOOTER, self.words, len(self.sizes), len(self.docs), MAGIC))
        self.stream.close()


def read_index(f) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block offsets, ids a block, document table) of an open file, from its end."""
    size = f.size()
    tail = struct.calcsize(_FOOTER)
    words, blocks, docs, magic = struct.unpack(_FOOTER, f.read_at(tail, size - tail))
    if magic != MAGIC or f.read_at(8, 0) != MAGIC:
        raise ValueError("not a token id file")
    at = 8 + 8 * words
    raw = f.read_at(size - tail - at, at)
    offsets = np.frombuffer(raw, "<u8", blocks + 1).astype(np.int64)
    sizes = np.frombuffer(raw, "<u8", blocks, 8 * (blocks + 1)).astype(np.int64)
    table = np.frombuffer(raw, "<i8", 3 * docs, 8 * (2 * blocks + 1)).reshape(-1, 3)
    return offsets, sizes, table


def read_documents(f, most: int = 4096):
    """(doc_id, first id, ids) of each document, decoding about ``most`` blocks at a time."""
    offsets, sizes, table = read_index(f)
    have, held, block = 0, np.zeros(0, np.uint64), 0
    for doc_id, first, n in table.tolist():
        while have + len(held) < first + n:
            stop = min(block + most, len(sizes))
            raw = f.read_at(8 * int(offsets[stop] - offsets[block]), 8 + 8 * int(offsets[block]))
            drop = min(first - have, len(held))
            held, have = np.concatenate([held[drop:], decode_words(np.frombuffer(raw, "<u8"))]), have + drop
            block = stop
        yield doc_id, first, held[first - have : first - have + n]


class WordEncoder:
    """Ids of whole texts, each distinct blank-free piece encoded once by the library.

    The vocabulary drops white space, lower-cases and has no token that spans white space,
    so a text's ids are those of its pieces in order.  A-Z are lowered first to meet fewer
    pieces (not where control strings may be, as those match the text as written, nor where
    combining marks are, as the library composes letters with them before it lowers).  The
    memory of pieces lasts as long as the worker process and is emptied at ``most`` entries.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closing[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self, missing: list | None = None, distinct: list | None = None) -> None:
        """Empties the memory, or cuts it back to the half that was met first: common pieces come early."""
        if missing is not None and len(missing) < len(distinct) // 2:
            keep = self.most // 2
            self.known = {p: i for p, i in self.known.items() if i < keep}
            self.at = int(self.start[keep - 1] + self.size[keep - 1])
            return
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.at = 0

    def _learn(self, pieces: list[bytes]) -> None:
        """Enters new pieces.  Letters and the marks after them are pre-tokens of their own,
        so a word with marks is put together from its stem and its tail."""
        words = [p.decode() for p in pieces]
        stems = [w.rstrip(TAIL) for w in words]
        known = self.known
        letters = list(map(_letters, stems))
        plain = [s for s in {s for s, ok in zip(stems, letters) if ok} if s.encode() not in known]
        tails = list({w[len(s) :] for w, s, ok in zip(words, stems, letters) if ok and len(w) > len(s)})
        tails = [t for t in tails if t.encode() not in known]
        fresh = set(tails)
        rest = [w for w, ok in zip(words, letters) if not ok and w not in fresh]
        for i in range(0, len(plain), 4000):
            part = plain[i : i + 4000]
            self._enter(part, *self._alphabetic(part))
        for i in range(0, len(rest + tails), 4000):
            part = (rest + tails)[i : i + 4000]
            self._enter(part, *self._single(part))
        both = [(p, s.encode(), w[len(s) :].encode()) for p, w, s in zip(pieces, words, stems) if p not in known]
        if both:
            at = np.array([[known[s], known[t]] for _, s, t in both]).reshape(-1)
            n = self.size[at].astype(np.int64)
            total = np.cumsum(n)
            flat = self.flat[np.repeat(self.start[at] - (total - n), n) + np.arange(total[-1])]
            self._enter([p for p, _, _ in both], flat, n.reshape(-1, 2).sum(axis=1))

    def _enter(self, part: list, flat: np.ndarray, size: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip([p if isinstance(p, bytes) else p.encode() for p in part], range(n, n + len(part))))
        self.flat = _room(self.flat, self.at + len(flat))
        self.start, self.size = _room(self.start, n + len(part)), _room(self.size, n + len(part))
        self.flat[self.at : self.at + len(flat)] = flat
        self.size[n : n + len(part)] = size
        self.start[n : n + len(part)] = self.at + np.cumsum(size) - size
        self.at += len(flat)

    def _alphabetic(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters, many in one text: each ends with the one id that closes a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(part) or (len(ends) and ends[-1] != len(ids)):
            return self._single(part)
        return ids, np.diff(ends, prepend=0)

    def _single(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def texts(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids a text, all ids), with the end id after each text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        as_is = pc.match_substring_regex(column, r"<\||\pM")
        column = pc.if_else(as_is, column, pc.ascii_lower(column))
        split = pc.ascii_split_whitespace(column)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        number = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(number < 0).tolist()
        if missing:
            if len(self.known) + len(missing) > self.most:
                self._forget(missing, distinct)
                number = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
                missing = np.flatnonzero(number < 0).tolist()
            self._learn([distinct[i] for i in missing])
            number[missing] = [self.known[distinct[i]] for i in missing]
        order = number[words.indices.to_numpy(zero_copy_only=False)]
        n = self.size[order].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.start[order] - total[:-1], n) + np.arange(total[-1])]
        close = total[np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)]
        return np.diff(close, prepend=0) + 1, np.insert(ids, close, END_ID)


def _letters(stem: str) -> bool:
    """Only letters, lowered too, of scripts whose letters no Unicode version disputes."""
    return stem.isalpha() and (stem.isascii() or (max(stem) < _DISPUTED and stem.lower().isalpha()))


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, partitions: int | None = None) -> DataFrame:
    """Encodes docs in ascending doc_id order, a file a partition; (part, name, ids)."""
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = base.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered = ordered.withColumn("part", F.spark_partition_id())

    def write(batches):
        fs, root = store.filesystem(folder)
        fs.create_dir(root, recursive=True)
        encode = out = None
        for batch in batches:
            for piece in chunks(batch, "text"):
                if out is None:
                    part = piece.column(2)[0].as_py()
                    name = f"{store.task_suffix()}.s8b"
                    encode, out = encoder(tokenizer), IdFile(fs.open_output_stream(f"{root}/{name}"))
                lengths, ids = encode.texts(piece.column(1))
                out.add(piece.column(0).to_pylist(), lengths, ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "ids": pa.array([out.n], pa.int64())})

    return ordered.select("doc_id", "text", "part").mapInArrow(write, "part int, name string, ids long")


def read_ids(spark: SparkSession, folder: str, files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files.

    The list of files (one row for each written partition) is the only thing that the
    driver reads; the ids before each file follow from it.
    """
    total, base = 0, []
    for row in files.orderBy("part").toLocalIterator():
        base.append((row["name"], total))
        total += row["ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches):
        fs, root = store.filesystem(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    rows = []
                    for doc_id, first, ids in read_documents(f):
                        rows.append((None if doc_id == _NULL_ID else doc_id, before + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids))
                        if len(rows) == 1000:
                            yield _rows(rows, with_ids)
                            rows = []
                    if rows:
                        yield _rows(rows, with_ids)

    table = spark.createDataFrame(base, "name string, before long").repartition(max(1, len(base)), "name")
    return table.mapInArrow(read, schema)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = {k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(("doc_id", "start", "n_tokens", "ids_crc32"))}
    if with_ids:
        cols["ids"] = pa.array([r[4].astype(np.int64) for r in rows], pa.list_(pa.int64()))
    return pa.RecordBatch.from_pydict(cols)


def encode_to_files(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Writes the ids of docs (doc_id, text) and returns what reading the files back gives.

    A null text is empty and has the end id alone.  Rows with a null doc_id come first and
    stay null; repeated doc_ids are separate documents, ordered by a hash of the text.
    ids_crc32 is that of the ids as little-endian unsigned 32-bit integers.  Other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    store.arrow_limits(spark)
    folder = store.new_path(spark, "ids")
    files = store.cut(write_ids(docs, tokenizer, folder), "idfiles")
    return read_ids(spark, folder, files, with_ids)
