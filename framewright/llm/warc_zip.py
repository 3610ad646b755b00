"""WARC records inside ZIP packages: a writer, and a reader that never unpacks the package.

A package holds ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` as *stored* members, so a record is a byte range of the package.
The reader takes the end record, the ZIP64 locator and end record where there are any,
and the central directory; it finds the stored archive members and their indexes, turns
index lines into byte ranges of the package, and reads these ranges.  Packages live in
the shared folder; writers use a name of their own for each attempt, and only names that
a finished task has reported are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
_U16, _U32 = 0xFFFF, 0xFFFFFFFF
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_END_SIZE, _LOCATOR_SIZE, _END64_SIZE = 22, 20, 56


class ZipError(ValueError):
    """The bytes are not a readable ZIP package."""


# ---------------------------------------------------------------- ZIP, writing


class StoredZip:
    """Writes stored members one after another to a stream; ZIP64 where sizes ask for it.

    Sizes follow the data (descriptor), so nothing is buffered and no seek is needed.
    ``zip64=True`` writes 64-bit records however small the package is.
    """

    def __init__(self, stream, zip64: bool = False):
        self.stream, self.zip64, self.at, self.members = stream, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<4sHHHHHIIIHH", _LOCAL, 45, 0x0808, 0, 0, 0x21, 0, _U32, _U32, len(raw), len(extra)) + raw + extra)
        self.data_at = self.at

    def write(self, data: bytes) -> None:
        member = self.members[-1]
        member[2] = zlib.crc32(data, member[2])
        member[3] += len(data)
        self._put(data)

    def end(self) -> None:
        _, _, crc, size = self.members[-1]
        self._put(struct.pack("<4sIQQ", b"PK\x07\x08", crc, size, size))

    def close(self, comment: bytes = b"") -> None:
        start = self.at
        for raw, offset, crc, size in self.members:
            big = self.zip64 or size >= _U32 or offset >= _U32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if big else b""
            low, place = (_U32, _U32) if big else (size, offset)
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, low, low, len(raw), len(extra), 0, 0, 0, 0, place) + raw + extra)
        size, n = self.at - start, len(self.members)
        if self.zip64 or start >= _U32 or size >= _U32 or n >= _U16:
            place = self.at
            self._put(struct.pack("<4sQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<4sIQI", _LOCATOR64, 0, place, 1))
            n, size, start = _U16, _U32, _U32
        self._put(struct.pack("<4sHHHHIIH", _END, 0, 0, n, n, size, start, len(comment)) + comment)


# ---------------------------------------------------------------- ZIP, reading


def directory(read_at, size: int) -> dict[str, tuple[int, int, int]]:
    """{member name: (method, offset of its data, stored size)} from range reads alone.

    ``read_at(offset, length)`` returns bytes.  Self-extracting prefixes are allowed: all
    offsets are shifted by what the directory's own place says.
    """
    if size < _END_SIZE:
        raise ZipError("too short for an end record")
    tail_at = max(0, size - _END_SIZE - _U16)
    tail = read_at(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) - at < _END_SIZE or at + _END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ZipError("no end record")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end_at = tail_at + at
    stop = end_at
    locator = read_at(end_at - _LOCATOR_SIZE, _LOCATOR_SIZE) if end_at >= _LOCATOR_SIZE else b""
    if locator[:4] == _LOCATOR64:
        place = struct.unpack_from("<Q", locator, 8)[0]
        record = read_at(place, _END64_SIZE) if place + _END64_SIZE <= size else b""
        if record[:4] != _END64:  # a prefix moves it; it ends right before the locator
            place = end_at - _LOCATOR_SIZE - _END64_SIZE
            record = read_at(max(place, 0), _END64_SIZE)
        if record[:4] != _END64:
            raise ZipError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
        stop = place
    shift = stop - length - start
    if shift < 0:
        raise ZipError("the central directory does not fit")
    raw = read_at(start + shift, length)
    members, at = {}, 0
    for _ in range(count):
        if raw[at : at + 4] != _CENTRAL:
            raise ZipError("bad central directory entry")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", raw, at + 20)
        offset = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = raw[at + 46 + name_n : at + 46 + name_n + extra_n], 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # holds, in this order, only the fields that overflow
                fields = iter(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                full = next(fields) if full == _U32 else full
                packed = next(fields) if packed == _U32 else packed
                offset = next(fields) if offset == _U32 else offset
            e += 4 + n
        local = read_at(offset + shift, 30)
        if local[:4] != _LOCAL:
            raise ZipError(f"no local header for {name}")
        members[name] = (method, offset + shift + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        at += 46 + name_n + extra_n + comment_n
    return members


# ---------------------------------------------------------------- WARC records


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit of the record ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(3, f"WARC-Refers-To: <urn:x-page:{refers_to}>")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0)


def parse_record(member: bytes) -> dict:
    """Headers (lower-case names), payload and HTTP length of one record."""
    raw = gzip.decompress(member)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    block = raw[end + 4 : end + 4 + int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in http.decode("latin-1").split("\r\n")[1:])}
    return {"head": head, "payload": payload, "length": int(fields["content-length"])}


def _urn(text: str) -> int | None:
    number = text.rsplit(":", 1)[1].rstrip(">")
    return int(number) if number else None


# ---------------------------------------------------------------- Spark jobs


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Adds digest and refers_to: of equal payloads of ``least`` bytes or more the largest page_id is kept."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    base = base.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("n", F.octet_length("html"))
    kept = base.where(F.col("n") >= least).groupBy("digest", "n").agg(F.max("page_id").alias("kept"), F.count("*").alias("c")).where("c > 1 and kept is not null").drop("c")
    # written first: a join of two plain exchanges is one whose hot payloads Spark can split
    kept = store.cut(kept, "kept")
    revisits = (
        base.where(F.col("n") >= least)
        .select(F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest"), F.col("n").alias("own_n"))
        .join(kept, (F.col("own_digest") == F.col("digest")) & (F.col("own_n") == F.col("n")))
        .where(~F.col("own_id").eqNullSafe(F.col("kept")))
        .select("own_id", "own_digest", "own_n", F.col("kept").alias("refers_to"))
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")) & (F.col("n") == F.col("own_n"))
    return base.join(revisits, same, "left").select("page_id", "url", "html", "digest", "refers_to")


def write_packages(rows: DataFrame, folder: str, zip64: bool = False, most: int = 64 << 20) -> DataFrame:
    """Writes rows (page_id, url, html, digest, refers_to) as packages of about ``most`` bytes; (path, records)."""

    def write(batches):
        fs, root = store.filesystem(folder)
        fs.create_dir(root, recursive=True)
        z = None
        made: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if z is None:
                    name = f"{store.task_suffix()}.wacz"
                    out = fs.open_output_stream(f"{root}/{name}")
                    z, index = StoredZip(out, zip64), []
                    z.begin(ARCHIVE)
                payload = (row["html"] or "").encode()
                member = record_bytes(row["page_id"], row["url"], payload, row["digest"], row["refers_to"])
                index.append(f"{-1 if row['page_id'] is None else row['page_id']:020d} {json.dumps({'offset': z.at - z.data_at, 'length': len(member), 'filename': ARCHIVE})}\n")
                z.write(member)
                if z.at >= most:
                    made.append(_finish(z, index, out, name))
                    z = None
        if z is not None:
            made.append(_finish(z, index, out, name))
        yield pa.RecordBatch.from_pydict({"name": pa.array([n for n, _ in made], pa.string()), "records": pa.array([c for _, c in made], pa.int64())})

    return rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, "name string, records long")


def _finish(z: StoredZip, index: list[str], out, name: str) -> tuple[str, int]:
    z.end()
    z.begin(INDEX)
    for line in sorted(index):
        z.write(line.encode())
    z.end()
    z.close()
    out.close()
    return name, len(index)


def record_ranges(read_at, size: int) -> list[tuple[int, int]]:
    """(place, length) in the package of every record of its stored archive members.

    Indexes (``indexes/``, JSON lines; plain or gzip, stored or deflated) say where the
    records are; an archive member that no index line names is walked through instead, gzip
    member by gzip member.  What can't be read that way is an error, never left out.
    """
    members = directory(read_at, size)
    archives = {k: m for k, m in members.items() if k.startswith("archive/") and k.endswith((".warc", ".warc.gz"))}
    if not archives:
        raise ZipError("no archive member")
    for name, (method, _, _) in archives.items():
        if method or not name.endswith(".gz"):
            raise ZipError(f"{name} is not a stored file of gzip members")
    ranges, named = [], set()
    for member, (method, at, n) in members.items():
        if not (member.startswith("indexes/") and member.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz"))):
            continue
        if method not in (0, 8):
            raise ZipError(f"{member}: compression method {method}")
        raw = read_at(at, n)
        raw = zlib.decompress(raw, -15) if method else raw
        raw = gzip.decompress(raw) if member.endswith(".gz") else raw
        for line in raw.decode().splitlines():
            if not line.strip() or line.startswith("!"):
                continue
            if "{" not in line:
                raise ZipError(f"{member} has lines without JSON")
            entry = json.loads(line[line.index("{") :])
            name = entry["filename"] if entry["filename"] in archives else f"archive/{entry['filename']}"
            offset, length = int(entry["offset"]), int(entry["length"])
            if name not in archives or offset + length > archives[name][2]:
                raise ZipError(f"{entry['filename']} is not stored whole")
            named.add(name)
            ranges.append((archives[name][1] + offset, length))
    for name in archives.keys() - named:
        ranges += walk_members(read_at, archives[name][1], archives[name][2])
    return sorted(ranges)


def walk_members(read_at, at: int, size: int, step: int = 1 << 20) -> list[tuple[int, int]]:
    """(place, length) of each gzip member of the ``size`` bytes from ``at`` on."""
    out, begin, place, stop = [], at, at, at + size
    unpack, rest = zlib.decompressobj(31), b""
    while place < stop or rest:
        if not rest:
            rest = read_at(place, min(step, stop - place))
            place += len(rest)
        unpack.decompress(rest)
        rest = b""
        if unpack.eof:
            rest = unpack.unused_data
            out.append((begin, place - len(rest) - begin))
            begin = place - len(rest)
            unpack = zlib.decompressobj(31)
    if begin != stop:
        raise ZipError("an archive member ends within a record")
    return out


def locate(packages: DataFrame, folder: str, group: int = 256) -> DataFrame:
    """packages (name): byte ranges of all records, ``group`` of them a row (name, offsets, lengths)."""

    def find(batches):
        fs, root = store.filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{name}") as f:
                    ranges = record_ranges(lambda at, n: f.read_at(n, at), f.size())
                for i in range(0, len(ranges), group):
                    part = ranges[i : i + group]
                    yield pa.RecordBatch.from_pydict(
                        {"name": [name], "offsets": pa.array([[a for a, _ in part]], pa.list_(pa.int64())), "lengths": pa.array([[n for _, n in part]], pa.list_(pa.int64()))}
                    )

    return packages.select("name").mapInArrow(find, "name string, offsets array<long>, lengths array<long>")


def read_records(ranges: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Range-reads records; checks every response's payload against its digest."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload string" * with_payload

    def read(batches):
        fs, root = store.filesystem(folder)
        for batch in batches:
            for name, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                with fs.open_input_file(f"{root}/{name}") as f:
                    for at, n in zip(offsets, lengths):
                        record = parse_record(f.read_at(n, at))
                        head, kind = record["head"], record["head"]["warc-type"]
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if kind == "response" and (hashlib.sha1(record["payload"]).hexdigest() != digest or len(record["payload"]) != record["length"]):
                            raise ValueError(f"{name} at {at}: payload does not match its digest")
                        row = {"page_id": _urn(head["warc-record-id"]), "payload_bytes": record["length"], "payload_digest": digest, "record_type": kind}
                        row |= {"refers_to": _urn(head["warc-refers-to"]) if "warc-refers-to" in head else None, "url": head["warc-target-uri"]}
                        if with_payload:
                            row["payload"] = record["payload"].decode() if kind == "response" else None
                        rows.append(row)
                fields = [pa.field(k, pa.int64() if t == "long" else pa.string()) for k, t in (x.split() for x in schema.split(", "))]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    return ranges.mapInArrow(read, schema)


def archive(pages: DataFrame, folder: str | None = None, least: int = 1000, zip64: bool = False) -> tuple[str, DataFrame]:
    """Writes pages (page_id, url, html) as packages; (folder, finished packages)."""
    spark = pages.sparkSession
    store.arrow_limits(spark)
    folder = folder or store.new_path(spark, "warc")
    return folder, store.cut(write_packages(with_revisits(pages, least), folder, zip64), "packages")


def read_back(spark: SparkSession, folder: str, packages: DataFrame, with_payload: bool = False) -> DataFrame:
    ranges = locate(packages.repartition("name"), folder)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_records(ranges.repartition(n), folder, with_payload)


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """One row per page: what its record says when it is read back from the packages.

    Null html is an empty payload (always a response), a null url is about:blank.  Every row
    gets a record of its own, repeated page_ids and null ones too: of equal payloads all
    records but those with the largest page_id refer to that one (none does where all ids
    are null).  Other columns are ignored; an empty table gives no packages and no rows.
    """
    folder, packages = archive(pages, least=least)
    return read_back(pages.sparkSession, folder, packages).drop("url")

