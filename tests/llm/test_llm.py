"""The training-data operators against brute force, round trips and edge cases."""

import gzip
import hashlib
import io
import json
import random
import re
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA, same_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.llm import chat_format, components, decontaminate, fertility, line_dedup, piece_lattice, queries, simhash_vptree, substring_dedup, token_ids, toxicity, warc_zip, word_pairs, words

SP = queries.vocabulary("piece_bpe_32k.model")
BPE = queries.vocabulary("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "   ", "\n\n", "a", "one two", "éé ☃ \U0001f600", "x" * 3000, "w " * 2000, "a\x1fb\x85c　d", "<|endoftext|> A<|x", "tab\tand\r\nlines\n\nend"]


def docs_of(spark, texts, parts=3):
    """Rows with columns that operators use inside, to see them ignored."""
    rows = [(i, t, "en", "k", 1, "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, lo int, component string").repartition(parts)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def some_texts(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "cc", "dé", "e.", "F"]
    texts = list(ODD)
    while len(texts) < n:
        t = []
        for _ in range(rnd.randint(0, 6)):
            kind = rnd.random()
            if kind < 0.2:
                t += [rnd.choice(vocabulary)] * rnd.randint(1, 30)
            elif kind < 0.5:
                s = (rnd.choice(texts) or "").split()[:300]
                at = rnd.randint(0, max(0, len(s) - 1))
                t += s[at : at + rnd.randint(3, 40)]
            elif kind < 0.6:
                t += ["a", "b"] * rnd.randint(1, 15)
            else:
                t += [rnd.choice(vocabulary) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(1, 25))]
        texts.append(rnd.choice([" ", "\n"]).join(t))
    return texts


EMPTY = "doc_id long, text string"


# ---------------------------------------------------------------- shared parts


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words(texts):
    w = words.Words(pa.array(texts, pa.string()))
    raw = w.data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(w.starts[w.first[t] : w.first[t + 1]], w.ends[w.first[t] : w.first[t + 1]])] for t in range(len(texts))]
    assert got == [WORD.findall(t) for t in texts]
    flat = [x for t in got for x in t]
    h = w.hashes(1)
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(rnd.randint(100, 160), rnd.randint(100, 160)) for _ in range(50)] + [(500, 501 + i) for i in range(40)] + [(7, 7), (3, 4)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges for x in e if any(x in f and f[0] != f[1] for f in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- 1 lines


def _distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(prev[j] + (x != y), prev[j + 1] + 1, row[j] + 1))
        prev = row
    return prev[-1]


def test_line_dedup(spark):
    rnd = random.Random(2)
    stock = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    base = [[rnd.choice(stock) for _ in range(rnd.randint(1, 60))] for _ in range(25)]
    texts = [None, "", "---\n\n---", "same line here\nSame, line here!"]
    for _ in range(40):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1])):
                line[rnd.randrange(len(line))] = rnd.choice(stock)
            lines.append(rnd.choice([" ".join(line), " ".join(line).upper() + "!!", "---"]))
        texts.append("\n".join(lines))
    norm = lambda s: re.sub(r"[^\w]+|_", " ", s.lower()).strip()
    seen = [(i, j, norm(x)) for i, t in enumerate(texts) if t is not None for j, x in enumerate(t.split("\n")) if norm(x)]
    distinct = sorted({s[2] for s in seen})
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(distinct)], "lid long, norm string")
    keys = {n: set() for n in distinct}
    for r in line_dedup.line_keys(rows).collect():
        keys[distinct[r.lid]].add(r.key)
    parent = {n: n for n in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if keys[a] & keys[b] and _distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9):
                parent[root(a)] = root(b)
    met, gone = set(), {}
    for i, j, n in sorted(seen):
        if root(n) in met:
            gone.setdefault(i, set()).add(j)
        met.add(root(n))
    got = by_id(line_dedup.dedup_lines(docs_of(spark, texts)))
    for i, t in enumerate(texts):
        kept = None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone.get(i, ()))
        assert (got[i].text, got[i].n_lines, got[i].n_removed) == (kept, 0 if t is None else len(t.split("\n")), len(gone.get(i, ())))
    left = line_dedup.keep_lines(docs_of(spark, texts))
    assert left.columns == docs_of(spark, texts).columns
    assert {r.doc_id for r in left.collect()} == {i for i, t in enumerate(texts) if not (i in gone and not norm(got[i].text))}


def test_line_dedup_empty_and_wide(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], EMPTY)).count() == 0
    long = "w" + " ".join(str(i % 7) for i in range(70_000))
    got = by_id(line_dedup.dedup_lines(docs_of(spark, [long, long, long + " 8"])))
    assert [got[i].n_removed for i in range(3)] == [0, 1, 1]
    odd = "gone_id long, gone_lines long, gone_mark long, LID string, doc_id long, text string, n_lines int, `a.b` int"
    rows = [(7, 8, 9, "x", None, "a line twice here\nother", 1, 2), (7, 8, 9, "x", None, "A line, twice here", 1, 2), (1, 1, 1, "", 3, None, 1, 2), (1, 1, 1, "", 4, "", 1, 2)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, odd))
    assert got.columns == ["gone_id", "gone_lines", "gone_mark", "LID", "doc_id", "text", "a.b", "n_lines", "n_removed"]
    got = sorted((r.doc_id or 0, r.gone_id, r.n_lines, r.n_removed) for r in got.collect())
    assert got[2:] == [(3, 1, 0, 0), (4, 1, 1, 0)] and sorted(x[3] for x in got[:2]) == [0, 1] and {x[1] for x in got[:2]} == {7}


def test_rows_of_one_id_lose_only_their_own_lines(spark):
    rows = [(5, "first text line of this row\nshared line of both documents"), (5, "something else entirely\nnobody ever wrote this one"), (9, "Shared line of both documents!\nnobody ever wrote this one")]
    got = sorted(r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, EMPTY)).collect())
    assert got == sorted([rows[0][1], rows[1][1], ""])


def _edited(rnd, words, kind, word):
    out = list(words)
    k = rnd.randrange(len(out))
    if kind == "letter":
        at = rnd.randrange(len(out[k]))
        out[k] = out[k][:at] + rnd.choice([c for c in "abcdefgh" if c != out[k][at]]) + out[k][at + 1 :]
    elif kind == "insert":
        out.insert(k, word())
    elif kind == "drop":
        del out[k]
    else:
        for _ in range({"word": 1, "two": 2}[kind]):
            out[rnd.randrange(len(out))] = word()
    return out


@pytest.mark.parametrize("kind,least", [("letter", 1.0), ("word", 0.99), ("insert", 0.97), ("drop", 0.97), ("two", 0.85)])
def test_edited_lines_share_a_key(spark, kind, least):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    pairs = []
    for size in [2, 3, 5, 8, 9, 10, 12, 15, 20, 27, 36, 50, 71, 72, 90, 150, 300, 1000]:
        for _ in range(25):
            a = [word() for _ in range(size)]
            b = _edited(rnd, a, kind, word)
            x, y = " ".join(a), " ".join(b)
            if min(map(len, a)) > 1 and (size > 60 or _distance(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)):
                pairs.append((x, y))
    rows = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "lid long, norm string")
    keys = [set() for _ in range(2 * len(pairs))]
    for r in line_dedup.line_keys(rows).collect():
        keys[r.lid].add(r.key)
    share = [bool(keys[2 * i] & keys[2 * i + 1]) for i in range(len(pairs))]
    assert len(share) > 200 and sum(share) >= least * len(share)


def test_many_lines_of_two_words_make_few_pairs(spark):
    rnd = random.Random(3)
    stock = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(200)]
    lines = sorted({f"{rnd.choice(stock)} {rnd.choice(stock)}" for _ in range(4000)})
    keys = line_dedup.line_keys(spark.createDataFrame(list(enumerate(lines)), "lid long, norm string"))
    assert keys.groupBy("key").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0] < 3 * len(lines)


def test_words_dealt_in_rows_and_as_rows_give_the_same_keys(spark, monkeypatch):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(4, 9)))
    lines = [" ".join(word() for _ in range(n)) for n in (82, 90, 100, 120, 143, 144, 150, 161, 162, 200, 320, 700) for _ in range(5)]
    rows = spark.createDataFrame(list(enumerate(lines)), "lid long, norm string")
    keys = []
    for wide in (line_dedup.WIDE, 72):
        monkeypatch.setattr(line_dedup, "WIDE", wide)
        keys.append({(r.lid, r.key) for r in line_dedup.line_keys(rows).collect()})
    assert keys[0] == keys[1] and {x for x, _ in keys[0]} == set(range(len(lines)))


def test_line_keys_move_once_and_are_not_written(spark, monkeypatch):
    written = []
    cut = line_dedup.store.cut
    monkeypatch.setattr(line_dedup.store, "cut", lambda df, label, *a: written.append((label, df)) or cut(df, label, *a))
    line_dedup.dedup_lines(docs_of(spark, ["one line of several words here", "one line of several words there"])).collect()
    plans = {label: df._jdf.queryExecution().optimizedPlan().toString() for label, df in written}
    assert "keys" not in plans and "shared" not in plans
    assert plans["busy"].count("RepartitionByExpression [key") == 2  # equal ones, of which Spark runs one


# ---------------------------------------------------------------- 2 archives


def test_zip_directory():
    for zip64, comment in ((False, b"a comment PK\x05\x06 in it"), (True, b"PK\x05\x06"), (False, b""), (True, b"plain")):
        out = io.BytesIO()
        z = warc_zip.StoredZip(out, zip64)
        for name, data in (("archive/a", b"hello"), ("indexes/é", b""), ("x", b"y" * 1000)):
            z.begin(name)
            z.write(data[:2])
            z.write(data[2:])
            z.end()
        z.close(comment)
        for prefix in (b"", b"#!prefix\n"):
            raw = prefix + out.getvalue()
            found = warc_zip.directory(lambda at, n: raw[at : at + n], len(raw))
            assert {k: raw[a : a + n] for k, (m, a, n) in found.items()} == {"archive/a": b"hello", "indexes/é": b"", "x": b"y" * 1000}
        if b"PK" not in comment:  # the standard library takes such a comment for an end record
            assert zipfile.ZipFile(io.BytesIO(out.getvalue())).testzip() is None
    for broken in (b"", b"PK\x05\x06", b"x" * 100):
        with pytest.raises(warc_zip.ZipError):
            warc_zip.directory(lambda at, n: broken[at : at + n], len(broken))
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as f:
        f.writestr("archive/data", b"abc")
    raw = other.getvalue()
    assert {k: raw[a : a + n] for k, (_, a, n) in warc_zip.directory(lambda at, n: raw[at : at + n], len(raw)).items()} == {"archive/data": b"abc"}


def test_warc_round_trip(spark):
    big, small = "é" * 600, "s" * 999
    rows = [(1, "u", big), (2, None, big), (9, "u\r\nX: y", big), (3, "u", small), (4, "u", small), (5, "u", None), (6, "u", ""), (None, "u", "lost"), (7, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, n int")
    got = {r.page_id: r for r in warc_zip.round_trip(pages).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        1: ("revisit", 9, 1200), 2: ("revisit", 9, 1200), 9: ("response", None, 1200), 3: ("response", None, 999), 4: ("response", None, 999),
        5: ("response", None, 0), 6: ("response", None, 0), 7: ("response", None, 6), None: ("response", None, 4),
    }
    assert all(got[k].payload_digest == hashlib.sha1((h or "").encode()).hexdigest() for k, _, h in rows if k)
    folder, packages = warc_zip.archive(pages, zip64=True)
    texts = {r.page_id: r.payload for r in warc_zip.read_back(spark, folder, packages, with_payload=True).collect()}
    assert texts[9] == big and texts[7] == "a\r\n\r\nb" and texts[1] is None
    assert warc_zip.round_trip(pages.where("false")).count() == 0
    a, b = "a" * 1000, "b" * 1000
    again = spark.createDataFrame([(5, "u", a), (5, "u", b), (9, "u", a), (10, "u", b), (None, "u", b), (10, "v", b)], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.payload_digest, r.record_type, r.refers_to) for r in warc_zip.round_trip(again).collect())
    da, db = (hashlib.sha1(x.encode()).hexdigest() for x in (a, b))
    assert got == sorted([(5, da, "revisit", 9), (5, db, "revisit", 10), (9, da, "response", None), (10, db, "response", None), (0, db, "revisit", 10), (10, db, "response", None)], key=lambda r: r[:2])


def _package(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as f:
        for name, data, method in members:
            f.writestr(name, data, method)
    raw = out.getvalue()
    return raw, lambda at, n: raw[at : at + n]


def test_foreign_packages():
    digest = hashlib.sha1(b"x").hexdigest()
    records = [warc_zip.record_bytes(i, "u", b"x" * i * 1000, digest, None) for i in range(1, 5)]
    data, at, lines = b"".join(records), 0, []
    for i, r in enumerate(records):
        lines.append("com,example)/ 2000 " + json.dumps({"offset": str(at), "length": str(len(r)), "filename": "data.warc.gz"}))
        at += len(r)
    index = ("!meta\n" + "\n".join(lines) + "\n").encode()
    stored, deflated = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED
    whole = ("archive/data.warc.gz", data, stored)
    for extra in ([], [("indexes/index.cdx.gz", gzip.compress(index), stored)], [("indexes/index.cdxj", index, deflated)], [("indexes/index.cdxj", index, stored)]):
        raw, read_at = _package([whole, *extra])
        assert [raw[a : a + n] for a, n in warc_zip.record_ranges(read_at, len(raw))] == records
    for bad in ([("archive/data.warc.gz", data, deflated)], [("pages/pages.jsonl", b"{}", stored)], [("archive/data.warc.gz", data[:-5], stored)], [whole, ("indexes/index.cdx", b" CDX N b a\nx y z\n", stored)]):
        raw, read_at = _package(bad)
        with pytest.raises(warc_zip.ZipError):
            warc_zip.record_ranges(read_at, len(raw))


# ---------------------------------------------------------------- 3 toxicity


def _counted(texts, slots):
    """Counts of words by slot, and their bitmaps, word by word; names are those of the module."""
    counts, seen = {}, {}
    for text, slot in zip(texts, slots):
        found = words.Words(pa.array([text or ""]), words.PLAIN)
        before = 0
        for h in found.hashes(3).tolist():
            counts.setdefault(h, [0, 0, 0, 0])[slot] += 1
            seen[h] = seen.get(h, 0) | 1 << int(words.mix64(np.array([before], np.uint64))[0] & np.uint64(63))
            before = h
    return counts, seen


def test_models_sum_to_one():
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.6, (4, 500)).clip(0, 400) * (rng.random((4, 500)) < 0.4)
    counts = counts[:, counts.sum(axis=0) > 0].astype(float)
    k = rng.integers(1, 60_000, counts.shape[1]).astype(float)
    totals = {"k": k.sum()}
    for name, sides in toxicity.MODELS.items():
        c = [counts[list(s)].sum(axis=0) for s in sides]
        totals[name] = [(x.sum(), np.minimum(x, toxicity.DISCOUNT).sum()) for x in c]
        shared = np.append(k, 1000) / (k.sum() + 1000)  # the last: all words never seen
        p = []
        for x, (n, d) in zip(c, totals[name]):
            x = np.append(x, 0)
            p.append(np.maximum(x - toxicity.DISCOUNT, 0) / n + d / n * shared)
            assert abs(p[-1].sum() - 1) < 1e-12
        ratio, other = toxicity.log_ratio(counts, k, totals, name)
        assert np.allclose(np.append(ratio, other), np.minimum(np.log(p[1] / p[0]), toxicity.MOST))
        few = np.maximum(*c) <= toxicity.DISCOUNT
        assert few.any() and np.allclose(ratio[few], other)  # leaving them out changes nothing


def test_words_are_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD", 5)
    texts = [*ODD, *some_texts(4, 30)]
    slots = [i % 4 for i in range(len(texts))]
    got = {r.w % 2**64: r for r in toxicity.count_words(spark.createDataFrame(list(zip(texts, slots)), "text string, slot int").repartition(3)).collect()}
    counts, seen = _counted(texts, slots)
    assert {w: [r.c0, r.c1, r.c2, r.c3] for w, r in got.items()} == counts
    assert {w: r.seen % 2**64 for w, r in got.items()} == seen


def test_scores_match_brute_force(spark, monkeypatch):
    rnd = random.Random(6)
    stock = [f"w{i}" for i in range(200)]
    texts = [" ".join(rnd.choice(stock) for _ in range(rnd.randint(0, 40))) + (" vile scum" if i % 5 == 0 else "") for i in range(240)] + [None, "", "vile"]
    toxic = [int(i % 5 == 0) for i in range(240)]
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    folds = [zlib.crc32(str(i).encode()) % 3 for i in range(len(texts))]
    known = [i for i in range(240) if folds[i] != 1]
    counts, seen = _counted([texts[i] for i in known], [folds[i] + toxic[i] for i in known])
    followed = {w: round(-64_000 * np.log(1 - min(x.bit_count(), 63.5) / 64)) for w, x in seen.items()}

    def figure(text, sides):
        side = [{w: sum(c[s] for s in slots) for w, c in counts.items()} for slots in sides]
        n = [sum(x.values()) for x in side]
        reserve = [sum(min(c, 1.5) for c in x.values()) / m for x, m in zip(side, n)]
        ratios = []
        for h in words.Words(pa.array([text or ""]), words.PLAIN).hashes(3).tolist():
            shared = followed.get(h, 1) / (sum(followed.values()) + 1000)
            p = [max(x.get(h, 0) - 1.5, 0) / m + r * shared for x, m, r in zip(side, n, reserve)]
            ratios.append(min(p[1] / p[0], np.exp(toxicity.MOST)))
        return np.log(np.mean(ratios)) if ratios else 0.0

    x = np.array([figure(texts[i], toxicity.MODELS["second" if folds[i] == 0 else "first"]) for i in known])
    slope, bias = toxicity.fit_logistic(x[:, None], np.array([toxic[i] for i in known], float))
    assert slope > 0
    expected = [1 / (1 + np.exp(-(slope * figure(t, toxicity.MODELS["all"]) + bias))) for t in texts]
    for size in (1 << 20, 40):  # one block of words, and several
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", size)
        got = by_id(toxicity.score(docs_of(spark, texts), labels))
        assert np.allclose([got[i].score for i in range(len(texts))], expected, atol=1e-6)


def test_toxicity_learns(spark):
    rnd = random.Random(5)
    stock = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    texts, labels = [], []
    for i in range(600):
        t = [rnd.choice(stock) for _ in range(rnd.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                t.insert(rnd.randrange(len(t)), rnd.choice(["vile", "nasty", "awful"]))
        texts.append(" ".join(t))
        labels.append((i, int(toxic)))
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = by_id(toxicity.score(docs_of(spark, [*texts, None, "", "  "]), marks))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1 for i in got)
    held = [i for i in range(600) if got[i].held_out]
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.95
    assert got[600].score == got[601].score == got[602].score
    flipped = [(i, 1 - y if got[i].held_out else y) for i, y in labels]  # held-out labels are never looked at
    again = by_id(toxicity.score(docs_of(spark, [*texts, None, "", "  "]), spark.createDataFrame(flipped, "doc_id long, toxic int")))
    assert all(np.isclose(again[i].score, got[i].score) for i in got)


@pytest.mark.parametrize("size", [1 << 20, 40])  # one block of the model, and several
def test_pair_scores_match_brute_force(spark, monkeypatch, size):
    rnd = random.Random(16)
    stock = [f"w{i}" for i in range(150)]
    texts = [" ".join(rnd.choice(stock) + rnd.choice(["", " the"]) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", " vile scum"] if i % 5 == 0 else ["", " vile day"]) for i in range(400)]
    texts += [None, "", "vile", "scum vile scum unheard", "the the the"]
    toxic = [int(i % 5 == 0) for i in range(400)]
    folds = [zlib.crc32(str(i).encode()) % 3 for i in range(len(texts))]
    known = [i for i in range(400) if folds[i] != 1]
    cut = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    pairs = lambda t: list(zip([None, *cut(t)], cut(t)))

    def model(slots):
        c = {}
        for i in known:
            if folds[i] + toxic[i] in slots:
                for p in set(pairs(texts[i])):
                    c[p] = c.get(p, 0) + 1
        return c

    every = model({0, 1, 2, 3})
    words_of = sorted({w for _, w in every})
    k = {w: sum(x == w for _, x in every) for w in words_of}
    assert max(k.values()) > 64

    def chance(c):
        f = {}
        for _, w in c:
            f[w] = f.get(w, 0) + 1
        total = sum(f.values())
        reserve = sum(min(x, 1) for x in f.values()) / total
        n, d = {}, {}
        for (v, _), x in c.items():
            n[v], d[v] = n.get(v, 0) + x, d.get(v, 0) + min(x, 3)
        low = lambda w: max(f.get(w, 0) - 1, 0) / total + reserve * k.get(w, 1) / (sum(k.values()) + 1000)
        p = lambda v, w: max(c.get((v, w), 0) - 3, 0) / n.get(v, 1) + (d[v] / n[v] if v in n else 1) * low(w)
        for v in (None, "the", "vile", "unheard"):  # words never seen share the rest
            assert abs(sum(p(v, w) for w in words_of) + (d[v] / n[v] if v in n else 1) * reserve * 1000 / (sum(k.values()) + 1000) - 1) < 1e-9
        return p

    def figure(text, models):
        ratio = [min(models[1](*p) / models[0](*p), np.exp(word_pairs.MOST)) for p in pairs(text)]
        return np.log(np.mean(ratio)) if ratio else 0.0

    models = {m: [chance(model(set(s))) for s in toxicity.MODELS[m]] for m in toxicity.MODELS}
    x = np.array([figure(texts[i], models["second" if folds[i] == 0 else "first"]) for i in known])
    slope, bias = toxicity.fit_logistic(x[:, None], np.array([toxic[i] for i in known], float))
    assert slope > 0
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", size)
    monkeypatch.setattr(toxicity, "HELD", 50)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    got = by_id(toxicity.score(docs_of(spark, texts), labels, order=2))
    figures = [figure(t, models["all"]) for t in texts]
    assert np.allclose([got[i].log_ratio for i in range(len(texts))], figures, atol=1e-9)
    assert np.allclose([got[i].score for i in range(len(texts))], [1 / (1 + np.exp(-(slope * f + bias))) for f in figures], atol=1e-6)


def test_op3_scores_by_pairs_of_words(spark, monkeypatch):
    asked = []
    score = toxicity.score
    monkeypatch.setattr(queries.toxicity, "score", lambda *a, **k: asked.append(k) or score(*a, **k))
    assert {r.predicted for r in queries.op3_toxicity(spark, DATA).collect()} <= {0, 1} and asked == [{"order": 2}]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in score(docs_of(spark, ODD), none, order=2).collect()} == {0}
    assert score(spark.createDataFrame([], EMPTY), none, order=2).count() == 0


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs_of(spark, ODD), none).collect()} == {0}
    assert toxicity.score(spark.createDataFrame([], EMPTY), none).count() == 0


# ---------------------------------------------------------------- 4 quality


def test_quality_figures(spark):
    texts = some_texts(7) + ["# one\n# one\n \n \ntwo $%", "a b c d e f a b c d e f g h"]
    got = by_id(fertility.quality(docs_of(spark, texts), SP))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        five = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        covered = {k + j for k, x in enumerate(five) if five.count(x) > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        ids = [k for x in w for k in sp.encode(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert (r.n_dup_lines, r.n_repeat_words, r.n_tokens) == (len(lines) - len(set(lines)), len(covered), len(ids))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.kept and r.base_failed)
        if ids:
            p = np.array(list(np.unique(ids, return_counts=True)[1])) / len(ids)
            assert np.isclose(r.token_entropy, -(p * np.log2(p)).sum(), atol=1e-9)
            assert np.isclose(r.byte_share, np.mean([sp.is_byte(k) for k in ids])) and np.isclose(r.chars_per_token, sum(map(len, w)) / len(ids))
    good = fertility.keep_good(docs_of(spark, texts), SP)
    assert {r.doc_id for r in good.collect()} == {i for i in got if got[i].kept} and good.columns == docs_of(spark, texts).columns
    assert fertility.quality(spark.createDataFrame([], EMPTY), SP).count() == 0


def test_bands_tell_prose_from_noise(spark):
    rnd = random.Random(1)
    drawn = lambda letters, n=60: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(n))
    run = lambda a, b: [chr(c) for c in range(a, b)]
    noise = {
        "letters": [drawn("abcdefghijklmnopqrstuvwxyz", 200) for _ in range(20)],
        "consonants": [drawn("bcdfghjklmnpqrstvwxz", 100) for _ in range(20)],
        "hex": [drawn("0123456789abcdef", 100) for _ in range(20)],
        "base64": [" ".join(drawn("ABCDEFGHabcdefghijklmnopqrstuvwxyz0123456789+/", 60).replace(" ", "")[i : i + 20] for i in range(0, 240, 20)) for _ in range(20)],
        "han": [drawn(run(0x4E00, 0x9FA5)) for _ in range(20)],
        "hangul": [drawn(run(0xAC00, 0xD7A3)) for _ in range(20)],
        "scripts": [drawn([*"abcdefghijklmno", *run(0x430, 0x440)]) for _ in range(20)],
    }
    for name, texts in noise.items():
        base, kept = fertility.verdicts(fertility.measure(texts, SP))
        assert not base.any() and not kept.any(), name
    prose = [
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hoá ban cho lý trí.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować.",
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Всё смешалось в доме, и жена узнала об этом.",
        "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
        "人人 生而自由 在尊严和权利上 一律平等 他们赋有理性 和良心 并应以 兄弟关系的精神 相对待 人人有资格 享有本宣言 所载的一切权利 和自由",
        "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another.",
    ]
    base, kept = fertility.verdicts(fertility.measure(prose, SP))
    assert not base.any() and kept.all()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    clean = fertility.quality(docs, SP).where("not base_failed")
    assert clean.where("kept").count() >= 0.99 * clean.count()


def test_quality_bands(spark):
    clean = "The quick brown foxes were running over several lazy dogs while the rain kept falling on quiet green hills today"
    noise = " ".join(chr(0x10000 + i * 37) * 3 for i in range(40))
    got = by_id(fertility.quality(docs_of(spark, [clean, noise]), SP, {"other": (0.0, 9.0, 0.5, 0.0)}))
    assert (got[0].kept, got[0].script, got[1].kept, got[1].base_failed) == (True, "latin", False, False)


# ---------------------------------------------------------------- 5 decontamination


def _best_distance(p, t):
    prev = [0] * (len(t) + 1)
    for i, a in enumerate(p):
        row = [i + 1]
        for j, b in enumerate(t):
            row.append(min(prev[j] + (a != b), prev[j + 1] + 1, row[j] + 1))
        prev = row
    return min(prev)


def test_passages_match_brute_force():
    rnd = random.Random(1)
    hits = 0
    for _ in range(60):
        item = "".join(rnd.choice("abcde ") for _ in range(rnd.choice([30, 60, 100]))).strip()
        other = list(item)
        for _ in range(rnd.randint(0, max(1, len(item) // 12))):
            k, kind = rnd.randrange(len(other)), rnd.random()
            if kind < 0.4:
                other[k] = rnd.choice("abcde")
            elif kind < 0.7:
                other.insert(k, rnd.choice("abcde"))
            elif len(other) > 5:
                del other[k]
        pad = lambda: "".join(rnd.choice("abcde ") for _ in range(rnd.choice([0, 0, 3, 70])))
        texts = [pad() + "".join(other) + pad(), "".join(other), item[3:], None, ""]
        probes = decontaminate.Probes([(1, item)])
        got = [bool(x) for x in decontaminate._items(pa.array(texts), probes)]
        probe = decontaminate._strip(item).encode()
        for t, g in zip(texts, got):
            data, _ = decontaminate.normalise([t or ""])
            expected = len(probe) >= 8 and _best_distance(probe, data.tobytes()) <= decontaminate.budget(len(probe))
            assert g == expected
            hits += expected
    assert hits > 20


def test_decontamination(spark, monkeypatch):
    items = ["Some benchmark question, about the colour of the sky at noon?", "A second question that nobody ever asked before today.", None, "tiny"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(0, items[0], "x")], "item_id long, text string, doc_id string")
    texts = ["before " + items[0].upper().replace(" ", "  ") + " after", "clean text with nothing in it at all, really nothing", items[1] + "\n" + items[0], *ODD, "tiny tiny tiny"]
    got = by_id(decontaminate.matches(docs_of(spark, texts), bench))
    assert {i: r.item_ids for i, r in got.items() if r.contaminated} == {0: [0], 2: [0, 1], len(texts) - 1: [3]}
    assert all(r.n_items == len(r.item_ids) for r in got.values())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 50)  # every item is a block of its own
    split = by_id(decontaminate.matches(docs_of(spark, texts), bench))
    assert {i: r.item_ids for i, r in split.items()} == {i: r.item_ids for i, r in got.items()}
    clean = decontaminate.keep_clean(docs_of(spark, texts), bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {0, 2, len(texts) - 1}
    assert decontaminate.matches(docs_of(spark, texts), bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.matches(spark.createDataFrame([], EMPTY), bench).count() == 0


def test_blocks_change_no_row(spark, monkeypatch):
    asked = [f"question {hashlib.sha1(bytes([i])).hexdigest()} of the book" for i in range(30)]
    bench = spark.createDataFrame([*enumerate(asked), (99, "42 yes")], "item_id long, text string")
    rows = [(None, "nothing"), (None, f"so {asked[3]}, is it"), (4, "it says 42, yes!"), (4, "it says 42, yes!"), (4, "142 yes"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    said = lambda: sorted(map(str, decontaminate.matches(docs, bench).collect()))
    one = said()
    assert len(one) == 6 and sum("[99]" in x for x in one) == 2 and sum("[3]" in x for x in one) == 1
    for size, stretch in ((200, 1 << 20), (200, 1), (64, 100)):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        monkeypatch.setattr(decontaminate, "STRETCH", stretch)
        assert said() == one
        assert decontaminate.keep_clean(docs, bench).count() == 3


def test_long_and_foreign_passages_match_brute_force():
    rnd = random.Random(8)
    hits = misses = 0
    for k in range(40):
        letters = "абвгдежз " if k % 2 else "abcdefgh "
        item = "x" + "".join(rnd.choice(letters) for _ in range(rnd.choice([60, 250, 400]))).strip() + "y"
        other = list(item)
        for _ in range(rnd.randint(0, len(item) // rnd.choice([3, 12]))):
            other[rnd.randrange(len(other))] = rnd.choice(letters)
        text = "".join(rnd.choice(letters) for _ in range(50)) + "".join(other) + " ende"
        probes = decontaminate.Probes([(1, item)])
        data, offsets = decontaminate.normalise([text])
        expected = any(_best_distance(p.tobytes(), data.tobytes()) <= e for p, e in zip(probes.text, probes.edits))
        assert bool(decontaminate._items(pa.array([text]), probes)[0]) == expected
        hits, misses = hits + expected, misses + (not expected)
    assert hits > 5 and misses > 5


# ---------------------------------------------------------------- 6 lattice


def _all_segmentations(unit, v):
    if not unit:
        return [(0.0, ())]
    out = []
    for j in range(1, len(unit) + 1):
        score = v.score.get(unit[:j])
        if score is not None:
            ids = (v.id[unit[:j]],)
        elif j == 1:
            raw = unit[0].encode()
            score, ids = v.byte_score * len(raw), tuple(int(v.byte[b]) for b in raw)
        else:
            continue
        out += [(score + s, ids + rest) for s, rest in _all_segmentations(unit[j:], v)]
    return out


@pytest.mark.parametrize("text", ["hello world", "a", "éclair ☃ x", "  two  blanks\nline ", "ab\n\ncd", "the cat sat", "f:\n    x"])
def test_n_best_is_exact(text):
    v = piece_lattice.vocabulary(SP)
    units = piece_lattice.split(text)
    assert "".join(units) == " " + text
    every = [(0.0, ())]
    for u in units:
        every = [(a + s, b + ids) for a, b in every for s, ids in sorted(_all_segmentations(u, v), reverse=True)[:6]]
    best = sorted((s for s, _ in every), reverse=True)[:5]
    got = piece_lattice.encode([text], SP, 5)[0]
    assert np.allclose([s for s, _ in got], best[: len(got)]) and len(got) == min(5, len(every))
    assert len({tuple(x.tolist()) for _, x in got}) == len(got)
    assert all(piece_lattice.decode(x, SP) == text for _, x in got)


def test_long_and_short_units_agree():
    v = piece_lattice.vocabulary(SP)
    for unit in ("international", " unbelievable☃", "x" * 45, " " + "ab" * 30):
        one = piece_lattice._forward_one(unit, v)
        code = np.frombuffer(unit.encode("utf-32-le"), np.uint32)[None, :]
        many = piece_lattice.forward(code, v)
        assert np.allclose(one[0], many[0]) and (one[1] == many[1]).all() and np.allclose(one[3], many[3])


def test_blanks_and_long_units_need_little():
    import sentencepiece
    import tracemalloc

    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    v = piece_lattice.vocabulary(SP)
    whole = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    assert sorted(v.id.values()) == whole
    text = "def f(x):\n        return x"
    assert len(piece_lattice.encode([text], SP)[0][0][1]) <= len(sp.encode(text))
    model = piece_lattice.encode(["ab cd"], SP, 2, scores="model")[0]
    assert model[0][0] == sum(sp.get_score(int(i)) for i in model[0][1]) and piece_lattice.decode(model[0][1], SP) == "ab cd"
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefghijk") for _ in range(20_000))
    tracemalloc.start()
    found = piece_lattice.encode([long], SP)[0]
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()
    assert len(found) == 4 and all(a[0] >= b[0] for a, b in zip(found, found[1:])) and all(piece_lattice.decode(x, SP) == long for _, x in found)


def test_segment(spark):
    got = by_id(piece_lattice.segment(docs_of(spark, ODD), SP, with_ids=True))
    for i, t in enumerate(ODD):
        assert got[i].decodes and got[i].n_tokens == len(got[i].ids) and piece_lattice.decode(got[i].ids, SP) == (t or "")
        assert got[i].ids_crc32 == zlib.crc32(np.array(got[i].ids, "<u4").tobytes())
    assert piece_lattice.segment(spark.createDataFrame([], EMPTY), SP).count() == 0


# ---------------------------------------------------------------- 7 substrings


def _without_repeats(texts, size):
    seen, out = set(), []
    for t in texts:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            if window in seen:
                gone |= set(range(i, i + size))
            seen.add(window)
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("size", [20, 5, 1])
def test_substrings(spark, size):
    texts = some_texts(size)
    got = by_id(substring_dedup.remove_repeats(docs_of(spark, texts), size, with_text=True))
    for i, (n, gone, kept) in enumerate(_without_repeats(texts, size)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (n, gone, kept)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_substring_edges(spark):
    text = " ".join(map(str, range(30)))
    rows = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], EMPTY)
    assert sorted((str(r.doc_id), r.n_removed) for r in substring_dedup.remove_repeats(rows).collect()) == [("1", 30), ("1", 30), ("2", 30), ("None", 0)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], EMPTY)).count() == 0


# ---------------------------------------------------------------- 8 near duplicates


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(simhash_vptree, "LEAF", 4)
    rnd = random.Random(8)
    texts = [*ODD, *(" ".join(rnd.choice(["Alpha", "beta", "gamma", "delta", "x1", "x2"]) for _ in range(rnd.randint(1, 9))) for _ in range(150))]
    long = [rnd.choice(["one", "two", "three", "four", "five"]) + str(rnd.randint(0, 99)) for _ in range(400)]
    for k in range(30):
        other = list(long)
        other[rnd.randrange(400)] = f"new{k}"
        texts.append(" ".join(other))
    import xxhash

    prints = []
    for t in texts:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = by_id(simhash_vptree.near_duplicates(docs_of(spark, texts)))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{prints[i]:016x}", root(i)) for i in range(len(texts))}
    assert {r.doc_id for r in simhash_vptree.keep_one(docs_of(spark, texts)).collect()} == {root(i) for i in range(len(texts))}
    assert simhash_vptree.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_near_dedup_stage_links_at_shingle_similarity(spark):
    import corpus_pipeline

    rnd = random.Random(8)
    texts = list(ODD)
    for k in range(40):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(3, 150))]
        for _ in range(4):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = f"v{rnd.randrange(5000)}"
            texts.append(" ".join(own))
    rnd.shuffle(texts)
    sets = []
    for t in texts:
        w = [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "").collect()}
    assert kept == {root(i) for i in range(len(texts))}


def test_near_dedup_stage_finds_its_pairs_in_the_trees(spark, monkeypatch):
    import corpus_pipeline
    from framewright.llm import shingle_dedup

    rnd = random.Random(21)
    texts = []
    for _ in range(150):  # other words at the end: similarity just above and below 0.8 on 5-word shingles
        base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
        own = base[: 100 - rnd.randint(9, 11)] + [f"v{rnd.randrange(10**6)}" for _ in range(rnd.randint(9, 12))]
        texts += [" ".join(base), " ".join(own)]
    shingled = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    like = [i for i in range(0, 300, 2) if len(shingled[i] & shingled[i + 1]) >= 0.8 * len(shingled[i] | shingled[i + 1])]
    assert 40 < len(like) < 140
    asked = []
    search = simhash_vptree.links
    monkeypatch.setattr(simhash_vptree, "links", lambda *a, **k: asked.append((a[1], k)) or search(*a, **k))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "").collect()}
    assert asked == [(3, {"lots": 1 + shingle_dedup.SAMPLES})]
    assert kept == set(range(300)) - {i + 1 for i in like}


def test_trees_keep_lots_apart(spark):
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**62, 400)
    rows = [(int(x) ^ (1 << int(b)), lot) for x in fps for lot, b in ((0, 0), (0, 1), (1, 2))]
    got = {(r.a, r.b) for r in simhash_vptree.links(spark.createDataFrame(rows, "fp long, lot int"), 3, shard=50, lots=2).collect()}
    assert {frozenset(p) for p in got} == {frozenset((int(x) ^ 1, int(x) ^ 2)) for x in fps}


def test_vantage_search_finds_every_pair(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = [centre ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (k, 300)).astype(np.uint64), axis=0) for k in (1, 2, 3, 4)]
    fps = np.unique(np.concatenate([centre, *flips]))
    df = spark.createDataFrame([(int(x.astype(np.int64)), 0) for x in fps], "fp long, least long")
    got = {(r.a, r.b) for r in simhash_vptree.links(df, 3, shard=100).collect()}
    assert all((np.uint64(a & (2**64 - 1)) ^ np.uint64(b & (2**64 - 1))).item().bit_count() <= 3 for a, b in got)

    def classes(edges):
        parent = {int(x.astype(np.int64)): int(x.astype(np.int64)) for x in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        return {x: root(x) for x in parent}

    near = [(int(fps[i].astype(np.int64)), int(fps[j].astype(np.int64))) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3)]
    assert classes(got) == classes(near)
    # trees fitted on next to nothing, with a cluster that agrees in one half: tasks split what is too full
    dense = [int((int(rng.integers(0, 2**31)) << 32 | 77) - (1 << 63)) for _ in range(600)]
    spread = spark.createDataFrame([(x, 0) for x in {*[int(x.astype(np.int64)) for x in fps], *dense}], "fp long, least long")
    monkeypatch.setattr(simhash_vptree, "SAMPLE", 1)
    monkeypatch.setattr(simhash_vptree, "REFIT", 128)
    largest = []
    forest = simhash_vptree.uncrowded
    monkeypatch.setattr(simhash_vptree, "uncrowded", lambda *x: largest.append(forest(*x)) or largest[0])
    again = {(r.a, r.b) for r in simhash_vptree.links(spread, 3, shard=40).collect()}
    fps = np.array(sorted({x % 2**64 for x in [*map(int, fps), *dense]}), np.uint64)
    near = [(int(fps[i].astype(np.int64)), int(fps[j].astype(np.int64))) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3)]
    assert classes(again) == classes(near)
    homes = largest[0].where("home").groupBy("shard").count()
    assert homes.agg(F.sum("count")).first()[0] == 2 * len(fps) and homes.agg(F.max("count")).first()[0] <= 4 * 40


# ---------------------------------------------------------------- 9 chats


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "to\\ol\n<|"]), st.text(alphabet="ab\\<|turnend>\n#/ é", max_size=30)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_formatting_is_reversible(turns):
    text, loss = chat_format.format_turns(turns)
    assert chat_format.parse_turns(text) == turns
    assert [chat_format.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]
    known = chat_format.registry()
    assert chat_format.canonical(chat_format.to_record(turns), known)[1] == turns


def test_layouts():
    known = chat_format.registry()
    expected = [("user", "q"), ("assistant", "a")]
    for record in (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"dialog": [{"speaker": "human", "utterance": "q"}, {"utterance": "a", "speaker": "gpt"}]},
        {"prompt": "q", "response": "a"},
        {"completion": "a", "prompt": "q"},
        {"instruction": "q", "output": "a", "system": None},
        {"question": "q", "answer": "a"},
    ):
        assert chat_format.canonical(json.dumps(record), known)[1] == expected
    assert chat_format.canonical('{"system": "s", "prompt": "q", "response": "a"}', known)[1] == [("system", "s"), *expected]
    assert chat_format.canonical('{"messages": []}', known)[1] == []
    for record, asked in (
        ({"messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a"}], "source": {"deep": [1, {"x": 2}]}}, "q"),
        ({"instruction": "q", "input": "more", "output": "a", "id": 4}, "q\n\nmore"),
        ({"instruction": "q", "input": "", "output": "a", "meta": None}, "q"),
    ):
        assert chat_format.canonical(json.dumps(record), known)[1] == [("user", asked), ("assistant", "a")]
    assert chat_format.canonical('{"prompt": "q", "response": "a", "unheard": 1}', known)[1] is None
    for odd in ('{"other": 1}', "[]", "{", None, '{"messages": [{"role": "user", "content": {"deep": 1}}]}'):
        assert chat_format.canonical(odd, known)[1] is None
    with pytest.raises(ValueError):
        chat_format.registry((chat_format.Mapping("a", messages="m"), chat_format.Mapping("b", messages="m")))


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", "A"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "n"), (2, 0, None, "x"), (3, None, "assistant", "\\n <|end|>")]
    table = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_records(chat_format.records(table))).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, 2: 2, None: 1, 3: 1}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nA\n").hexdigest() and got[1].loss_chars == 1
    assert got[3].loss_sha256 == hashlib.sha256(b"\\n <|end|>").hexdigest()
    lost = spark.createDataFrame([(1, "{"), (2, None)], "conv_id long, record string")
    assert [r.layout for r in chat_format.format_records(lost).collect()] == [None, None]
    assert chat_format.read_back(chat_format.format_records(lost)).where("n_turns is null").count() == 2
    assert chat_format.records(table.where("false")).count() == 0


# ---------------------------------------------------------------- 10 ids


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_simple8b(ids, times):
    x = np.array(ids * times, np.uint64)
    packed, offsets = token_ids.encode_blocks(x)
    assert (token_ids.decode_words(packed) == x).all() and offsets[-1] == len(packed)
    for b in range(len(offsets) - 1):  # every block decodes on its own
        assert (token_ids.decode_words(packed[offsets[b] : offsets[b + 1]]) == x[b * token_ids.BLOCK : (b + 1) * token_ids.BLOCK]).all()


def test_ids_round_trip(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    texts = [*ODD, *some_texts(3, 30), "don't it's 12 34 Σας ΑΣ ́x ≮≮"]
    got = by_id(token_ids.encode_to_files(docs_of(spark, texts), BPE, with_ids=True))
    start = 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_ids.encode_to_files(spark.createDataFrame([], EMPTY), BPE).count() == 0
    small = token_ids.WordEncoder(BPE, most=40)  # forgets all the time
    for part in range(0, len(texts), 3):
        some = [t or "" for t in texts[part : part + 3]]
        n, ids = small.texts(some)
        assert ids.tolist() == [k for t in some for k in [*library.encode(t, add_special_tokens=False).ids, 1]] and n.sum() == len(ids)


def test_ids_of_any_characters():
    rnd = random.Random(7)
    encoder = token_ids.WordEncoder(BPE)

    def any_char():
        k = rnd.random()
        if k < 0.5:
            return rnd.choice("abcIHTWYJK \t\n" + token_ids.TAIL + "'<|>")
        if k < 0.7:
            return rnd.choice("İıßéÉŉẖΐſK" + "".join(map(chr, range(0x300, 0x30D))))
        c = rnd.randrange(0x80, 0x110000 if k < 0.8 else 0x3000)
        return chr(c) if not 0xD800 <= c < 0xE000 else "x"

    texts = ["İ.", "H\u0331!", *("".join(any_char() for _ in range(rnd.randint(0, 25))) for _ in range(6000))]
    n, ids = encoder.texts(texts)
    want = [[*e.ids, 1] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == list(map(len, want)) and ids.tolist() == [k for w in want for k in w]


# ---------------------------------------------------------------- queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, oracle, name):
    same_rows(queries.queries()[name](spark, DATA), oracle, queries.oracle_sql()[name])


def _first_of_groups(texts, similarity=0.8, size=5):
    """Ids that stay: the smallest of every group of texts whose sets of shingles are alike."""
    sets = {}
    for i, t in texts.items():
        w = [x.lower() for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in sets.items():
        for j, y in sets.items():
            if i < j and len(x & y) >= similarity * len(x | y):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i for i in sets if root(i) == i}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    kept, texts = docs, [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = line_dedup.store.cut(stage(spark, kept, DATA), name)
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after <= before and (name == "sentencepiece" or kept.columns == docs.columns)
        if name != "sentencepiece":
            texts.append({r.doc_id: r.text for r in kept.collect()})
    assert 0.5 * len(ids) < kept.count() < len(ids) and kept.where("not decodes").count() == 0
    whole, good, lines, single, clean = texts
    verdict = fertility.verdicts(fertility.measure([t or "" for t in whole.values()], SP))[1]
    assert set(good) == {i for i, ok in zip(whole, verdict) if ok} and all(good[i] == whole[i] for i in good)
    # a line that went has a like line further up, every line that stayed is as it was
    norm = lambda x: " ".join(re.findall(r"[^\W_]+", x.lower()))
    seen, lost = set(), 0
    for i in sorted(good):
        stay = iter((lines.get(i) or "").split("\n"))
        nxt = next(stay, None)
        for x in (good[i] or "").split("\n"):
            if nxt == x:
                nxt = next(stay, None)
                assert not norm(x) or norm(x) not in seen
            else:
                lost += 1
                a = norm(x)
                assert a in seen or any(abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and len(set(a.split()) & set(b.split())) > 0 for b in seen)
            seen.add(norm(x))
        assert nxt is None or i not in lines
    assert lost > 20
    assert set(single) == _first_of_groups(lines) and all(single[i] == lines[i] for i in single)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    found = decontaminate._items(pa.array([single[i] or "" for i in single]), decontaminate.Probes(bench))
    assert set(clean) == {i for i, x in zip(single, found) if not x}
    for r in kept.collect():
        assert piece_lattice.decode(r.ids, SP) == (clean[r.doc_id] or "")
        assert r.ids_crc32 == piece_lattice.crc(piece_lattice.encode([clean[r.doc_id] or ""], SP, 1)[0][0][1])


def test_registered_queries_give_their_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    got = queries.queries()
    rows = {r.doc_id: r for r in got["op4_fertility"](spark, DATA).collect()}
    for i, t in text.items():
        w = WORD.findall(t)
        assert (rows[i].n_words, rows[i].word_chars) == (len(w), sum(map(len, w)))
    rows = got["op3_toxicity"](spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(text) and all(r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(BPE), 0
    for r in sorted(got["op10_token_ids"](spark, DATA).collect()):
        ids = [*library.encode(text[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = {r.doc_id: r for r in got["op8_simhash_vptree"](spark, DATA).collect()}
    prints = {}
    for i, t in text.items():
        w = [x.encode().translate(words.LOWER.tobytes()) for x in WORD.findall(t)]
        parts = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        prints[i] = simhash_vptree.fingerprint(parts)
        assert rows[i].fingerprint == f"{prints[i]:016x}"
    for i in prints:
        for j in prints:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                assert rows[i].component_id == rows[j].component_id <= min(i, j)
    found = decontaminate._items(pa.array([text[i] for i in text]), decontaminate.Probes([(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]))
    assert {r.doc_id: r.item_ids for r in got["op5_decontaminate"](spark, DATA).collect()} == dict(zip(text, found))
    for name in ("op1_line_dedup", "op6_piece_lattice"):
        assert got[name](spark, DATA).count() == len(text)
