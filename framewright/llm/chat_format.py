"""Chat records of any layout, formatted for training, by schema fingerprints.

A record is a JSON object.  Its *schema* is the set of its nested field paths (array
elements share one path); the hash of the sorted paths selects a declarative mapping that
says where the turns are.  A mapping is data: either the path of a list of messages with
the names of its role and text fields, or an ordered list of (role, field) pairs, with role
names to translate.  Fields that may be missing give one fingerprint for each combination.
Fields that say nothing about the turns (IGNORABLE, with all below them) are left out of a
schema, unless a mapping names them.

Turns are written as ``<|turn|>role``, a line feed, the text, ``<|end|>`` and a line feed.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can
hold a control string and reading back is exact.  The loss mask is a list of character
spans over the formatted text: the text of each assistant turn.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

TURN, END = "<|turn|>", "<|end|>"
_UNESCAPE = re.compile(r"\\([\\|n])")


@dataclass(frozen=True)
class Mapping:
    """How a layout's fields become turns."""

    name: str
    messages: str | None = None  # the field with the list of messages
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str | tuple[str, ...]], ...] = ()  # (role, field or fields to put one below the other), in turn order
    optional: tuple[str, ...] = ()  # top-level fields that may be missing
    roles: tuple[tuple[str, str], ...] = ()  # role name -> canonical role

    def paths(self) -> set[str]:
        if self.messages:
            return {self.messages, f"{self.messages}[]", f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"}
        return {f for _, fields in self.fields for f in _several(fields)}

    def schemas(self) -> list[frozenset[str]]:
        """Field paths of the layout with and without each optional field."""
        extra = [o for o in self.optional if o not in self.paths()]
        base = self.paths() - set(self.optional)
        free = [o for o in self.optional if o not in extra] + extra
        return [frozenset(base | set(chosen)) for n in range(len(free) + 1) for chosen in combinations(free, n)]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        names = dict(self.roles)
        if self.messages:
            found = [(m.get(self.role), m.get(self.text)) for m in record[self.messages]]
        else:
            found = [(r, _joined([record[f] for f in _several(fields) if f in record])) for r, fields in self.fields if any(f in record for f in _several(fields))]
            found = [(r, t) for r, t in found if t is not None or r != "system"]
        return [(names.get(r, r) if isinstance(r, str) else "", _text(t)) for r, t in found]


def _several(fields: str | tuple[str, ...]) -> tuple[str, ...]:
    return (fields,) if isinstance(fields, str) else fields


def _joined(values: list):
    """One value as it is; of several the texts that aren't empty, a blank line between them."""
    return values[0] if len(values) == 1 else "\n\n".join(t for t in map(_text, values) if t)


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


_SHARE = (("human", "user"), ("gpt", "assistant"))
MAPPINGS = (
    Mapping("messages", messages="messages"),
    Mapping("conversations", messages="conversations", role="from", text="value", roles=_SHARE),
    Mapping("dialog", messages="dialog", role="speaker", text="utterance", roles=_SHARE),
    Mapping("prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")), optional=("system",)),
    Mapping("task", fields=(("system", "system"), ("user", ("instruction", "input")), ("assistant", "output")), optional=("system",)),
    Mapping("question", fields=(("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
)


#: Fields that tell about a record or a message, never what is said
IGNORABLE = frozenset({"id", "source", "name", "model", "created", "timestamp", "lang", "language", "category", "tags", "score", "weight", "metadata", "meta"})


def schema_paths(value, named: frozenset[str] = frozenset()) -> set[str]:
    """The field paths that make a record's schema: without ignorable fields that no mapping names."""
    skip = IGNORABLE - named
    return {p for p in field_paths(value) if not any(part.rstrip("[]") in skip for part in p.split("."))}


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of all fields below a JSON value; iterative, so depth is no limit."""
    out: set[str] = set()
    todo = [(value, prefix)]
    while todo:
        value, at = todo.pop()
        if isinstance(value, dict):
            for k, v in value.items():
                path = f"{at}.{k}" if at else k
                out.add(path)
                todo.append((v, path))
        elif isinstance(value, list):
            for v in value:
                out.add(f"{at}[]")
                todo.append((v, f"{at}[]"))
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint -> mapping; two layouts with one schema are an error."""
    out: dict[str, Mapping] = {}
    for m in mappings:
        for schema in m.schemas():
            if out.setdefault(fingerprint(schema), m) is not m:
                raise ValueError(f"{m.name} has a schema of {out[fingerprint(schema)].name}")
    for m in mappings:  # a record without messages
        if m.messages:
            out.setdefault(fingerprint({m.messages}), m)
    return out


def named_fields(known: dict[str, Mapping]) -> frozenset[str]:
    """Field names that the mappings use."""
    return frozenset(part.rstrip("[]") for m in set(known.values()) for p in m.paths() for part in p.split("."))


def canonical(record: str, known: dict[str, Mapping], named: frozenset[str] | None = None) -> tuple[str, list[tuple[str, str]] | None]:
    """(fingerprint, turns) of a JSON record; None if no mapping has its schema."""
    try:
        value = json.loads(record)
    except (TypeError, ValueError):
        return "", None
    if not isinstance(value, dict):
        return "", None
    print_ = fingerprint(schema_paths(value, named_fields(known) if named is None else named))
    mapping = known.get(print_)
    return print_, mapping.turns(value) if mapping else None


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss spans)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role).replace(chr(10), chr(92) + 'n')}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    out = []
    for part in formatted.split(TURN)[1:]:
        head, _, body = part.partition("\n")
        out.append((unescape(head), unescape(body[: body.rindex(END)])))
    return out


def to_record(turns: list[tuple[str, str | None]]) -> str:
    """A conversation as a record, in the plainest layout that holds it whole."""
    roles = [r for r, _ in turns]
    put = lambda names: json.dumps(dict(zip(names, (t for _, t in turns))), ensure_ascii=False)
    if roles == ["user", "assistant"]:
        return put(["prompt", "response"])
    if roles == ["system", "user", "assistant"] and turns[0][1] is not None:
        return put(["system", "instruction", "output"])
    back = {v: k for k, v in _SHARE}
    if turns and roles[0] == "user" and all(r in back for r in roles):
        return json.dumps({"conversations": [{"from": back[r], "value": t} for r, t in turns]}, ensure_ascii=False)
    return json.dumps({"messages": [{"role": r, "content": t} for r, t in turns]}, ensure_ascii=False)


def records(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): the rows (conv_id, turn, role, text) of each conversation as one JSON record.

    Rows go by turn (null first), then role and text.  A null role is an empty one.  A
    conversation is one training text, so its rows meet in one task by nature.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.col("text").cast("string").alias("text"))
    rows = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def pack(batches):
        for batch in batches:
            made = [to_record([(t["role"], t["text"]) for t in turns]) for turns in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["conv_id", "record"])

    store.arrow_limits(conversations.sparkSession)
    return rows.mapInArrow(pack, "conv_id long, record string")


def format_records(table: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """(conv_id, schema, layout, formatted, loss) of each row (conv_id, record).

    Records whose schema no mapping has, null and broken records keep a row with null
    layout, formatted text and loss.
    """

    def run(batches):
        known = registry(mappings)
        named = named_fields(known)
        spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = []
            for record in batch.column(1).to_pylist():
                print_, turns = canonical(record, known, named)
                text, loss = format_turns(turns) if turns is not None else (None, None)
                rows.append((print_, known[print_].name if turns is not None else None, text, loss and [{"begin": a, "end": b} for a, b in loss] if loss else loss))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), spans))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["conv_id", "schema", "layout", "formatted", "loss"])

    store.arrow_limits(table.sparkSession)
    return table.select("conv_id", "record").mapInArrow(run, "conv_id long, schema string, layout string, formatted string, loss array<struct<begin: long, end: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and their loss masks say."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None:
                    rows.append((None,) * 5)
                    continue
                turns = parse_turns(text)
                all_turns = "".join(chain.from_iterable((r, "\n", t, "\n") for r, t in turns))
                learnt = "".join(unescape(text[s["begin"] : s["end"]]) for s in loss or [])
                digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
                rows.append((len(turns), digest(all_turns), len(learnt), digest(learnt), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
