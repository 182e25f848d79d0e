"""Chat formatting by schema fingerprints.

Records (JSON) come in many layouts: message lists, role and value pairs, instructions,
prompts and responses. A record's fingerprint is the hash of its sorted nested field paths.
Each layout is declared once, as paths and the turns they make; its possible fingerprints are
listed in a table, and a record takes the layout of its fingerprint. Nothing is guessed: a
record with unknown paths keeps its row, with its fingerprint and without layout or turns, so
that a layout can be declared for it.

Canonical turns are written as ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles
and texts (those of this template and of other public chat formats) are broken up by a
backslash after their first character, and backslashes are doubled, so that ``read_back``
restores every text exactly. ``loss_spans`` are the UTF-8 byte ranges of the assistant's texts.

Null roles and texts are empty. A record that is null or no JSON object has no layout. Turns
with equal numbers are ordered by role, then text. A conversation is one record, so its turns
meet in one row; conversations are spread over the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import others, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this template and of public chat formats; each starts with < or [.
CONTROL = [TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>", "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>",
           "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>"]
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)
LEARNED = {"assistant"}


def escape(s: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", s.replace("\\", "\\\\"))


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1", s)


@dataclass(frozen=True)
class Layout:
    """Paths of a layout, and how they make turns.

    Either a list of turns (``items``, with the fields ``role``, ``text`` and perhaps ``order``;
    ``roles`` translates role names) or one turn for each (role, field) of ``fields``, where
    fields of one role in a row are joined by an empty line. ``optional`` paths may be missing."""
    name: str
    items: str | None = None
    role: str = "role"
    text: str = "content"
    parts: str | None = None            # the text is a list of parts with this field
    order: str | None = None
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def required(self) -> list[frozenset[str]]:
        if self.items is None:
            return [frozenset(f for _, f in self.fields) - frozenset(self.optional)]
        inner = {f"{self.items}[]", *(f"{self.items}[].{f}" for f in (self.role, self.text, self.order) if f)}
        if self.parts:
            text = f"{self.items}[].{self.text}[]"
            inner |= {text, f"{text}.{self.parts}", f"{text}.type"}
        return [frozenset({self.items} | inner), frozenset({self.items})]     # the second: an empty list

    def path_sets(self) -> Iterator[frozenset[str]]:
        for base in self.required():
            for k in range(len(self.optional) + 1):
                for extra in combinations(self.optional, k):
                    yield base | frozenset(extra)

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.items is not None:
            names = dict(self.roles)
            items = record[self.items]
            if self.order:
                items = sorted(items, key=lambda t: (t[self.order] is not None, t[self.order] or 0))
            return [(names.get(t[self.role], _text(t[self.role])), self._content(t[self.text])) for t in items]
        out: list[tuple[str, str]] = []
        for role, field in self.fields:
            if field not in record:
                continue
            if out and out[-1][0] == role:
                if record[field]:
                    out[-1] = (role, f"{out[-1][1]}\n\n{_text(record[field])}")
            else:
                out.append((role, _text(record[field])))
        return out

    def _content(self, value) -> str:
        return "".join(_text(p[self.parts]) for p in value) if self.parts else _text(value)


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


SHAREGPT_ROLES = (("human", "user"), ("gpt", "assistant"))
LAYOUTS = (
    Layout("messages", items="messages", optional=("id", "source")),
    Layout("message parts", items="messages", parts="text", optional=("id", "source")),
    Layout("from and value", items="conversations", role="from", text="value", roles=SHAREGPT_ROLES, optional=("id", "system_id")),
    Layout("numbered turns", items="turns", text="text", order="turn", optional=("conv_id",)),
    Layout("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
           optional=("system", "input")),
    Layout("prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
)


def paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value; ``[]`` stands for the items of a list."""
    out, todo = set(), [(value, prefix)]
    while todo:
        v, at = todo.pop()
        if isinstance(v, dict):
            for k, x in v.items():
                name = re.sub(r"([\\.\[])", r"\\\1", k)
                out.add(below := f"{at}.{name}" if at else name)
                todo.append((x, below))
        elif isinstance(v, list):
            if v:
                out.add(f"{at}[]")
            todo += [(x, f"{at}[]") for x in v]
    return out


def fingerprint(path_set) -> str:
    return hashlib.sha256("\n".join(sorted(path_set)).encode()).hexdigest()[:32]


def fingerprints(layouts=LAYOUTS) -> dict[str, Layout]:
    """The layout of every fingerprint that the layouts allow; two layouts may not share one with turns."""
    known: dict[str, Layout] = {}
    for layout in layouts:
        for p in layout.path_sets():
            other = known.setdefault(fingerprint(p), layout)
            if other is not layout and other.items != layout.items:
                raise ValueError(f"layouts {other.name} and {layout.name} have the same paths")
    return known


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The turns as one string, and the byte ranges of the learned texts in it."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        at += len(head.encode())
        size = len(body.encode())
        if role in LEARNED:
            spans.append((at, at + size))
        at += size + len(END)
        pieces += [head, body, END]
    return "".join(pieces), spans


def read_back(s: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    out = []
    for turn in s.split(END)[:-1]:
        role, _, text = turn.removeprefix(TURN).partition(TEXT)
        out.append((unescape(role), unescape(text)))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def format_chat(records: DataFrame, *, record: str = "record", layouts=LAYOUTS, prefix: str = "chat_") -> DataFrame:
    """``records`` without the JSON column, with ``{prefix}fingerprint``, ``layout``, ``turns``, ``formatted`` and
    ``loss_spans`` (old columns of these names go)."""
    names = [prefix + c for c in ("fingerprint", "layout", "turns", "formatted", "loss_spans")]
    keep = others(records, (record, *names))
    known = fingerprints(layouts)
    n = len(keep)
    types = ["string", "string", "array<struct<role:string,text:string>>", "string", "array<struct<start:bigint,end:bigint>>"]
    schema = records.select(*keep, *(F.lit(None).cast(t).alias(c) for c, t in zip(names, types))).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in names]
            for raw in b.column(n).to_pylist():
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                mark = fingerprint(paths(value)) if isinstance(value, dict) else None
                layout = known.get(mark)
                turns = layout.turns(value) if layout else None
                s, spans = formatted(turns) if layout else (None, None)
                row = (mark, layout and layout.name, turns and [{"role": r, "text": t} for r, t in turns] or ([] if layout else None),
                       s, spans and [{"start": x, "end": y} for x, y in spans] or ([] if layout else None))
                for col, v in zip(columns, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(n)),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), _TURNS, pa.string(), _SPANS)))],
                names=[*keep, *names])

    return records.select(*keep, record).mapInArrow(rows, schema)


def conversation_records(rows: DataFrame) -> DataFrame:
    """conv_id and one JSON record for each conversation of (conv_id, turn, role, text) rows.

    Corpora store conversations by shape, and so do these records: a lone exchange as an
    instruction, one with a system text as prompt and response, longer ones as a message list if
    they open with a system text, else as from and value pairs; other roles as numbered turns."""
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    roles = F.transform("t", lambda t: F.coalesce(t["role"], F.lit("?")))

    def json_of(c: Column) -> Column:
        return F.to_json(c, {"ignoreNullFields": "false"})

    def text(i: int) -> Column:
        return F.get(F.col("t"), F.lit(i))["text"]

    renamed = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"), F.lit("system"), F.lit("system"))
    usual = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    record = F.when(F.array_join(roles, " ") == "user assistant",
                    json_of(F.struct(text(0).alias("instruction"), text(1).alias("output")))) \
        .when(F.array_join(roles, " ") == "system user assistant",
              json_of(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response")))) \
        .when(usual & (roles[0] == "system"),
              json_of(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))) \
        .when(usual, json_of(F.struct(F.transform("t", lambda t: F.struct(
            F.try_element_at(renamed, t["role"]).alias("from"), t["text"].alias("value"))).alias("conversations")))) \
        .otherwise(json_of(F.struct("conv_id", F.col("t").alias("turns"))))
    return turns.select("conv_id", record.alias("record"))


def read_back_digests(chats: DataFrame) -> DataFrame:
    """conv_id and digests of what the formatted strings and loss spans hold."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for s, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                turns = read_back(s or "")
                raw = (s or "").encode()
                learned = "".join(unescape(raw[x["start"]:x["end"]].decode()) for x in spans or ())
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                for col, v in zip(out, (len(turns), _hex(said), len(learned), _hex(learned), len(s or ""))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string() if i % 2 else pa.int64()) for i, c in enumerate(out))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = chats.schema["conv_id"].dataType.simpleString()
    return chats.select("conv_id", "chat_formatted", "chat_loss_spans").mapInArrow(
        rows, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _hex(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


PROBE = "</s>[INST] ok [/INST]"


def op1_chat_fingerprints(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one more (-7) whose texts look like another template's marks."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return read_back_digests(format_chat(conversation_records(rows.union(probe))))


def oracle_sql() -> str:
    """The same from the rows themselves, in DuckDB."""
    def longer(x: str) -> str:
        control = " + ".join(f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in CONTROL)
        return f"length({x}) + length({x}) - length(replace({x}, '\\', '')) + {control}"

    return f"""
WITH r AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r.role NULLS FIRST, r.text NULLS FIRST) AS i FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS learned,
         sum({len(TURN + TEXT + END)} + {longer('role')} + {longer('text')})::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars FROM g"""
