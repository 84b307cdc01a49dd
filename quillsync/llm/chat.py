"""Chat formatting: records of unlike layouts become canonical turns and one template.

1. A record (JSON) is named by its schema fingerprint: a hash of its sorted nested
   field paths, where a list adds ``[]`` and fields without a value count too.
   The fingerprint selects a declarative mapping from ``LAYOUTS``; a record
   whose fingerprint is unknown, or that is not JSON, keeps one row with a null
   role and the layout ``unknown`` or ``malformed``.
2. Every turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control
   strings in texts are broken by a backslash after their first character and
   backslashes are doubled, so no text can hold a mark and ``unescape`` gives
   the text back.  The loss mask covers the texts of assistant turns.
3. ``read_back`` parses formatted turns into the conversation's figures.

Turns of a conversation stream through a task in order (sorted by Spark, which
spills) and are never collected, so a conversation of any length needs no more
memory than a batch; its digest is sequential by definition, so one
conversation is read by one task.

Null text: empty.  Null role: the empty role.  Rows with a null conversation
form one conversation.  Turns with equal numbers are ordered by position in
their record, role and text; null numbers come first; repeated rows are
repeated turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"

# control strings of this and other usual templates: fixed values
_CONTROL = re.compile(r"(?=<\||\|>|\[/?INST\]|</?s>|<</?SYS>>)(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(STOP), re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    """As ``escape``, and on one line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


# --- schema fingerprints ---------------------------------------------------

def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value."""
    if isinstance(value, dict):
        found = {f"{at}.{k}" for k in value}
        for k, v in value.items():
            found |= paths(v, f"{at}.{k}")
        return found
    if isinstance(value, list):
        return {f"{at}[]"}.union(*(paths(v, f"{at}[]") for v in value))
    return set()


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def _layout(name: str, fields: str, turns: list[tuple[str, str, str]], roles: dict | None = None) -> dict:
    """fields: all paths.  turns: (path of a list or "", role path or "=role", text path)."""
    return {"name": name, "fields": set(fields.split()), "turns": turns, "roles": roles or {}}


#: Declarative mappings; a layout with optional fields is declared once for each set of paths.
LAYOUTS = [
    _layout("messages", ".messages .messages[] .messages[].role .messages[].content",
            [(".messages[]", ".role", ".content")]),
    _layout("share", ".conversations .conversations[] .conversations[].from .conversations[].value",
            [(".conversations[]", ".from", ".value")],
            {"human": "user", "gpt": "assistant", "system": "system"}),
    _layout("system", ".system", [("", "=system", ".system")]),
    _layout("prompt", ".prompt", [("", "=user", ".prompt")]),
    _layout("response", ".response", [("", "=assistant", ".response")]),
    _layout("prompt_response", ".prompt .response", [("", "=user", ".prompt"), ("", "=assistant", ".response")]),
    _layout("system_prompt_response", ".system .prompt .response",
            [("", "=system", ".system"), ("", "=user", ".prompt"), ("", "=assistant", ".response")]),
    _layout("instruction", ".instruction", [("", "=user", ".instruction")]),
    _layout("output", ".output", [("", "=assistant", ".output")]),
    _layout("instruction_output", ".instruction .output",
            [("", "=user", ".instruction"), ("", "=assistant", ".output")]),
    _layout("instruction_input_output", ".instruction .input .output",
            [("", "=user", ".instruction+.input"), ("", "=assistant", ".output")]),
    _layout("nested", ".turn .turn.speaker .turn.speaker.kind .turn.body .turn.body.text",
            [("", ".turn.speaker.kind", ".turn.body.text")]),
    _layout("flat", ".role .text", [("", ".role", ".text")]),
]
_KNOWN = {fingerprint(x["fields"]): x for x in LAYOUTS}


def _get(value, path: str):
    for k in path.split(".")[1:]:
        value = value.get(k) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(payload: str | None) -> tuple[str, str, list[tuple[str, str]]]:
    """(fingerprint, layout name, [(role, text)]) of one record."""
    try:
        value = json.loads(payload) if payload is not None else None
    except (ValueError, RecursionError):
        return "", "malformed", []
    if not isinstance(value, dict):
        return "", "malformed", []
    mark = fingerprint(paths(value))
    layout = _KNOWN.get(mark)
    if layout is None:
        return mark, "unknown", []
    out = []
    for each, role, text in layout["turns"]:
        for item in _get(value, each[:-2]) if each else [value]:
            name = role[1:] if role[0] == "=" else _text(_get(item, role))
            parts = [_text(_get(item, p)) for p in text.split("+")]
            out.append((layout["roles"].get(name, name), "\n\n".join(p for p in parts if p)))
    return mark, layout["name"], out


def canonical(records: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """(keys..., seq, layout, fingerprint, role, text): the turns of JSON records; no shuffle."""
    rows = records.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{payload}`").cast("string").alias("__payload"))
    schema = rows.drop("__payload").schema.add("seq", "long").add("layout", "string") \
        .add("fingerprint", "string").add("role", "string").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, seq, out = [], [], []
            for i, p in enumerate(b.column("__payload").to_pylist()):
                mark, name, turns = turns_of(p)
                for j, (role, text) in enumerate(turns or [(None, None)]):
                    at.append(i)
                    seq.append(j)
                    out.append((name, mark, role, text))
            kept = b.take(pa.array(at, pa.int64()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(c) for c in range(len(keys))), pa.array(seq, pa.int64()),
                 *(pa.array(c, pa.string()) for c in cols)],
                names=[*keys, "seq", "layout", "fingerprint", "role", "text"])

    return rows.mapInArrow(run, schema)


# --- template --------------------------------------------------------------

def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and the part of it under the loss mask [from, to)."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    loss = len(body) if role == LOSS_ROLE else 0
    return head + body + STOP, len(head), len(head) + loss


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` (any rows with role and text) with ``formatted``, ``loss_from`` and
    ``loss_to`` (code points in that turn's string); a null role gives a null string.
    A conversation's string is its turns' strings, one after the other."""
    @F.pandas_udf("formatted string, loss_from long, loss_to long")
    def write(role, text):
        import pandas as pd
        rows = [format_turn(r, t or "") if r is not None else (None, 0, 0) for r, t in zip(role, text)]
        return pd.DataFrame(rows, columns=["formatted", "loss_from", "loss_to"])

    return turns.withColumn("__f", write("role", "text")).select(
        *turns.columns, "__f.formatted", "__f.loss_from", "__f.loss_to")


RESULT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


class _Conversation:
    def __init__(self, key):
        self.key, self.turns, self.loss, self.chars = key, 0, 0, 0
        self.sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, start: int, stop: int) -> None:
        self.chars += len(text)
        for m in _TURN.finditer(text):
            self.turns += 1
            self.sha.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
        masked = unescape(text[start:stop])
        self.loss += len(masked)
        self.loss_sha.update(masked.encode())

    def row(self):
        return (self.key, self.turns, self.sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.chars)


def read_back(pieces: DataFrame, conv: str = "conv_id", order: tuple[str, ...] = ("turn", "seq")) -> DataFrame:
    """Figures of each conversation, parsed from its formatted turns."""
    spark = pieces.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.where("formatted IS NOT NULL").select(
        F.col(conv).cast("long").alias("conv_id"), *order, "formatted", "loss_from", "loss_to")
    dealt = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order, "formatted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for b in batches:
            for key, text, start, stop in zip(*(b.column(c).to_pylist() for c in
                                                ("conv_id", "formatted", "loss_from", "loss_to"))):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(key)
                now.add(text, start, stop)
            if done:
                yield _rows(done)
                done = []
        if now is not None:
            yield _rows([now.row()])

    return dealt.mapInArrow(run, RESULT)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in RESULT.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)],
                                      names=[f for f, _ in fields])


# --- the table of conversations as records of several layouts ----------------

def as_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, payload): every row of a flat table as a JSON record, in a
    layout chosen by its conversation and turn; a role that a layout cannot
    express uses the message layout."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = role.isin("user", "assistant", "system")
    pick = F.when(plain, F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5))).otherwise(0)

    def record(**fields):
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    def by_role(user: str, assistant: str):
        return F.when(role == "user", record(**{user: text})).when(
            role == "assistant", record(**{assistant: text})).otherwise(record(system=text))

    other = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise("system")
    payload = (
        F.when(pick == 0, record(messages=F.array(F.struct(role.alias("role"), text.alias("content")))))
        .when(pick == 1, record(conversations=F.array(F.struct(other.alias("from"), text.alias("value")))))
        .when(pick == 2, by_role("prompt", "response"))
        .when(pick == 3, by_role("instruction", "output"))
        .otherwise(record(turn=F.struct(F.struct(role.alias("kind")).alias("speaker"),
                                        F.struct(text.alias("text")).alias("body")))))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), payload.alias("payload"))
