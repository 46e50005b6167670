"""Chat formatting with typed content parts (operator 3).

A message is a list of parts: text, image, audio or document. A visitor flattens
them into one string with an ordered placeholder per attachment, and records the
attachment's reference and the number of tokens it will expand to. Turns look like

    <|turn|>role
    body<|end|>

Control strings inside texts and roles are broken by a backslash after their first
character (a backslash of the text is doubled), so they can neither end a turn nor
pass for a placeholder, and taking the backslashes out again gives back the text.
Neighbouring text parts are escaped as one, for a control string may span them.
The loss covers the assistant's text, neither the marks around it nor placeholders.

Formatting and reading back stream over conversations sorted within partitions: a
conversation is never gathered, however long it is.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, partitions

TURN, END = "<|turn|>", "<|end|>"
_LAST = END + "\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
LEARNED = "assistant"
PATCH, MAX_PATCHES = 28, 1280  # pixels a side of an image token; tokens an image has at most
AUDIO_RATE, PAGE_TOKENS = 25, 512  # tokens a second of audio and a page of a document

# Strings that this template or public models use as marks.
CONTROLS = (
    TURN, END, *PLACEHOLDERS.values(), "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
)

_STARTS = re.compile(r"(\\)|(?=" + "|".join(map(re.escape, CONTROLS)) + r")(.)", re.DOTALL)
_HEAD = re.compile(r"(?:[^\\\n]|\\.)*\n", re.DOTALL)  # up to a line feed without a backslash before it


def escape(text: str) -> str:
    """Double backslashes and put one behind the first character of every control string."""
    return _STARTS.sub(lambda m: "\\\\" if m[1] else m[2] + "\\", text)


def unescape(text: str) -> str:
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        out.append(text[at:found])
        if text[found + 1 : found + 2] == "\\":
            out.append("\\")
            at = found + 2
        else:
            at = found + 1
    return "".join(out) + text[at:]


@dataclass
class Flattener:
    """Visits the parts of one message in order; ``finish`` ends it."""

    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)  # where texts stand in the body
    run: list[str] = field(default_factory=list)  # text parts since the last attachment
    size: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.run.append(part.get("text") or "")

    def finish(self) -> str:
        self._end_run()
        return "".join(self.body)

    def visit_image(self, part: dict) -> None:
        wide, high = (max(part.get(side) or PATCH, 1) for side in ("width", "height"))
        self._attach("image", part, min(math.ceil(wide / PATCH) * math.ceil(high / PATCH), MAX_PATCHES))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * PAGE_TOKENS)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"unknown kind of content part: {part.get('kind')}")

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._end_run()
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "place": self.size, "tokens": tokens})
        self._put(PLACEHOLDERS[kind])

    def _end_run(self) -> None:
        text = escape("".join(self.run))
        self.run.clear()
        if text:
            self.texts.append((self.size, self.size + len(text)))
            self._put(text)

    def _put(self, piece: str) -> None:
        self.body.append(piece)
        self.size += len(piece)


def segment(role: str, parts: list[dict]) -> tuple[str, list[dict], list[dict]]:
    """A formatted turn, where its texts stand, and its attachments (places count from the segment's start)."""
    flat = Flattener()
    for part in parts:
        flat.visit(part)
    body = flat.finish()
    head = TURN + escape(role).replace("\n", "\\\n") + "\n"
    for one in flat.attachments:
        one["place"] += len(head)
    texts = [{"start": len(head) + a, "end": len(head) + b} for a, b in flat.texts]
    return head + body + END + "\n", texts, flat.attachments


def read_segment(text: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders stay as they are."""
    inner = text[len(TURN) : -len(END) - 1]
    head = _HEAD.match(inner).end()
    return unescape(inner[: head - 1]), unescape(inner[head:])


class Reader:
    """Reads turns back from a formatted conversation by its marks alone, however it is cut into pieces."""

    def __init__(self) -> None:
        self.rest, self.seen = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        while (end := self.rest.find(_LAST, self.seen)) >= 0:
            end += len(_LAST)
            turn, self.rest, self.seen = self.rest[:end], self.rest[end:], 0
            if not turn.startswith(TURN):
                raise ValueError("a turn has no beginning")
            yield read_segment(turn)
        self.seen = max(len(self.rest) - len(_LAST) + 1, 0)

    def finish(self) -> None:
        if self.rest:
            raise ValueError("a turn has no end")


TURNS = (
    "conv_id bigint, turn bigint, place bigint, role string, segment string, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<kind:string,ref:string,place:int,tokens:int>>, attachment_tokens bigint"
)


def _formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in TURNS.split(", ")]
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int32()), ("tokens", pa.int32())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), spans, kinds, pa.int64()]
    now, place = object(), 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv_id"] != now:
                now, place = row["conv_id"], 0
            role = row["role"] or ""
            parts = row["parts"] or [{"kind": "text", "text": row["text"]}]
            text, texts, attached = segment(role, parts)
            loss = texts if role == LEARNED else []
            tokens = sum(a["tokens"] for a in attached)
            out.append((row["conv_id"], row["turn"], place, role, text, loss, attached, tokens))
            place += len(text)
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def format_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
) -> DataFrame:
    """One formatted segment per turn, the turns of a conversation in order within a partition.

    ``place`` is the segment's offset in its conversation's text; ``loss`` holds
    the bounds of the learned texts within the segment, without the placeholders between.
    ``parts_col`` names an array of structs with ``kind`` and what that kind needs;
    without it, or where it is null or empty, the text is the only part. A null text
    is empty, a null role is the empty role, null turns come first, null
    conversations form one conversation, ties of a turn go by role and text, and
    repeated rows are repeated turns. An empty table gives no rows.
    """
    no_parts = F.lit(None).cast("array<struct<kind:string,text:string>>")
    rows = turns.select(
        col(conv_col).cast("long").alias("conv_id"),
        col(turn_col).cast("long").alias("turn"),
        col(role_col).cast("string").alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
        (col(parts_col) if parts_col else no_parts).alias("parts"),
    )
    dealt = rows.repartition(partitions(turns.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_formatted, TURNS)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, attachments bigint"


@dataclass
class _Digest:
    conv_id: int | None
    turns: int = 0
    chars: int = 0
    loss: int = 0
    attachments: int = 0

    def __post_init__(self):
        self.all, self.learned, self.reader = hashlib.sha256(), hashlib.sha256(), Reader()

    def add(self, row: dict) -> None:
        for role, text in self.reader.feed(row["segment"]):
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
        for span in row["loss"]:
            learned = unescape(row["segment"][span["start"] : span["end"]])
            self.learned.update(learned.encode("utf-8", "surrogatepass"))
            self.loss += len(learned)
        self.chars += len(row["segment"])
        self.attachments += len(row["attachments"])

    def row(self) -> tuple:
        self.reader.finish()
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.chars, self.attachments)


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    now: _Digest | None = None
    for batch in batches:
        done = []
        for row in batch.select(["conv_id", "segment", "loss", "attachments"]).to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    done.append(now.row())
                now = _Digest(row["conv_id"])
            now.add(row)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: what reading its formatted turns back gives, as lengths and hashes."""
    return formatted.mapInArrow(_digested, DIGEST)
