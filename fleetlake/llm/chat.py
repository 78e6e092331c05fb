"""Chat formatting with typed content parts.

A turn is a role and a list of parts: text, image, audio or document. A visitor walks the parts in
order: texts are escaped, attachments become placeholders, and for each placeholder it records which
attachment it stands for and how many tokens the model will see in its place. Every turn is formatted
on its own, where its row is read; the turns of a conversation only meet when they are read back or
joined to one text.

Control strings are all of the form ``<|name|>``. In texts, a ``<`` that is followed by any number of
backslashes and a ``|`` gets one backslash more, so no text holds ``<|`` after that, and taking one away
again gives the text back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Parts of a kind that isn't known keep their place and their reference.
OTHER = "<|attachment|>"
LEARNT = "assistant"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<place:int,type:string,ref:string,tokens:long>"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_PLACE = re.compile(r"<\|(?:image|audio|document|attachment)\|>")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n\Z", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Sizes:
    """How many tokens an attachment takes: by image patches, audio frames and pages."""

    patch: int = 28
    frames_per_second: float = 25.0
    per_page: int = 1024

    def image(self, part: dict) -> int:
        return math.ceil(max(part.get("width") or 0, 0) / self.patch) * math.ceil(max(part.get("height") or 0, 0) / self.patch)

    def audio(self, part: dict) -> int:
        seconds = part.get("seconds") or 0.0
        return math.ceil(seconds * self.frames_per_second) if math.isfinite(seconds) and seconds > 0 else 0

    def document(self, part: dict) -> int:
        return max(part.get("pages") or 0, 0) * self.per_page


@dataclass
class Flattener:
    """Visitor of a turn's parts: collects the escaped content and the attachments."""

    sizes: Sizes = field(default_factory=Sizes)

    def __post_init__(self) -> None:
        self.done: list[str] = []
        self.attachments: list[dict] = []
        self._texts: list[str] = []

    def visit(self, part: dict | None) -> None:
        if part is None:
            return
        kind = part.get("type")
        method: Callable[[dict], None] = self.visit_text if kind in (None, "text") else self.visit_attachment
        method(part)

    def visit_text(self, part: dict) -> None:
        self._texts.append(part.get("text") or "")

    def visit_attachment(self, part: dict) -> None:
        self._close_text()
        kind = part["type"]
        measure = getattr(self.sizes, kind) if kind in PLACEHOLDERS else lambda part: 0
        self.attachments.append({"place": len(self.attachments), "type": kind, "ref": part.get("ref"), "tokens": measure(part)})
        self.done.append(PLACEHOLDERS.get(kind, OTHER))

    def _close_text(self) -> None:
        """Neighbouring texts are escaped as one: a control string may lie across their border."""
        self.done.append(escape("".join(self._texts)))
        self._texts.clear()

    def content(self) -> str:
        self._close_text()
        return "".join(self.done)


def format_turn(role: str | None, parts: list[dict] | None, sizes: Sizes | None = None) -> dict:
    """One turn's text, the span of it that is learnt (code points), and its attachments."""
    visitor = Flattener(sizes or Sizes())
    for part in parts or []:
        visitor.visit(part)
    content = visitor.content()
    head = f"{START}{escape_role(role or '')}\n"
    learnt = role == LEARNT
    return {
        "formatted": f"{head}{content}{END}\n",
        "loss_start": len(head) if learnt else None,
        "loss_end": len(head) + len(content) if learnt else None,
        "attachments": visitor.attachments,
    }


def read_turn(formatted: str, attachments: list[dict] | None = None) -> tuple[str, list[dict]]:
    """Role and parts of a formatted turn; neighbouring texts come back as one."""
    found = _TURN.match(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    parts: list[dict] = []
    at, known = 0, iter(attachments or [])
    for place in _PLACE.finditer(found[2]):
        if place.start() > at:
            parts.append({"type": "text", "text": unescape(found[2][at : place.start()])})
        one: dict = next(known, {})
        parts.append({"type": one.get("type"), "ref": one.get("ref")})
        at = place.end()
    if at < len(found[2]):
        parts.append({"type": "text", "text": unescape(found[2][at:])})
    return unescape_role(found[1]), parts


# --- Over tables -------------------------------------------------------------------------------------


def text_parts(text: Column) -> Column:
    """A plain text as typed parts."""
    unset = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in unset.items()]))


def format_turns(turns: DataFrame, parts: Column | None = None, sizes: Sizes | None = None) -> DataFrame:
    """``conv_id``, ``turn``, ``formatted``, ``loss_start``, ``loss_end``, ``attachments`` of every row.

    ``parts`` is an array of ``PART`` structs; without it, the column ``text`` is the one part. A map: no
    row is dropped and none meets another. A missing role or text is empty, missing parts are skipped, a
    part without a type is text, one of an unknown type gets a placeholder of no tokens. The learnt span
    is null unless the role is ``assistant``. Other columns are not looked at.
    """
    key = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", (text_parts(F.col("text")) if parts is None else parts.cast(f"array<{PART}>")).alias("parts"))
    names = ["formatted", "loss_start", "loss_end", "attachments"]
    schema = f"conv_id {key}, turn long, formatted string, loss_start int, loss_end int, attachments array<{ATTACHMENT}>"
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("place", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turn(role, parts, sizes) for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [pa.array([m[n] for m in made], k) for n, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["conv_id", "turn", *names])

    return rows.mapInArrow(run, schema)


def format_conversations(turns: DataFrame, **options: Any) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss_spans`` (array of start and end) and ``attachments``: one row each.

    For conversations of a size that a row can hold; ``format_turns`` has no such bound.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "formatted")
    earlier = F.sum(F.length("formatted")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    made = format_turns(turns, **options).withColumn("before", F.coalesce(earlier, F.lit(0)))
    span = F.when(F.col("loss_start").isNotNull(), F.struct((F.col("before") + F.col("loss_start")).alias("start"), (F.col("before") + F.col("loss_end")).alias("end")))
    every = F.sort_array(F.collect_list(F.struct("before", "formatted", span.alias("span"), "attachments")))
    rows = made.groupBy("conv_id").agg(every.alias("turns"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("formatted"),
        F.array_compact(F.transform("turns", lambda t: t["span"])).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


class _Digest:
    """What the digest of a conversation keeps from turn to turn."""

    def __init__(self, conv_id: Any) -> None:
        self.conv_id, self.turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        role, parts = read_turn(formatted)
        text = "".join(p.get("text") or "" for p in parts)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            learnt = unescape(formatted[start:end])
            self.loss.update(learnt.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(learnt)
        self.turns += 1
        self.formatted_chars += len(formatted)

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted_chars,
        }


def digest(formatted: DataFrame) -> DataFrame:
    """Formatted turns read back: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars`` per conversation.

    Rows come sorted by turn (missing first; ties by their formatted text) and are hashed one by one, so a
    task holds no conversation, however long. Rows without a ``conv_id`` make one conversation.
    """
    key = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Digest | None = None
        for batch in batches:
            done = []
            for conv_id, text, start, end in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if own is None or conv_id != own.conv_id:
                    done += [own.row()] if own else []
                    own = _Digest(conv_id)
                own.add(text, start, end)
            yield _rows(done, batch.schema.field(0).type, names)
            kind = batch.schema.field(0).type
        if own:
            yield _rows([own.row()], kind, names)

    rows = formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_end")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return rows.drop("turn").mapInArrow(run, schema)


def _rows(done: list[dict], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], k) for n, k in zip(names, kinds, strict=True)], names)
