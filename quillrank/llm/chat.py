"""Chat formatting: typed content parts, reversible escapes, loss mask."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {
    "image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>",
}
# What one attachment grows to in a model's input.
IMAGE_PATCH = 28             # pixels along each side of a patch
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
PARTS = f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in PART.split(', ')) }>>"
FORMATTED = (
    "formatted string, n_turns long, loss array<struct<start:long,stop:long>>, "
    "attachments array<struct<turn:long,position:long,type:string,ref:string,tokens:long>>, "
    "expanded_tokens long"
)
# The same for Arrow.
_ATTACHMENT = pa.struct([
    ("turn", pa.int64()), ("position", pa.int64()), ("type", pa.string()), ("ref", pa.string()),
    ("tokens", pa.int64()),
])
_NAMES = ["formatted", "n_turns", "loss", "attachments", "expanded_tokens"]
_TYPES = [
    pa.string(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
    pa.list_(_ATTACHMENT), pa.int64(),
]


def escape(text: str) -> str:
    """No control string survives: each begins with ``<|``, which gets a backslash between."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    """A role ends at the line feed, so it holds none."""
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def unescape_role(text: str) -> str:
    return re.sub(
        r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL
    )


@dataclass
class Visitor:
    """Walks the parts of one conversation in order and writes its text."""

    out: list[str] = field(default_factory=list)
    size: int = 0
    turn: int = 0
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[int, int, str, str | None, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        if text:  # so that the last piece always tells the last character
            self.out.append(text)
            self.size += len(text)

    def visit_turn(self, role: str | None, parts) -> None:
        self.write(f"{START}{escape_role(role or '')}\n")
        for part in () if parts is None else parts:
            if part is not None:
                kind = part["type"] or "text"
                before = self.size
                self.visit_part(kind, part)
                if role == "assistant" and kind == "text" and self.size > before:
                    self.loss.append((before, self.size))
        self.write(f"{END}\n")
        self.turn += 1

    def visit_part(self, kind: str, part) -> None:
        visits = {
            "text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio,
            "document": self.visit_document,
        }
        if kind not in visits:
            raise ValueError(f"unknown part type {kind!r}")
        visits[kind](part)

    def visit_text(self, part) -> None:
        text = escape(part["text"] or "")
        if text.startswith("|") and self.out[-1].endswith("<"):  # no control string at a seam
            text = "\\" + text
        self.write(text)

    def visit_image(self, part) -> None:
        across = -(-int(part["width"] or 0) // IMAGE_PATCH)
        down = -(-int(part["height"] or 0) // IMAGE_PATCH)
        self._attach(part, max(1, across * down))

    def visit_audio(self, part) -> None:
        self._attach(part, max(1, round((part["seconds"] or 0) * AUDIO_TOKENS_PER_SECOND)))

    def visit_document(self, part) -> None:
        self._attach(part, max(1, int(part["pages"] or 0) * DOCUMENT_TOKENS_PER_PAGE))

    def _attach(self, part, tokens: int) -> None:
        self.attachments.append((self.turn, self.size, part["type"], part["ref"], tokens))
        self.write(PLACEHOLDERS[part["type"]])


def format_turns(turns) -> tuple:
    """One row of ``FORMATTED`` from ``[(role, parts), ...]``."""
    visitor = Visitor()
    for role, parts in turns:
        visitor.visit_turn(role, parts)
    return (
        "".join(visitor.out), visitor.turn, visitor.loss, visitor.attachments,
        sum(attachment[-1] for attachment in visitor.attachments),
    )


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """``[(role, text), ...]`` from a formatted conversation, with placeholders left in."""
    turns = []
    for block in formatted.split(START)[1:]:
        head, _, body = block.partition("\n")
        turns.append((unescape_role(head), unescape(body[: body.rindex(END)])))
    return turns


def text_parts(text: Column) -> Column:
    """A plain text as its one part."""
    empty = {name.split()[0]: name.split()[1] for name in PART.split(", ")}
    fields = [
        (F.lit("text") if name == "type" else text if name == "text" else F.lit(None))
        .cast(kind).alias(name)
        for name, kind in empty.items()
    ]
    return F.array(F.struct(*fields))


def format_conversations(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, n_turns, loss, attachments, expanded_tokens)`` from ``messages(conv_id,
    turn, role, parts)``, one row per conversation.

    Turns are ordered by number, then role, then parts, so ties and repeated rows come out the
    same in every run; all are kept. A null role is empty, null parts and null texts are empty
    text, a null turn number comes first, null ids form one conversation. Control strings in
    texts and roles are escaped; ``loss`` are the ranges (code points of ``formatted``) of what the
    assistant says, without marks and attachments; an attachment leaves its placeholder at
    ``position`` and grows to ``tokens``. An unknown part type is an error. Columns beyond these four are
    ignored. A conversation is one text in the result, so it is gathered in one place;
    a conversation does not grow with the corpus.
    """
    told = F.array_sort(F.collect_list(F.struct("turn", "role", "parts")))
    gathered = messages.select(
        "conv_id", "turn", "role", F.col("parts").cast(PARTS).alias("parts")
    ).groupBy("conv_id").agg(told.alias("turns"))

    def run(batches):
        for batch in batches:
            rows = [
                format_turns((t["role"], t["parts"]) for t in turns)
                for turns in batch.column("turns").to_pylist()
            ]
            named = [dict(zip(_NAMES, row, strict=True)) for row in rows]
            for row in named:
                row["loss"] = [{"start": a, "stop": b} for a, b in row["loss"]]
                row["attachments"] = [
                    dict(zip(_ATTACHMENT.names, x, strict=True)) for x in row["attachments"]
                ]
            arrays = [
                pa.array([row[name] for row in named], type=kind)
                for name, kind in zip(_NAMES, _TYPES, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *arrays],
                                             names=["conv_id", *_NAMES])

    kind = dict(messages.dtypes)["conv_id"]
    return gathered.mapInArrow(run, f"conv_id {kind}, {FORMATTED}")


def read_back(formatted: Column, loss: Column) -> Column:
    """``struct<n_turns, turns_text, loss_text>`` told by a formatted conversation alone:
    ``turns_text`` is role, line feed, text, line feed per turn, ``loss_text`` what the mask
    covers, unescaped."""

    @F.pandas_udf("n_turns long, turns_text string, loss_text string")
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, masks in batches:
            rows = []
            for text, mask in zip(texts, masks, strict=True):
                turns = read_turns(text)
                rows.append((
                    len(turns),
                    "".join(f"{role}\n{said}\n" for role, said in turns),
                    "".join(unescape(text[span["start"]:span["stop"]]) for span in mask),
                ))
            yield pd.DataFrame(rows, columns=["n_turns", "turns_text", "loss_text"])

    return udf(formatted, loss)
