"""Chat formatting of turns with typed content parts.

A visitor walks the parts of each turn in order. Text is escaped; images, audio and documents become ordered
placeholders, with a record of what they refer to, where they stand and how many tokens they expand to. The
template marks turns with control strings. Inside contents and roles every control string is broken by an escape
sign, also where it is spread over neighbouring text parts, and the sign itself is doubled, so the text can be read
back exactly. The loss mask covers the content
of assistant turns and nothing else.

A conversation is one row of output, so its turns meet in one task; conversations are spread.

Defined results: turns are ordered by (turn, role, parts), nulls first, so ties and repeats keep one order; null
text or role counts as empty; a null part is skipped; a part of an unknown type becomes a document placeholder
of 0 tokens; turns of a null conversation id form a conversation; an empty table gives no rows; other columns
are ignored; texts of any length are kept whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.batches import map_rows

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Control strings of this and other common templates; none starts with the end of another.
CONTROLS = (START, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
SIGN = "␛"
LOSS_ROLE = "assistant"

_BREAK = re.compile(re.escape(SIGN) + "|" + "|".join(map(re.escape, CONTROLS)))
_SIGNED = re.compile(f"{SIGN}({SIGN}|n)?")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
PARTS = f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in PART.split(', '))}>>"


def escaped(text: str) -> str:
    return _BREAK.sub(lambda m: SIGN * 2 if m[0] == SIGN else m[0][0] + SIGN + m[0][1:], text)


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", SIGN + "n")


def unescaped(text: str) -> str:
    return _SIGNED.sub(lambda m: {"n": "\n", SIGN: SIGN, None: ""}[m[1]], text)


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for once the model's encoders have run."""

    patch: int = 28  # pixels on a side of an image token
    unknown_image: int = 256
    per_second: float = 25.0
    per_page: int = 1024

    def image(self, width: int | None, height: int | None) -> int:
        if not width or not height:
            return self.unknown_image
        return -(-width // self.patch) * -(-height // self.patch)

    def audio(self, seconds: float | None) -> int:
        return math.ceil((seconds or 0.0) * self.per_second)

    def document(self, pages: int | None) -> int:
        return (pages or 0) * self.per_page


@dataclass
class Flattener:
    """Visitor over the content parts of one conversation; ``out`` is its formatted text so far.

    ``said`` holds text parts that stand side by side: they are escaped as one text, as a control string may begin in
    one of them and end in another.
    """

    expansion: Expansion
    out: list[str] = field(default_factory=list)
    said: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part['type'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.said.append(part["text"] or "")

    def flush(self) -> None:
        if self.said:
            self.write(escaped("".join(self.said)))
            self.said.clear()

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, self.expansion.image(part["width"], part["height"]))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, self.expansion.audio(part["seconds"]))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, self.expansion.document(part["pages"]))

    def visit_other(self, part: dict) -> None:
        self._attach("document", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.flush()
        self.attachments.append({"position": len(self.attachments), "kind": kind, "ref": part["ref"],
                                 "at": self.length, "tokens": tokens})
        self.write(PLACEHOLDERS[kind])


def formatted(turns: list[dict], expansion: Expansion) -> tuple[str, list[dict], list[dict]]:
    """Text, loss spans (start, end in code points) and attachments of a conversation."""
    visitor, loss = Flattener(expansion), []
    for turn in turns:
        visitor.write(START + escaped_role(turn["role"] or "") + "\n")
        start = visitor.length
        for part in turn["parts"] or []:
            visitor.visit(part)
        visitor.flush()
        if turn["role"] == LOSS_ROLE:
            loss.append({"start": start, "end": visitor.length})
        visitor.write(END + "\n")
    return "".join(visitor.out), loss, visitor.attachments


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, content) of a formatted conversation. Placeholders stay as they are."""
    return [(unescaped(role), unescaped(content)) for role, content in _TURN.findall(text)]


def text_part(text: Column) -> Column:
    """A single text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"),
                            null.cast("int").alias("width"), null.cast("int").alias("height"),
                            null.cast("double").alias("seconds"), null.cast("int").alias("pages"))).cast(PARTS)


ATTACHMENTS = "array<struct<position:int,kind:string,ref:string,at:bigint,tokens:bigint>>"


def format_chats(turns: DataFrame, expansion: Expansion = Expansion(), conversation: str = "conv_id", turn: str = "turn",
                 role: str = "role", parts: str = "parts") -> DataFrame:
    """(conversation, formatted, loss_spans, attachments, expanded_tokens) for rows with an array of parts each."""
    gathered = (turns.select(F.col(conversation).alias("_c"), F.struct(
        F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(parts).cast(PARTS).alias("parts")).alias("_t"))
        .groupBy("_c").agg(F.sort_array(F.collect_list("_t")).alias("_turns")))

    def rows(conversations: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in conversations:
            text, loss, attached = formatted(own, expansion)
            yield key, text, loss, attached, sum(a["tokens"] for a in attached)

    key = turns.schema[conversation].dataType.simpleString()
    return map_rows(gathered, [F.col("_c"), F.col("_turns")],
                    f"`{conversation}` {key}, formatted string, loss_spans array<struct<start:bigint,end:bigint>>, "
                    f"attachments {ATTACHMENTS}, expanded_tokens bigint", rows)


def read_back(chats: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted text and mask."""

    def rows(conversations: Iterator[tuple]) -> Iterator[tuple]:
        for key, text, spans in conversations:
            found = read_turns(text)
            turns = hashlib.sha256("".join(f"{role}\n{content}\n" for role, content in found).encode()).hexdigest()
            loss = "".join(unescaped(text[s["start"]:s["end"]]) for s in spans)
            yield key, len(found), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)

    key = chats.schema[conversation].dataType.simpleString()
    return map_rows(chats, [F.col(conversation), F.col("formatted"), F.col("loss_spans")],
                    f"`{conversation}` {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                    "formatted_chars bigint", rows)
