"""Chat formatting: typed content parts are flattened into one reversible text per conversation."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import stream_groups

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Template:
    """Marks of the format and the token prices of parts that are not text.

    A turn is `<|turn|>role<|text|>content<|end|>`; an image, audio or document part leaves its placeholder in the
    content. A backslash after the first character of a control string says that it is ordinary text, one
    more backslash stands for each that was there; so escaping can be undone, and no escaped text holds a
    control string. `reserved` adds control strings of other formats, which are escaped too.
    """

    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 768
    learned_roles: tuple[str, ...] = ("assistant",)

    MARKS = ("<|turn|>", "<|text|>", "<|end|>", "<|image|>", "<|audio|>", "<|document|>")

    def __post_init__(self):
        tails = sorted({c[1:] for c in (*self.MARKS, *self.reserved)}, key=lambda t: (-len(t), t))
        heads = sorted({c[0] for c in (*self.MARKS, *self.reserved)})
        if any(t[:1] == "\\" or any(h in t for h in heads) for t in tails):
            raise ValueError("a control string may hold its first character only once and no backslash second")
        head, tail = "".join(map(re.escape, heads)), "|".join(map(re.escape, tails))
        object.__setattr__(self, "plain", re.compile(rf"([{head}])(\\*)({tail})"))
        object.__setattr__(self, "masked", re.compile(rf"([{head}])\\(\\*)({tail})"))

    def escape(self, text: str) -> str:
        return self.plain.sub(r"\1\\\2\3", text)

    def unescape(self, text: str) -> str:
        return self.masked.sub(r"\1\2\3", text)

    def visit(self, parts: Iterable[dict]) -> tuple[str, list[dict], int, int]:
        """Walk the parts in order: content, attachments in order of their placeholders, characters of
        text, expanded tokens of the placeholders. Unknown kinds count as text."""
        out, attached, tokens, at = [], [], 0, 0
        typed = ((part.get("kind") or "text", part) for part in parts)
        # Neighbouring texts are one text: a control string that only their joint spells is escaped as well.
        for is_text, run in groupby(typed, key=lambda x: getattr(self, f"_{x[0]}", None) is None):
            if is_text:
                out.append(self.escape("".join(part.get("text") or "" for _, part in run)))
                at += len(out[-1])
                continue
            for kind, part in run:
                cost = getattr(self, f"_{kind}")(part)
                attached.append({"kind": kind, "ref": part.get("ref") or "", "start": at, "tokens": cost})
                tokens += cost
                out.append(f"<|{kind}|>")
                at += len(out[-1])
        return "".join(out), attached, at, tokens

    def _image(self, part: dict) -> int:
        w, h = (max(1, int(part.get(k) or 1)) for k in ("width", "height"))
        return math.ceil(w / self.patch) * math.ceil(h / self.patch)

    def _audio(self, part: dict) -> int:
        seconds = part.get("seconds") or 0.0
        return max(1, math.ceil(seconds * self.audio_rate)) if math.isfinite(seconds) else 1

    def _document(self, part: dict) -> int:
        return max(1, int(part.get("pages") or 1)) * self.page_tokens


TURN = "conv_id long, turn long, role string, formatted string, content_start long, content_chars long, learned boolean, attachments array<struct<kind:string,ref:string,start:long,tokens:long>>, text_bytes long, placeholder_tokens long"
PLACED = TURN + ", position long, start long"


def text_part(text: Column) -> Column:
    """A plain text column as a list with one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One formatted segment per turn. Needs conv_id, turn, role, parts (or text, which is one text part).

    Work is per row, whatever the length of a conversation. Null role, text, parts and part fields count as
    empty; a null or unknown kind is text. `content_start` and `content_chars` place the content inside the
    segment, `attachments.start` inside the content; `learned` says whether the content is under the loss mask.
    `text_bytes` is the UTF-8 length of the content; `placeholder_tokens` what the placeholders expand to.
    """
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in turns.columns else text_part(F.col("text"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts")
    )

    def visit(frames):
        for frame in frames:
            out = []
            for conv, turn, role, given in zip(frame["conv_id"], frame["turn"], frame["role"], frame["parts"]):
                flat = [p for p in (given if given is not None else ()) if p is not None]
                content, attached, size, tokens = template.visit(flat)
                head = f"<|turn|>{template.escape(role)}<|text|>"
                out.append(
                    (conv, turn, role, f"{head}{content}<|end|>", len(head), size, role in template.learned_roles, attached, len(content.encode("utf-8", "surrogatepass")), tokens)
                )
            done = pd.DataFrame(out, columns=[c.split()[0] for c in TURN.split(", ")])
            yield done.astype({"conv_id": "Int64", "turn": "Int64"})

    return rows.mapInPandas(visit, TURN)


def place_turns(segments: DataFrame) -> DataFrame:
    """Order the segments of each conversation and give each its offset in the whole text.

    Order: turn, role, segment (nulls first), so repeated turns have a fixed place. Rows stream through
    sorted partitions; memory does not grow with a conversation. Rows without conv_id form one conversation.
    """

    def place(frames):
        last, position, start = object(), 0, 0
        for frame in frames:
            places, starts = [], []
            for conv, text in zip(frame["conv_id"], frame["formatted"]):
                conv = None if pd.isna(conv) else conv
                if conv != last:
                    last, position, start = conv, 0, 0
                places.append(position)
                starts.append(start)
                position, start = position + 1, start + len(text)
            frame = frame.assign(position=places, start=starts)
            yield frame.astype({"conv_id": "Int64", "turn": "Int64"})

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.mapInPandas(place, PLACED)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attachments long, expanded_tokens long"


def read_back(placed: DataFrame, template: Template = Template()) -> DataFrame:
    """Digest of each conversation, read from its formatted text alone: marks are parsed, texts unescaped.

    Expects what place_turns() returns (rows of a conversation together and in order).
    """
    segment = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)

    def read(frames: Iterator[pd.DataFrame]):
        out, state = [], None
        for frame in frames:
            for conv, text, attached in zip(frame["conv_id"], frame["formatted"], frame["placeholder_tokens"]):
                conv = None if pd.isna(conv) else int(conv)
                if state is None or state["conv_id"] != conv:
                    if state is not None:
                        out.append(_closed(state))
                    state = {"conv_id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "attachments": 0, "tokens": 0}
                role, content = (template.unescape(x) for x in segment.fullmatch(text).groups())
                state["n"] += 1
                state["chars"] += len(text)
                state["tokens"] += int(attached)
                state["attachments"] += sum(text.count(m) for m in Template.MARKS[3:])
                state["turns"].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                if role in template.learned_roles:
                    state["loss"].update(content.encode("utf-8", "surrogatepass"))
                    state["loss_chars"] += len(content)
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")]).astype({"conv_id": "Int64"})
                out = []
        if state is not None:
            out.append(_closed(state))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")]).astype({"conv_id": "Int64"})

    return placed.mapInPandas(read, READ)


def _closed(state: dict) -> tuple:
    return (
        state["conv_id"],
        state["n"],
        state["turns"].hexdigest(),
        state["loss_chars"],
        state["loss"].hexdigest(),
        state["chars"],
        state["attachments"],
        state["tokens"],
    )


def whole_texts(placed: DataFrame) -> DataFrame:
    """(conv_id, formatted) of each conversation as one string, for conversations that fit in a row."""

    def join(frames):
        for group in stream_groups(frames, ["conv_id"]):
            yield pd.DataFrame({"conv_id": [group["conv_id"].iloc[0]], "formatted": ["".join(group["formatted"])]}).astype({"conv_id": "Int64"})

    return placed.select("conv_id", "formatted").mapInPandas(join, "conv_id long, formatted string")
