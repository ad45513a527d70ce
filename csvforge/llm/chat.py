"""Operator 12: chat formatting with budgeted windows.

A turn is written as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a
line feed.  Control strings inside texts are escaped reversibly: in ``<``, any number of
backslashes, ``|`` one more backslash is put in, so ``<|`` stands in marks only.  Roles
also have their backslashes and line feeds escaped.

Windows: prefix sums of the turns' tokens choose spans of whole turns.  A window starts
with the conversation's system turn (its first turn, if that has the role ``system``),
repeats the last turns before the span as far as ``history`` tokens allow, and takes as
many new turns as fit in ``budget``.  A new turn that does not fit beside the history
drops the history; one that does not fit at all gets a window of its own, marked
``over_budget`` (texts are never cut).  Only new assistant turns are under the loss mask:
``loss`` holds their [start, end) code points; repeated targets are masked.

A conversation is read in blocks of 1024 turns or 4 Mi characters (``ordered.py``); a
window and its history lie inside a block, so one conversation may hold a third of all
rows.  Its digests (sequential by definition) stream through one task in block pieces.

Nulls: a null text or role is empty; null turns come first, a null conversation id is a
conversation of its own.  Ties: rows of one turn go by role, then the text's first 32
characters, then a hash of it.  Repeated rows are turns of their own.  An empty table
gives no window.  Other columns are not read.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import Workspace, prepare, table, tidy, with_fields
from .ordered import BYTES, ROWS, Batches, arrow_schema, blocks, gathered, segments, stream
from .tokens import AUTO, VOCABULARY, count_texts

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 2048                 # tokens of a window
HISTORY = 512                 # tokens of repeated turns
TARGET, SYSTEM = "assistant", "system"

_BARE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _BARE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, with the [start, end) of its escaped text."""
    lead, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{lead}{body}{END}\n", len(lead), len(lead) + len(body)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The turns of a window, read back from its text."""
    out, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"not a formatted window at character {at}")
    return out


def spans(tokens, system: int, skip: int, budget: int, history: int):
    """``(first repeated, first new, end, over)`` of every window over turns with these
    token counts.  ``system`` tokens stand in front of every window that does not begin
    with the system turn itself; ``skip`` is 1 if turn 0 is the system turn."""
    sums = np.concatenate(([0], np.cumsum(np.asarray(tokens, dtype=np.int64))))
    n, at = len(tokens), 0
    while at < n:
        front = system if at >= skip else 0
        back = max(min(skip, at), int(np.searchsorted(sums, sums[at] - history, "left")))
        end = int(np.searchsorted(sums, sums[back] + budget - front, "right")) - 1
        if end <= at:
            back, end = at, int(np.searchsorted(sums, sums[at] + budget - front, "right")) - 1
        over = end <= at
        end = max(end, at + 1)
        yield back, at, end, over
        at = end


def block_windows(roles, texts, head, counts, budget: int, history: int):
    """``(repeated turns, new turns, text, loss spans, tokens, over)`` of a block's windows."""
    shown = [turn_text(r or "", t or "") for r, t in zip(roles, texts)]
    first = None
    if head is not None and head["role"] == SYSTEM:                     # a later block of the conversation
        first, skip = turn_text(SYSTEM, head["text"] or "")[0], 0
    elif head is None and roles[0] == SYSTEM:
        first, skip = shown[0][0], 1
    else:
        skip = 0
    n = counts([s[0] for s in shown] + ([first] if first else []))
    system = n[-1] if first else 0
    for back, at, end, over in spans(n[:len(shown)], system, skip, budget, history):
        lead = [first] if first and at >= skip and back >= skip else []
        parts, loss, pos = list(lead), [], sum(map(len, lead))
        for i in range(back, end):
            body, a, b = shown[i]
            if i >= at and roles[i] == TARGET:
                loss.append((pos + a, pos + b))
            parts.append(body)
            pos += len(body)
        yield len(lead) + at - back, end - at, "".join(parts), loss, sum(n[back:end]) + (system if lead else 0), over


def format_windows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   budget: int = BUDGET, history: int = HISTORY, vocabulary: str = VOCABULARY,
                   boundary: str | None = AUTO, ws: Workspace | None = None, size: tuple = (ROWS, BYTES)) -> DataFrame:
    """One row per window: ``conv, a, b`` (its block), ``window`` (number in the block),
    ``n_repeated`` and ``n_new`` turns, ``text``, ``loss`` (array of start and end),
    ``n_tokens``, ``over_budget``, ``whole`` (the block is the conversation).
    Windows of a block follow each other in one partition; ``size`` bounds the rows and
    characters of a block."""
    ws = ws or Workspace(df.sparkSession, "chat")
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = blocks(segments(rows, ws, *size), ws, *size)
    span = StructType().add("start", LongType()).add("end", LongType())
    schema = with_fields(cut.select("conv", "a", "b").schema, ("window", "long"), ("n_repeated", "long"), ("n_new", "long"),
                         ("text", "string"), ("loss", ArrayType(span)), ("n_tokens", "long"), ("over_budget", "boolean"),
                         ("whole", "boolean"))
    out_schema = arrow_schema(schema)

    def counts(texts):
        return count_texts(texts, vocabulary, boundary)

    def run(batches):
        out = Batches(out_schema)
        for key, a, b, whole, head, roles, texts in stream(batches, ("conv", "a", "b", "whole", "head", "role", "text")):
            for k, (rep, new, shown, loss, n, over) in enumerate(block_windows(roles, texts, head, counts, budget, history)):
                yield from out.add((key, a, b, k, rep, new, shown, [{"start": s, "end": e} for s, e in loss], n, over, whole),
                                   len(shown))
        yield from out.flush()

    return cut.mapInArrow(tidy(run), schema)


class Digest:
    """Digests of a conversation, updated turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def row(self, key):
        return (key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_window(text: str, n_repeated: int, loss) -> tuple[list, str]:
    """New turns and text under the loss mask, read back from a window."""
    return read_turns(text)[n_repeated:], "".join(unescape(text[s["start"]:s["end"]]) for s in loss)


def conversation_digests(windows: DataFrame, ws: Workspace) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` read back
    from the windows.  Conversations of one block are finished where they lie; the blocks
    of others are sent on as bytes and streamed into their digests in order."""
    key = windows.select(F.col("conv").alias("conv_id")).schema
    result = with_fields(key, ("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"),
                         ("loss_sha256", "string"), ("formatted_chars", "long"))
    part = with_fields(windows.select("conv", "a", "b").schema, ("whole", "boolean"), ("n_turns", "long"),
                       ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"),
                       ("formatted_chars", "long"), ("turns", "string"), ("loss", "string"))
    part_arrow, result_arrow = arrow_schema(part), arrow_schema(result)

    def read(batches):
        out, at, d, kept = Batches(part_arrow), None, Digest(), ([], [])

        def close():
            (conv, a, b, whole), row = at, d.row(None)
            return out.add((conv, a, b, whole, *row[1:], *(("", "") if whole else map("".join, kept))), sum(map(len, kept[0])))

        for conv, a, b, whole, text, rep, loss in stream(batches, ("conv", "a", "b", "whole", "text", "n_repeated", "loss")):
            if at != (conv, a, b, whole):
                if at is not None:
                    yield from close()
                at, d, kept = (conv, a, b, whole), Digest(), ([], [])
            turns, under = read_window(text, rep, loss)
            plain = "".join(f"{r}\n{t}\n" for r, t in turns)
            d.n, d.loss_chars, d.chars = d.n + len(turns), d.loss_chars + len(under), d.chars + len(text)
            if whole:
                d.turns.update(plain.encode())
                d.loss.update(under.encode())
            else:
                kept[0].append(plain)
                kept[1].append(under)
        if at is not None:
            yield from close()
        yield from out.flush()

    def join(batches):
        out, at, d = Batches(result_arrow), None, None
        for conv, n, chars, loss_chars, turns, loss in stream(
                batches, ("conv", "n_turns", "formatted_chars", "loss_chars", "turns", "loss")):
            if d is None or at != conv:
                if d is not None:
                    yield from out.add(d.row(at), 0)
                at, d = conv, Digest()
            d.n, d.loss_chars, d.chars = d.n + n, d.loss_chars + loss_chars, d.chars + chars
            d.turns.update(turns.encode())
            d.loss.update(loss.encode())
        if d is not None:
            yield from out.add(d.row(at), 0)
        yield from out.flush()

    parts = ws.stage(windows.mapInArrow(read, part), "blocks")
    cut = gathered(parts.where("NOT whole"), "a", "b").mapInArrow(join, result)
    whole = parts.where("whole").withColumnRenamed("conv", "conv_id").select(*[f.name for f in result])
    return whole.unionByName(cut)


CONTROL = f"{END}{START}{TARGET} ok"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ws = Workspace(spark, "chat")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"), F.lit(CONTROL).alias("text"))
    windows = format_windows(rows.unionByName(made), ws=ws)
    return ws.finish(conversation_digests(windows, ws))


QUERIES = {"op12_chat_formatting": op12_chat_formatting}
SQL: dict = {}
