"""Operator 13: conversation structure repair by a run-length dynamic program.

Every row is a symbol: the class of its role's initial (s, u, a, other) and its first
fault (blank, duplicate: must go; truncated: 3 more unless deleted).  The role initials
kept must spell ``(s?(ua)+)?``, an automaton of four states, and a symbol is a 4 x 4
min-plus matrix: any insertions, then the row is kept, rerolled or deleted.  Equal
consecutive symbols are one run; a run of length L advances costs by the binary powers
of its matrix, which are computed once and cached.  The audit is unrolled forward from
the costs behind every run: the least letter (D < I < K < R) that keeps the total
cheapest, which is the ASCII-least of the cheapest audits.

A conversation is read in bounded segments (``ordered.py``), so one conversation may
hold a third of all rows.  A conversation in one segment is repaired where it lies.  For
the others the matrices of segments are multiplied from the end (one row of 16 numbers a
segment), every segment is unrolled for its four possible entry states in parallel, and
only the digest of the repaired text (sequential by definition) streams through one task.
Earlier copies of a row are found by hashes aggregated per text, not by gathering rows.

Nulls: a null role or text is one space (a role without a class and a blank text), as is
a null id or turn in the damage key; null turns come first and do not count for gaps; a
null conversation id is a conversation of its own.  An empty role has no class.  Ties:
rows of one turn go by role, then the text's first 32 characters, then a hash of it.
Repeated rows are duplicates.  A conversation that loses all its rows has zeros, an
empty audit and the hash of the empty string.  An empty table gives an empty result.
Other columns are not read.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from .common import Workspace, prepare, table, with_fields
from .ordered import BYTES, ROWS, Batches, arrow_schema, gathered, segments, stream

INF = 1 << 60
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BEGIN, SYSTEM, USER, ASSISTANT = range(4)              # what the kept rows end with
STATES = range(4)
DROP = "d"                                             # symbol of a row that must be deleted
FOLLOWING = {"s": {BEGIN: SYSTEM}, "u": {BEGIN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEEDED = (USER, USER, ASSISTANT, USER)                 # what an inserted or rerolled row makes of a state
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
ACCEPTED = (0, INF, INF, 0)                            # nothing kept, or an assistant last

_SOLID = re.compile(r"[^\x20\x09-\x0D]")
SPACES = " \t\n\x0b\x0c\r"


# ----------------------------------------------------------------- the min-plus algebra
def _row(symbol: str, state: int):
    """``(letter, cost, next state)`` of consuming a row in a state, least letter first."""
    yield "D", DELETE, state
    if symbol == DROP:
        return
    kind, extra = symbol[0], TRUNCATED if symbol.endswith("t") else 0
    if state in FOLLOWING.get(kind, ()):
        yield "K", extra, FOLLOWING[kind][state]
    yield "R", REROLE + extra, NEEDED[state]


def product(x, y):
    return tuple(tuple(min(min(x[i][k] + y[k][j] for k in STATES), INF) for j in STATES) for i in STATES)


def apply(x, after):
    """Costs before a matrix from the costs behind it."""
    return tuple(min(min(x[i][k] + after[k] for k in STATES), INF) for i in STATES)


IDENTITY = tuple(tuple(0 if i == j else INF for j in STATES) for i in STATES)
_ONE_INSERT = tuple(tuple(0 if i == j else INSERT if NEEDED[i] == j else INF for j in STATES) for i in STATES)
INSERTS = product(_ONE_INSERT, _ONE_INSERT)            # a third one would only return to a state


@functools.lru_cache(maxsize=None)                     # 9 symbols x the bits of a segment's length
def power(symbol: str, k: int):
    """Matrix of 2**k equal symbols."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    rows = [[INF] * 4 for _ in STATES]
    for i in STATES:
        for _, cost, j in _row(symbol, i):
            rows[i][j] = min(rows[i][j], cost)
    return product(INSERTS, tuple(map(tuple, rows)))


def _bits(n: int):
    return [k for k in range(n.bit_length()) if n >> k & 1]


def before_run(symbol: str, n: int, after):
    for k in _bits(n):
        after = apply(power(symbol, k), after)
    return after


def matrix(runs):
    """Matrix of a sequence of runs ``(symbol, length)``."""
    out = IDENTITY
    for symbol, n in runs:
        for k in _bits(n):
            out = product(out, power(symbol, k))
    return out


END = apply(INSERTS, ACCEPTED)                         # costs behind the last row


def runs_of(symbols):
    return [(s, sum(1 for _ in g)) for s, g in itertools.groupby(symbols)]


# ----------------------------------------------------------------- unrolling
@functools.lru_cache(maxsize=1 << 16)
def _step(symbol: str, after):
    """Costs before one symbol, as (least, costs above the least)."""
    costs = apply(power(symbol, 0), after)
    low = min(costs)
    return low, tuple(min(c - low, INF) for c in costs)


@functools.lru_cache(maxsize=1 << 16)
def _choice(symbol: str, after, state: int):
    """Letters up to and with the one that consumes the row, and the state behind it."""
    before, letters = apply(power(symbol, 0), after), ""
    while True:
        options = [(letter, cost + after[j], j, True) for letter, cost, j in _row(symbol, state)]
        options.append(("I", INSERT + before[NEEDED[state]], NEEDED[state], False))
        letter, _, state_, done = min(o for o in options if o[1] == before[state])
        letters, state = letters + letter, state_
        if done:
            return letters, state


def unroll(runs, after, state: int):
    """Audit letters of the runs entered in ``state`` with the costs ``after`` behind them, and
    the state behind them."""
    behind = [after]
    for symbol, n in reversed(runs):
        behind.append(before_run(symbol, n, behind[-1]))
    out = []
    for (symbol, n), costs in zip(runs, reversed(behind[:-1])):
        low = min(costs)
        inside = [tuple(min(c - low, INF) for c in costs)]
        for _ in range(n - 1):
            inside.append(_step(symbol, inside[-1])[1])
        for costs in reversed(inside):
            letters, state = _choice(symbol, costs, state)
            out.append(letters)
    return "".join(out), state


def finish(state: int) -> str:
    """Insertions behind the last row."""
    return "" if ACCEPTED[state] == 0 else "I" + finish(NEEDED[state])


def repaired(audit: str, roles, texts, state: int):
    """The repaired ``role:text`` lines of an audit."""
    row = 0
    for letter in audit:
        if letter == "I":
            state = NEEDED[state]
            yield f"{ROLES[state]}:"
            continue
        role, text = roles[row], texts[row]
        row += 1
        if letter == "R":
            state = NEEDED[state]
            yield f"{ROLES[state]}:{text}"
        elif letter == "K":
            state = FOLLOWING[role[0]][state]
            yield f"{role}:{text}"


# ----------------------------------------------------------------- rows, faults, measures
def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The damaged rows ``(conv, turn, role, text)``; a dropped row stays as a null role, so
    that its conversation is not lost."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    made = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), k.alias("k"), F.when(k != 0, F.when(k == 4, "user").otherwise(space(role))).alias("role"),
        F.when(k == 1, "").when(k == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text)).alias("text"))
    return made.select("conv", "turn", "role", F.when(F.col("role").isNotNull(), F.col("text")).alias("text"),
                       F.explode(F.when(F.col("k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
                       ).drop("copy")


def fault(text: str, seen: bool) -> str | None:
    if not _SOLID.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return None if text.rstrip(SPACES)[-1] in ".!?" else "truncated"


def symbol_of(role: str, found: str | None) -> str:
    if found in ("blank", "duplicate"):
        return DROP
    kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return kind + ("t" if found else "")


class Measures:
    """Counts over the rows of a conversation, in order; also across segments."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.last = None

    def add(self, turn, role, found):
        if found:
            setattr(self, found, getattr(self, found) + 1)
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        if turn is not None and turn != self.high:             # turns come in ascending order
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1

    def row(self):
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def faults(roles, texts, again):
    """First fault of every row; ``again`` are the positions of repeated rows (None: all rows
    of the conversation are here)."""
    seen = set()
    for i, (role, text) in enumerate(zip(roles, texts)):
        twin = (role, text) in seen if again is None else i in again
        if again is None:
            seen.add((role, text))
        yield fault(text, twin)


def _live(turns, roles, texts):
    kept = [(t, r, x) for t, r, x in zip(turns, roles, texts) if r is not None]
    return [list(c) for c in zip(*kept)] if kept else [[], [], []]


def repair_whole(turns, roles, texts):
    """All result columns but the id, of a conversation at hand."""
    m = Measures()
    found = list(faults(roles, texts, None))
    for t, r, f in zip(turns, roles, found):
        m.add(t, r, f)
    runs = runs_of(symbol_of(r, f) for r, f in zip(roles, found))
    cost = apply(matrix(runs), END)[BEGIN]
    audit, state = unroll(runs, END, BEGIN)
    audit += finish(state)
    lines = "\n".join(repaired(audit, roles, texts, BEGIN))
    return (*m.row(), cost, audit, hashlib.sha256(lines.encode()).hexdigest())


# ----------------------------------------------------------------- conversations in several segments
def repeats(rest: DataFrame) -> DataFrame:
    """``(part, no, again)``: positions, among a segment's live rows, of rows whose role and
    text stand earlier in the conversation.  Only hashes are shuffled, one row per text and
    conversation after the map side; the rows of a frequent text are joined by a plain key."""
    live = F.filter(F.arrays_zip("role", "text"), lambda x: x["role"].isNotNull())
    one = rest.select("conv", "part", "no", F.posexplode(live).alias("i", "r")).select(
        "part", "no", "i", F.sha2(F.concat(F.coalesce(F.col("conv").cast("string"), F.lit("")), F.lit("|"),
                                           F.col("conv").isNull().cast("string"), F.length("r.role").cast("string"), F.lit(":"),
                                           F.col("r.role"), F.col("r.text")), 256).alias("h"))
    at = F.struct("part", "no", "i")
    first = one.groupBy("h").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("h", "first")
    return (one.join(first, "h").where(at != F.col("first")).groupBy("part", "no")
            .agg(F.collect_set("i").alias("again")))            # at most the rows of a segment


def _symbol_runs(roles, texts, again):
    found = list(faults(roles, texts, set(again or ())))
    return found, runs_of(symbol_of(r, f) for r, f in zip(roles, found))


def repair_cut(rest: DataFrame, result, ws: Workspace) -> DataFrame:
    rest = rest.join(repeats(rest), ["part", "no"], "left")
    marked = ws.stage(rest, "marked")
    key = marked.select("conv").schema
    numbers, light = ArrayType(LongType()), marked.select("conv", "part", "no").schema
    costs_schema, tail_schema = with_fields(light, ("m", numbers)), with_fields(marked.select("part", "no").schema, ("after", numbers))
    done = with_fields(marked.drop("whole").schema, ("exits", numbers), ("audits", ArrayType(StringType())), ("cost", "long"))
    fields = ("conv", "part", "no", "turn", "role", "text", "again")

    def matrices(batches):
        out = Batches(arrow_schema(costs_schema))
        for conv, part, no, turns, roles, texts, again in stream(batches, fields):
            _, roles, texts = _live(turns, roles, texts)
            m = matrix(_symbol_runs(roles, texts, again)[1])
            yield from out.add((conv, part, no, [x for r in m for x in r]), 128)
        yield from out.flush()

    def backwards(batches):                                     # segments of a conversation, last first
        out, at, after = Batches(arrow_schema(tail_schema)), (), END
        for conv, part, no, m in stream(batches, ("conv", "part", "no", "m")):
            if at != (conv,):
                at, after = (conv,), END
            yield from out.add((part, no, list(after)), 32)
            after = apply([m[i:i + 4] for i in range(0, 16, 4)], after)
        yield from out.flush()

    def unrolled(batches):
        out = Batches(arrow_schema(done))
        names = [f.name for f in done][:-3]
        for row in stream(batches, names + ["after"]):
            r = dict(zip(names, row))
            _, roles, texts = _live(r["turn"], r["role"], r["text"])
            runs = _symbol_runs(roles, texts, r["again"])[1]
            after = tuple(row[-1])
            before = apply(matrix(runs), after)
            ways = [unroll(runs, after, s) if before[s] < INF else ("", s) for s in STATES]
            yield from out.add((*row[:-1], [w[1] for w in ways], [w[0] for w in ways], before[BEGIN]),
                               sum(map(len, texts)))
        yield from out.flush()

    def forwards(batches):                                      # segments of a conversation, in order
        out, at, d = Batches(arrow_schema(result)), (), None

        def close():
            tail = finish(d["state"])
            for line in repaired(tail, (), (), d["state"]):
                feed(line)
            audit = "".join(d["audit"]) + tail
            return out.add((*at, *d["m"].row(), d["cost"], audit, d["sha"].hexdigest()), len(audit))

        def feed(line):
            d["sha"].update(("\n" if d["any"] else "").encode() + line.encode())
            d["any"] = True

        for conv, turns, roles, texts, again, exits, audits, cost in stream(
                batches, ("conv", "turn", "role", "text", "again", "exits", "audits", "cost")):
            if at != (conv,):
                if at:
                    yield from close()
                at = (conv,)
                d = {"m": Measures(), "state": BEGIN, "audit": [], "cost": cost, "sha": hashlib.sha256(), "any": False}
            turns, roles, texts = _live(turns, roles, texts)
            found = _symbol_runs(roles, texts, again)[0]
            for t, r, f in zip(turns, roles, found):
                d["m"].add(t, r, f)
            audit = audits[d["state"]]
            for line in repaired(audit, roles, texts, d["state"]):
                feed(line)
            d["audit"].append(audit)
            d["state"] = exits[d["state"]]
        if at:
            yield from close()
        yield from out.flush()

    costs = marked.mapInArrow(matrices, costs_schema)
    tails = gathered(costs, F.desc("part"), F.desc("no")).mapInArrow(backwards, tail_schema)
    ways = marked.drop("whole").join(tails, ["part", "no"]).mapInArrow(unrolled, done)
    return gathered(ways, "part", "no").mapInArrow(forwards, result)


def repair_conversations(rows: DataFrame, size: tuple = (ROWS, BYTES)) -> DataFrame:
    """``rows(conv, turn, role, text)`` as ``damage`` gives them -> one row per conversation:
    its faults, the least cost, the audit and the digest of the repaired text.  ``size``
    bounds the rows and characters of a segment; results do not depend on it."""
    ws = Workspace(rows.sparkSession, "repair")
    seg = segments(rows, ws, *size)
    result = with_fields(rows.select(F.col("conv").alias("conv_id")).schema, *[
        (c, "long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", "string"),
        ("repaired_sha256", "string"))

    def whole(batches):
        out = Batches(arrow_schema(result))
        for conv, turns, roles, texts in stream(batches, ("conv", "turn", "role", "text")):
            row = repair_whole(*_live(turns, roles, texts))
            yield from out.add((conv, *row), len(row[-2]))
        yield from out.flush()

    done = seg.where("whole").mapInArrow(whole, result)
    return ws.finish(done.unionByName(repair_cut(seg.where("NOT whole"), result, ws)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repair_conversations(damage(table(spark, sf_dir, "conversations")))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
SQL: dict = {}
