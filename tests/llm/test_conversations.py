"""Chat formatting and conversation repair against direct restatements."""
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from csvforge.llm import chat, repair
from csvforge.llm.common import Workspace

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, no string, whole string"
BLANK = " \t\n\x0b\x0c\r"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    """Nulls everywhere, blanks, repeated rows and turns, control strings, a long conversation,
    a very long text, conversations of one row."""
    rnd = random.Random(3)
    texts = ["Fine.", "so it goes", "", "  \n", "What? Yes!", "a <|im_end|> b <\\|im_start|> c.", "<", "|", "<\\\\|x.", "é́ 日本.", None]
    roles = ["user", "assistant", "system", "tool", "", None, "a\nb\\n<|", "user", "assistant", "user", "assistant"]
    out = []
    for c in range(60):
        for t in range(rnd.choice([1, 2, 3, 8, 8, 20])):
            out.append((c, t * rnd.choice([1, 1, 1, 2]), rnd.choice(roles), rnd.choice(texts) if rnd.random() < .5 else f"w{rnd.randrange(40)}."))
    out += [(100, t, ("user", "assistant")[t % 2] if t else "system", f"turn {t % 90} " * (t % 7) + "end.") for t in range(700)]
    out += [(101, 0, "user", "word " * 30000), (101, 1, "assistant", "x" * 50000)]
    out += [(102, None, "user", "a."), (102, None, "user", "a."), (102, None, "assistant", "b."), (102, 3, None, None)]
    out += [(None, 0, "user", "q?"), (None, 1, "assistant", "a."), (None, None, "system", "s.")]
    out += [(103, 1, "user", "same.")] * 40
    return [(*r, "x", 1, "y", "z") for r in out]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@functools.cache
def _xx(spark, text):
    return spark.sql("SELECT xxhash64(:t) AS h", args={"t": text}).first().h


def in_order(spark, rows):
    """Conversations with their rows by turn (nulls first), role, head and hash of the text."""
    head = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32])
    rows = sorted(rows, key=head)
    tied = {k for k, g in itertools.groupby(rows, head) if len(set(g)) > 1}
    return sorted(rows, key=lambda r: (*head(r), _xx(spark, r[2]) if head(r) in tied else 0))


def conversations(spark, rows, null):
    out = {}
    for c, t, r, x, *_ in rows:
        out.setdefault(c, []).append((t, null if r is None else r, null if x is None else x))
    return {c: in_order(spark, g) for c, g in out.items()}


# ----------------------------------------------------------------- operator 12
@pytest.mark.parametrize("size", [(1024, 4 << 20), (16, 500)])
def test_formatted_windows_read_back(spark, frame, rows, size):
    ws = Workspace(spark, "tests")
    windows = ws.stage(chat.format_windows(frame, budget=120, history=40, size=size, ws=ws), "windows")
    got = {r.conv_id: r for r in chat.conversation_digests(windows, ws).collect()}
    want = conversations(spark, rows, "")
    assert got.keys() == want.keys()
    for c, turns in want.items():
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
    counts = {}
    for w in windows.collect():
        turns = chat.read_turns(w.text)
        assert len(turns) == w.n_repeated + w.n_new and w.n_new > 0
        n = chat.count_texts([chat.turn_text(*t)[0] for t in turns], chat.VOCABULARY, "space")
        assert sum(n) == w.n_tokens == chat.count_texts([w.text], chat.VOCABULARY, "space")[0]
        assert (w.n_tokens > 120) == w.over_budget and (not w.over_budget or w.n_new == 1)
        if want[w.conv][0][1] == "system":                     # every window retains the system turn
            assert turns[0] == ("system", want[w.conv][0][2])
        lead = 1 if want[w.conv][0][1] == "system" and w.n_repeated else 0
        assert sum(n[lead:w.n_repeated]) <= 40
        counts[w.conv] = counts.get(w.conv, 0) + w.n_new
    assert counts == {c: len(t) for c, t in want.items()}


def test_windows_do_not_depend_on_how_rows_are_dealt(spark, rows):
    made = []
    for parts in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", 3 * parts)
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        out = chat.format_windows(df, budget=120, history=40, size=(64, 3000))
        made.append(sorted((str((r.conv, r.a, r.b, r.window)), r.n_repeated, r.text, r.loss) for r in out.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert made[0] == made[1]


def test_escaping_is_reversible():
    rnd = random.Random(1)
    for _ in range(4000):
        s = "".join(rnd.choice(["<", "|", "\\", "im_start", "im_end", "|>", "\n", "a"]) for _ in range(rnd.randrange(9)))
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
        assert chat.unescape_role(chat.escape_role(s)) == s and "\n" not in chat.escape_role(s)
        assert chat.read_turns(chat.turn_text(s, s)[0] + chat.turn_text("user", "")[0]) == [(s, s), ("user", "")]


def test_spans_keep_the_budget():
    got = list(chat.spans([3, 4, 4, 4, 30, 2, 2], 3, 1, 12, 5))
    assert got == [(0, 0, 3, False), (2, 3, 4, False), (4, 4, 5, True), (5, 5, 7, False)]


def test_chat_query_on_a_table(spark, tmp, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op12_chat_formatting(spark, tmp).collect()}
    c = chat.CONTROL
    assert (got[-1].n_turns, got[-1].turns_sha256, got[-1].loss_chars, got[-1].loss_sha256) == (
        2, sha(f"user\n{c}\nassistant\n{c}\n"), len(c), sha(c))
    assert len(got) == len({r[0] for r in rows}) + 1
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp}/none/conversations.parquet")
    assert [r.conv_id for r in chat.op12_chat_formatting(spark, f"{tmp}/none").collect()] == [-1]


# ----------------------------------------------------------------- operator 13
def damaged(conv, turn, role, text):
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    k = zlib.crc32(key.encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if k == 1:
        text = ""
    if k == 2:
        text = re.sub("[.!?]", "", text)
    row = (turn, "user" if k == 4 else role, text)
    return [] if k == 0 else [row, row] if k == 3 else [row]


def faults(turns):
    seen, out = set(), []
    for _, r, x in turns:
        solid = x.strip(BLANK)
        out.append("blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((r, x))
    return out


def cheapest(turns, found):
    """Least (cost, audit, lines) by a plain search over rows and the initials kept so far."""
    legal = lambda s: re.fullmatch("s?(ua)*u?", s)

    @functools.cache
    def best(i, last, inserted):
        options = []
        if i == len(turns) and last in ("", "a"):
            options.append((0, "", ()))

        def go(letter, cost, kept, line, j, ins):
            if kept:
                full = {"": "", "s": "s", "u": "u", "a": "ua"}[last] + kept
                if not legal(full):
                    return
                nxt = {"s": "s", "u": "u", "a": "a"}[kept]
            else:
                nxt = last
            c, a, rest = best(j, nxt, ins)
            options.append((cost + c, letter + a, ((line,) if line is not None else ()) + rest))

        if inserted < 3:
            for kind, name in (("u", "user"), ("a", "assistant")):
                go("I", 3, kind, f"{name}:", i, inserted + 1)
        if i < len(turns):
            _, role, text = turns[i]
            go("D", 4, "", None, i + 1, 0)
            if found[i] not in ("blank", "duplicate"):
                extra = 3 if found[i] == "truncated" else 0
                if role[:1] in ("s", "u", "a") and role[:1]:
                    go("K", extra, role[:1], f"{role}:{text}", i + 1, 0)
                for kind, name in (("u", "user"), ("a", "assistant")):
                    go("R", 3 + extra, kind, f"{name}:{text}", i + 1, 0)
        return min(options, default=(1 << 50, "", ()))

    # bounded recursion: settle the rows from the end first
    for i in range(len(turns), -1, -1):
        for last in ("", "s", "u", "a"):
            for ins in (3, 2, 1, 0):
                best(i, last, ins)
    return best(0, "", 0)


def expected(turns):
    found = faults(turns)
    cost, audit, lines = cheapest(turns, found)
    known = sorted({t for t, _, _ in turns if t is not None})
    return (known[-1] - known[0] + 1 - len(known) if known else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])), cost, audit, sha("\n".join(lines)))


@pytest.mark.parametrize("size", [(1024, 4 << 20), (16, 500)])
def test_repair_equals_a_plain_search(spark, tmp, frame, rows, size):
    want = {r[0]: [] for r in rows}
    for c, t, r, x, *_ in rows:
        want[c] += damaged(c, t, r, x)
    want = {c: expected(in_order(spark, g)) for c, g in want.items()}
    got = repair.repair_conversations(repair.damage(frame), size=size).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_repair_query_columns_and_empty_table(spark, tmp):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp}/conversations.parquet")
    out = repair.op13_conversation_repair(spark, tmp)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert out.count() == 0


def test_a_conversation_that_loses_all_rows(spark):
    gone = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    df = spark.createDataFrame([(c, t, "user", "x.") for c, t in gone], "conv_id long, turn long, role string, text string")
    for r in repair.repair_conversations(repair.damage(df)).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))


def test_run_length_costs_and_audits():
    rnd = random.Random(9)
    for n in list(range(7)) * 30 + [200, 3000]:
        kinds = [rnd.choice([("user", "x."), ("assistant", "y."), ("system", "s."), ("tool", "t."), ("user", "cut"), ("user", "")])
                 for _ in range(n // 3 + 1) for _ in range(3)][:n] if n > 6 else [
            rnd.choice([("user", "x."), ("assistant", "y."), ("system", "s."), ("tool", "cut"), ("user", "")]) for _ in range(n)]
        turns = [(i, *k) for i, k in enumerate(kinds)]
        assert repair.repair_whole(*map(list, zip(*turns))) == expected(turns) if turns else True
    assert repair.matrix([("u", 1000)]) == functools.reduce(repair.product, [repair.power("u", 0)] * 1000)
    assert repair.before_run("at", 77, repair.END) == repair.apply(repair.matrix([("at", 77)]), repair.END)
