"""Text operators on small made inputs: brute force, edge rows, round trips."""
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from csvforge.llm import (jaccard, language, licenses, mixing, packing, paragraphs, phrases, quality, rendering,
                          sigtree, tokens)
from csvforge.llm.common import Workspace
from csvforge.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, `key` string, n_words int"
VOWELS, CONS = "aeiou", "bcdfglmnprst"


def word(rnd):
    return "".join(rnd.choice(CONS) + rnd.choice(VOWELS) for _ in range(rnd.randint(1, 4)))


def prose(rnd, n):
    return " ".join(word(rnd) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, empty, long and repeated rows."""
    rnd = random.Random(5)
    out = []
    for i in range(40):
        out.append(prose(rnd, rnd.randint(1, 160)))
    base = prose(rnd, 120)
    for i in range(12):
        w = base.split()
        for _ in range(i % 4):
            w[rnd.randrange(len(w))] = word(rnd)
        out.append(" ".join(w))
    passage = prose(rnd, 70)
    for i in range(6):
        out.append(f"{prose(rnd, 90)} {passage} {prose(rnd, 60)}")
    out += [None, "", "  \n\t ", "one", "two words", "!!! ### 12", prose(rnd, 6000), "a" * 5000, base, base]
    table = [(i, t, ("en", "fr")[i % 2] if i % 7 else None, f"src{i % 5}" if i % 11 else None,
              len(t or ""), "x", "y", 3) for i, t in enumerate(out)]
    return table + [table[3], (None, out[4], None, None, 1, "x", "y", 3), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def staged(spark, docs):
    return Workspace(spark, "tests").stage(docs, "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(up))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def linked(rows, k, num, den):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        inter = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("block", [4, 1024])
def test_jaccard_against_brute_force(staged, rows, block):
    sets, roots = linked(rows, 3, 90, 100)
    low = {}
    for r, c in zip(rows, roots):
        if r[0] is not None:
            low[c] = min(low.get(c, r[0]), r[0])
    want = sorted(((r[0], len(s), low.get(c)) for r, s, c in zip(rows, sets, roots)), key=str)
    got = jaccard.near_duplicates(staged, k=3, num=90, den=100, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_one_of_each_keeps_one_row_of_a_group(staged, rows):
    _, roots = linked(rows, 5, 8, 10)
    out = jaccard.one_of_each(staged)
    assert out.columns == staged.columns and out.count() == len(set(roots))


def test_tree_traversal_finds_all_pairs():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = [np.unique(rnd.choice(pool, rnd.integers(5, 60))) for _ in range(150)]
    sets += [np.unique(np.append(s[1:], np.uint64(i))) for i, s in enumerate(sets[:60])]
    bits = np.stack([sigtree.bitmap(s) for s in sets])
    n = np.array([len(s) for s in sets])
    i, j = sigtree.candidate_pairs(bits, n, np.arange(len(sets)), 8, 10)
    found = {frozenset(p) for p in zip(i.tolist(), j.tolist())}
    for a, b in itertools.combinations(range(len(sets)), 2):
        inter = len(np.intersect1d(sets[a], sets[b]))
        if 10 * inter >= 8 * (n[a] + n[b] - inter):
            assert frozenset((a, b)) in found
            assert sigtree.fine_may_reach(sigtree.fine_bitmap(sets[a]), sigtree.fine_bitmap(sets[b]), n[a], n[b], 8, 10)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {}
    for a, b in edges * 60:
        m = min(root.get(a, a), root.get(b, b))
        root[a] = root[b] = m
    ws = Workspace(spark, "cc")
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), ws).collect()}
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long"), ws).count() == 0


def test_repeated_passages_are_cut(staged, rows):
    spans = paragraphs.repeated_passages(staged).collect()
    assert spans and all(r.n_words >= 50 for r in spans)
    out = [r.text for r in paragraphs.remove_repeats(staged).collect()]
    windows = [{" ".join(w[i:i + 56]) for i in range(len(w) - 55)} for w in ((t or "").split() for t in out)]
    assert not any(a & b for a, b in itertools.combinations(windows, 2))
    alone = [r[1] for r in rows[:40] if len(r[1].split()) > 60]
    assert all(t in out for t in alone[4:])
    assert paragraphs.bands_for(0.8, 0.95) == 2 and paragraphs.bands_for(0.8, 0.99, 2) == 5
    assert paragraphs.cut_words("a b\n c d", [(1, 2), (2, 1)]) == "a d"


def test_passages_in_templates_are_not_repeats(spark):
    rnd = random.Random(11)
    shared = [prose(rnd, 25) for _ in range(12)]
    texts = [" ".join(f"{line} {prose(rnd, 10)}" for line in shared) for _ in range(2)]
    df = Workspace(spark, "tests").stage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "templates")
    assert paragraphs.repeated_passages(df).count() == 0
    assert sorted(r.text for r in paragraphs.remove_repeats(df).collect()) == sorted(texts)


def test_short_passages_and_near_copies_at_every_offset(spark):
    rnd = random.Random(12)
    texts, want = [], []
    for i in range(60):
        exact, near = prose(rnd, 51), prose(rnd, 60).split()
        edited = near[:i] + [word(rnd) + "x"] + near[i + 1:]
        texts += [f"{prose(rnd, 30)} {exact} {prose(rnd, 20)}", f"{prose(rnd, i)} {exact} {prose(rnd, 25)}".strip(),
                  f"{prose(rnd, 30)} {' '.join(near)} {prose(rnd, 20)}", f"{prose(rnd, 9)} {' '.join(edited)} {prose(rnd, 25)}"]
        want += [4 * i + 1, 4 * i + 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in paragraphs.repeated_passages(Workspace(spark, "tests").stage(df, "short")).collect()}
    assert sorted(got) == want and all(r.kept_doc_id == d - 1 for d, r in got.items())
    assert all(got[4 * i + 1].first_word <= i <= i + 51 <= got[4 * i + 1].first_word + got[4 * i + 1].n_words for i in range(60))
    for i in range(10, 50):
        assert (got[4 * i + 3].first_word, got[4 * i + 3].n_words) == (9, 60)


def test_passages_behind_a_frequent_phrase_are_found(spark):
    rnd = random.Random(13)
    phrase, texts, want = prose(rnd, 45), [], []
    for i in range(12):
        tail = prose(rnd, 5)
        for _ in range(2 if i > 2 else 1):             # the first three have no copy
            want += [len(texts)] if texts and tail in texts[-1] else []
            texts.append(f"{prose(rnd, 20)} {phrase} {tail} {prose(rnd, 20)}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = paragraphs.repeated_passages(Workspace(spark, "tests").stage(df, "phrase")).collect()
    assert sorted(r.doc_id for r in got) == want and all((r.kept_doc_id, r.first_word, r.n_words) == (r.doc_id - 1, 20, 50) for r in got)


def test_token_counts_equal_the_library(docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as P
    tk = tokenizers.Tokenizer.from_file(P.path(tokens.VOCABULARY))
    odd = ["x<|endoftext|>y <|startoftext|> it's WE'LL 3,14", "é é ́a", "a b c\x1cd", "日本語 text"]
    plain = [r[1] or "" for r in rows] + odd
    assert tokens.count_texts(plain, tokens.VOCABULARY, "space") == [
        len(e.ids) for e in tk.encode_batch(plain, add_special_tokens=False)]
    got = tokens.token_counts(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_bytes) for r in got} == {(r[0], len((r[1] or "").encode())) for r in rows}
    assert "".join(tokens._parts("ab cd\nef gh", 3)) == "abcdefgh"


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_vocabularies(docs, rows, vocabulary):
    """The boundary comes from the vocabulary file, so no vocabulary is counted wrongly."""
    pytest.importorskip("tokenizers")
    plain = [r[1] or "" for r in rows] + ["two  Words,\n3 x", " ", "\n", "a<|endoftext|>b"]
    want = [len(x) for x in tokens.load(vocabulary)(plain)]
    assert tokens.count_texts(plain, vocabulary) == want
    assert tokens.boundary_of(vocabulary) == ("space" if vocabulary.startswith("word") else None)
    got = tokens.token_counts(docs, vocabulary=vocabulary).collect()
    assert sorted(r.n_tokens for r in got) == sorted(want[:len(rows)])


def test_encoded_words_in_parts_and_without_a_separator(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    rnd = random.Random(21)
    encode = tokens.load(tokens.VOCABULARY)
    texts = [prose(rnd, rnd.randint(0, 400)) + rnd.choice(["", "\n", " <|endoftext|>x", "  "]) for _ in range(40)] + ["", " ", "é" * 300]
    want = encode(texts)
    for run_bytes, kept in ((200, 30), (1 << 22, 10**6)):
        monkeypatch.setattr(tokens, "RUN_BYTES", run_bytes)
        monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
        assert [x.tolist() for x in tokens.encode_words(texts, tokens.VOCABULARY)] == want
    tokens._TABLES.clear()
    monkeypatch.setattr(tokens, "separator", lambda v: None)
    assert [x.tolist() for x in tokens.encode_words(texts, tokens.VOCABULARY)] == want
    tokens._TABLES.clear()


def test_packing_is_gapless(docs, rows):
    out = packing.pack_documents(docs, length=64, group_pieces=50).toPandas()
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 64
    n = tokens.count_texts([r[1] or "" for r in rows], tokens.VOCABULARY, "space")
    assert out.length.sum() == sum(n) + len(rows)
    assert out[out.doc_id == 42].length.tolist()[:-1] == [64] * (len(out[out.doc_id == 42]) - 1)


def test_pieces_are_the_librarys_ids(docs, rows):
    """piece, start, length and ids_crc32 against whole texts encoded by the library."""
    encode, want = tokens.load(tokens.VOCABULARY), []
    for r in rows:
        ids = [*encode([r[1] or ""])[0], packing.END_ID]
        for k in range(0, len(ids), 64):
            part = np.asarray(ids[k:k + 64], "<u4")
            want.append((r[0], k // 64, k, len(part), zlib.crc32(part.tobytes())))
    got = packing.pieces(docs, length=64).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_local_search_drains_bins():
    rnd = random.Random(1)
    for _ in range(30):
        sizes = np.array([rnd.randint(1, 60) for _ in range(60)])
        first = [[i] for i in range(60)]
        found = packing.local_search([list(b) for b in first], sizes, 100)
        assert sorted(i for b in found for i in b) == list(range(60))
        assert all(sizes[b].sum() <= 100 for b in found)
        assert len(found) <= math.ceil(sizes.sum() / 100) + 2


def test_language_forward_backward_and_labels(spark):
    rnd = np.random.default_rng(0)
    emit, trans = rnd.normal(size=(200, 3)), rnd.normal(size=(3, 3))
    post, moves = language.Chain(np.array([1, 150, 0, 49])).run(emit, trans, True)
    at = 0
    for n in (1, 150, 49):
        e = emit[at:at + n]
        a, b = np.zeros((n, 3)), np.zeros((n, 3))
        a[0] = e[0]
        for t in range(1, n):
            a[t] = e[t] + np.log(np.exp(a[t - 1][:, None] + trans).sum(0))
        for t in range(n - 2, -1, -1):
            b[t] = np.log(np.exp(trans + e[t + 1] + b[t + 1]).sum(1))
        p = np.exp(a + b - (a + b).max(1, keepdims=True))
        assert np.allclose(post[at:at + n], p / p.sum(1, keepdims=True), atol=1e-9)
        at += n
    assert np.isclose(moves.sum(), 149 + 48)
    r = random.Random(4)
    texts = [" ".join(r.choice(CONS) + r.choice(v) * 2 + e for _ in range(30)) for v, e in [("ae", "th"), ("ou", "ng")] * 20]
    made = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate(texts)] + [(90, None, "x"), (91, "12 !", "y")],
                                 "doc_id long, text string, lang string")
    model = language.train(made)
    got = {x.doc_id: x for x in language.identify(made, model).collect()}
    assert all(got[i].lang_pred == "xy"[i % 2] and 0.5 < got[i].score <= 1 for i in range(40))
    assert [(got[i].lang_pred, got[i].score) for i in (90, 91)] == [("und", 0.0)] * 2
    words, (p,) = model.label([texts[0] + " " + texts[1]])
    assert p[:25].argmax(1).tolist() == [0] * 25 and p[-25:].argmax(1).tolist() == [1] * 25
    assert language.keep_identified(made).columns == made.columns and language.keep_identified(made).count() == 40
    assert language.train(made.where("lang IS NULL")) is None


def test_phrase_fingerprints(staged, rows):
    got = phrases.edited_pairs(staged).collect()
    order = sorted(((r[0] if r[0] is not None else phrases.LOWEST, r[1] or "") for r in rows))
    want = []
    for i, (k, t) in enumerate(order):
        n, x = len(t), order[(i + 1) % len(order)][1]
        own, edited, nxt = (phrases.signature(s) for s in (t, t[:n - n // 2] + x[:n // 2], x))
        want.append((None if k == phrases.LOWEST else k, n, phrases.text_of(own), phrases.text_of(edited),
                     phrases.likeness(own, edited), phrases.likeness(own, nxt)))
    assert sorted(((r.doc_id, r.n_chars, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                   for r in got), key=str) == sorted(want, key=str)
    seen, ends, s, at = set(), [], "abababcabcabababab", 0
    while at < len(s):                                    # textbook parse
        e = at + 1
        while e <= len(s) and s[at:e] in seen:
            e += 1
        if e > len(s):
            break
        seen.add(s[at:e])
        ends.append(e)
        at = e
    mine = []
    phrases.parse(s, 0, set(), mine)
    assert mine == ends


def test_rendering():
    r = rendering.render
    assert r(None) == r("") == ("", "")
    assert r("<title>A &amp; B</title><p>one<b> two<p>three <br>four") == ("A & B", "one two\n\nthree\nfour")
    assert r("<ul><li>x<li>y<ol start=3><li>z</ol></ul>")[1] == "- x\n- y\n  3. z"
    assert r("<table><tr><th>a<th>long<tr><td>cccc<td>d</table>")[1] == "a     long\ncccc  d"
    assert r("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>")[1] == "a  b\n   c"
    assert r("a<div hidden>no</div><div style='display:none'>no<p>no</div>b<script>if(a<b)</script><!-- x -->c")[1] == "abc"
    assert r("<div style='visibility:hidden'>no<span style='visibility:visible'>yes</span></div>")[1] == "yes"
    assert r("<pre>\n a\n  b</pre>x  y")[1] == " a\n  b\n\nx y"
    assert "deep" in r("<div>" * 5000 + "deep")[1]
    assert r("a < b <a href=\"x\" title='>'>link</a> </nope> &lt;")[1] == "a < b link <"


def test_rendering_of_formulas_drawings_and_long_attributes():
    r = rendering.render
    assert r("a <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation>"
             "<annotation-xml><mi>no</mi></annotation-xml></semantics></math> b")[1] == "a x=2 b"
    assert r("<p>a</p><svg><title>no</title><desc>no</desc><defs><text>no</text></defs><style>no{}</style><g><text>one "
             "<tspan>two</tspan></text><path d='M0'/><text x=1>three</text></g></svg><p>b</p>") == ("", "a\n\none two three\n\nb")
    assert r("<title>T</title><svg><title>no</title></svg>x") == ("T", "x")
    for q, size in (('"', 100_000), ("'", 1_000_000)):
        assert r(f"a<iframe srcdoc={q}{'<p>no</p>' * (size // 9 + 1)}{q}></iframe>b <i title={q}x>y{q}>c</i>")[1] == "ab c"


def test_quality_and_licenses_edge_rows(docs, rows, empty):
    led = quality.ledger(docs).cache()
    out = quality.verdict(led)
    assert out.count() == len(rows)
    bad = {r.doc_id for r in out.where("n_words = 0").collect()}
    assert {52 + 6, 59, 60} <= bad | {58} and out.where("n_words = 0 AND kept").count() == 0
    for r in quality.ablation(led).collect():
        mask = quality.mask(quality.POLICIES[r.policy])
        own = quality.mask([r.rule])
        bits = [x.fail_bits for x in led.collect()]
        assert (r.n_failed, r.n_only, r.n_kept) == (sum(b & own != 0 for b in bits), sum(b & mask == own for b in bits),
                                                    sum(b & mask == 0 for b in bits))
    spark = docs.sparkSession
    notice = spark.createDataFrame([(1, "x y. This work is licensed under the GNU General Public License, version 3."),
                                    (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, "mit license MIT License")],
                                   "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(notice).collect()}
    assert (got[1].base_labels, got[1].labels, got[1].first_word, got[1].score) == ("gpl", "gpl", 9, 1.0)
    assert (got[2].base_labels, got[2].labels, got[2].n_base, got[2].score) == ("", "cc-by-nc", 0, 1.0)
    assert (got[3].n_words, got[3].labels, got[3].score, got[3].first_word) == (0, "", 0.0, None)
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 0, 2)


def test_mixing_rules(spark, docs):
    full = mixing.mix_sources(docs, max_epochs=1, share=(1, 1)).count()
    assert full == docs.count()                           # everything fits when each is read once
    part = mixing.mixed_rows(docs, max_epochs=1, share=(1, 2))
    assert part.columns == docs.columns and 0 < part.count() < docs.count()
    # domain a is short; its rest goes to its language's sibling source before other domains
    made = spark.createDataFrame([(i, "w " * 10, "en", "src0" if i < 2 else ("src4" if i < 30 else "src1")) for i in range(60)],
                                 "doc_id long, text string, lang string, source string")
    weights = {"domain": {"web": 1, "books": 1}, "language": {}, "source": {}}
    got = {r.source: r for r in mixing.mix_sources(made, weights=weights, max_epochs=1, share=(1, 2))
           .groupBy("source").agg({"n_tokens": "sum", "budget": "max"}).collect()}
    assert got["src0"]["max(budget)"] == 20 and got["src4"]["max(budget)"] == 130 and got["src1"]["max(budget)"] == 150


def test_empty_tables(empty):
    assert tokens.token_counts(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0
    assert paragraphs.repeated_passages(empty).count() == 0
    assert paragraphs.remove_repeats(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert language.keep_identified(empty).count() == 0
    assert phrases.edited_pairs(empty).count() == 0
    assert quality.verdict(quality.ledger(empty)).count() == 0
    assert licenses.scan(empty).count() == 0
    assert rendering.render_pages(empty, html="text", columns=("doc_id",)).count() == 0
