"""Operator 4: language identification by a linear-chain conditional random field.

Words are labelled with languages; neighbouring labels are tied by learned
transitions, so code-switched text is cut where the language changes.  A word's
features are its affixes, its letter bi- and trigrams and its presence in the
lexicons of frequent words, hashed to a fixed number of weights.

* Training takes a bounded sample (``train_docs`` whole documents per language, by
  a hash of the id) on the driver.  Its texts are cut into short runs of words and
  strung together across languages, so transitions see real switches.  The
  gradient is exact (forward-backward), the steps are AdaGrad.
* Prediction is one narrow Arrow pass.  Emissions are computed once per distinct
  word; forward-backward runs over 64-word segments of all texts at once, joined
  by their transfer matrices, so a very long text costs no long Python loop.
* A document's language is the label with the largest expected number of words,
  its score that share.

Text that is null or has no letter is ``und`` with score 0, as is everything when
no labelled row exists.  Ties go to the first language in alphabetical order.
Repeated rows and other columns do not matter; a null id counts as the empty
string.
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BATCH, prepare, table, tidy, with_fields
from .textnum import PIECE, U, mix, slices

TRAIN_DOCS = 100              # documents per language in the training sample (expected)
TRAIN_WORDS = 120_000         # words of the sample used at most
MAX_LANGUAGES = 1000          # label values a model is built for
LEXICON = 200                 # frequent words per language
HASH_BITS = 15
STEPS = 24
SEGMENT = 64
KEPT_WORDS = 100_000          # words whose emissions a task remembers
FEATURE_WORDS = 20_000        # words whose features are computed at a time
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def features(words: list[str], lexicon: dict):
    """(feature, word) index pairs: the first and last two to four characters of each
    word with its edge marks, all its bi- and trigrams, and the lexicons it is in."""
    marked = [f"^{w}$" for w in words]
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    end = np.cumsum(n)
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(U)
    word = np.repeat(np.arange(len(n)), n)
    left = np.repeat(end, n) - np.arange(len(code))        # characters from here to the word's end
    hashes, owners = [], []
    with np.errstate(over="ignore"):
        gram = code
        for k in (2, 3, 4):
            gram = mix(gram[:-1] + mix(code[k - 1:] + U(k)))
            inside = left[:len(gram)] >= k
            if k < 4:
                at = np.flatnonzero(inside)
                hashes.append(gram[at])
                owners.append(word[at])
            has = np.flatnonzero(n >= k)
            hashes += [gram[end[has] - n[has]] + U(1), gram[end[has] - k] + U(2)]
            owners += [has, has]
    known = [(i, y) for i, w in enumerate(words) for y in lexicon.get(w, ())]
    if known:
        i, y = np.array(known).T
        hashes.append(mix(y.astype(U)))
        owners.append(i)
    cells = mix(np.concatenate(hashes)) & U((1 << HASH_BITS) - 1)
    return cells.astype(np.int64), np.concatenate(owners)


def _summed(weights: np.ndarray, cells: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights[cells, j], n) for j in range(weights.shape[1])], axis=1)


class Chain:
    """Forward-backward over many sequences laid end to end."""

    def __init__(self, lengths: np.ndarray):
        lengths = lengths[lengths > 0]
        self.seq = lengths
        n_seg = -(-lengths // SEGMENT)
        self.ordinal = np.arange(n_seg.sum()) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
        begin = np.repeat(np.cumsum(lengths) - lengths, n_seg) + self.ordinal * SEGMENT
        self.len = np.minimum(SEGMENT, np.repeat(np.cumsum(lengths), n_seg) - begin)
        self.begin, self.head = begin, self.ordinal == 0
        self.owner = np.repeat(np.arange(len(lengths)), n_seg)
        self.last = np.append(self.head[1:], True)

    def run(self, emit: np.ndarray, trans: np.ndarray, pairs: bool = False):
        """Posterior labels (one row per word) and, if asked, expected transitions."""
        n, k = len(self.begin), trans.shape[0]
        a = np.exp(trans - trans.max())
        b = np.exp(emit - emit.max(axis=1, keepdims=True))
        steps = int(self.len.max())
        at = [np.minimum(self.begin + t, len(b) - 1) for t in range(steps)]
        on = [t < self.len for t in range(steps)]
        move = np.zeros((n, k, k))                          # transfer matrix of each segment
        for t in range(steps):
            e = b[at[t]][:, None, :]
            if t == 0:
                move = np.where(self.head[:, None, None], 1.0 / k, a[None]) * e
            else:
                new = (move.reshape(-1, k) @ a).reshape(n, k, k) * e
                move = np.where(on[t][:, None, None], new, move)
            if t % 8 == 7 or t == steps - 1:
                move /= np.maximum(move.max(axis=(1, 2), keepdims=True), 1e-300)
        into, out = np.full((n, k), 1.0 / k), np.ones((n, k))
        order = np.argsort(self.ordinal, kind="stable")
        edges = np.searchsorted(self.ordinal[order], np.arange(1, self.ordinal.max() + 2))
        for i in range(len(edges) - 1):
            s = order[edges[i]:edges[i + 1]]
            v = np.einsum("ij,ijk->ik", into[s - 1], move[s - 1])
            into[s] = v / np.maximum(v.sum(axis=1, keepdims=True), 1e-300)
        for i in range(len(edges) - 2, -1, -1):
            s = order[edges[i]:edges[i + 1]]
            v = np.einsum("ijk,ik->ij", move[s], out[s])
            out[s - 1] = v / np.maximum(v.max(axis=1, keepdims=True), 1e-300)
        alpha, v = np.zeros((steps, n, k)), into
        for t in range(steps):
            lead = np.where(self.head[:, None], 1.0 / k, v @ a) if t == 0 else v @ a
            new = lead * b[at[t]]
            new /= np.maximum(new.sum(axis=1, keepdims=True), 1e-300)
            v = np.where(on[t][:, None], new, v)
            alpha[t] = v
        post, beta, moves = np.zeros((len(b), k)), out, np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            live = on[t]
            p = alpha[t] * beta
            p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
            post[self.begin[live] + t] = p[live]
            x = b[at[t]] * beta
            if pairs:
                m = live if t else live & ~self.head
                before = (alpha[t - 1] if t else into)[m]
                joint = before[:, :, None] * a[None] * x[m][:, None, :]
                joint /= np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)
                moves += joint.sum(axis=0)
            new = x @ a.T
            new /= np.maximum(new.max(axis=1, keepdims=True), 1e-300)
            beta = np.where(live[:, None], new, beta)
        return post, moves


class Model:
    """Weights, transitions and lexicons; labels words and texts."""

    def __init__(self, langs: list[str]):
        self.langs, self.lexicon = langs, {}
        self.weights = np.zeros((1 << HASH_BITS, len(langs)))
        self.trans = np.zeros((len(langs), len(langs)))

    def emissions(self, words: list[str]) -> np.ndarray:
        parts = [words[a:a + FEATURE_WORDS] for a in range(0, len(words), FEATURE_WORDS)]
        return np.concatenate([_summed(self.weights, *features(p, self.lexicon), len(p)) for p in parts])

    def fit(self, texts: list[str], labels: list[str], steps: int = STEPS, most: int = TRAIN_WORDS) -> "Model":
        rng = np.random.default_rng(7)
        runs, counts = [], [Counter() for _ in self.langs]
        for text, lang in zip(texts, labels):
            w, y, at = words_of(text), self.langs.index(lang), 0
            while at < len(w):
                k = int(rng.integers(4, 40))
                runs.append((w[at:at + k], y))
                at += k
        runs = [runs[i] for i in rng.permutation(len(runs))]
        total = np.cumsum([len(r) for r, _ in runs])
        runs = runs[:max(1, int(np.searchsorted(total, most)))]
        for r, y in runs:
            counts[y].update(r)
        for y, c in enumerate(counts):
            for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
                self.lexicon.setdefault(w, []).append(y)
        words = [w for r, _ in runs for w in r]
        gold = np.concatenate([np.full(len(r), y) for r, y in runs])
        seq = np.array([sum(len(r) for r, _ in runs[i:i + 6]) for i in range(0, len(runs), 6)])
        vocab = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter((vocab[w] for w in words), np.int64, len(words))
        flat, owner = features(list(vocab), self.lexicon)
        chain, k = Chain(seq), len(self.langs)
        inside = np.ones(len(gold), bool)
        inside[np.cumsum(seq) - seq] = False
        seen = np.zeros((k, k))
        np.add.at(seen, (gold[:-1][inside[1:]], gold[1:][inside[1:]]), 1)
        gw, gt = np.full_like(self.weights, 1e-8), np.full_like(self.trans, 1e-8)
        for _ in range(steps):
            emit = _summed(self.weights, flat, owner, len(vocab))
            post, moves = chain.run(emit[ids], self.trans, pairs=True)
            miss = -post
            miss[np.arange(len(gold)), gold] += 1
            word = np.stack([np.bincount(ids, miss[:, j], len(vocab)) for j in range(k)], axis=1)
            g = np.stack([np.bincount(flat, word[owner, j], len(self.weights)) for j in range(k)], axis=1) / len(gold)
            g -= 1e-5 * self.weights
            gw += g * g
            self.weights += 0.3 * g / np.sqrt(gw)
            d = (seen - moves) / len(gold)
            gt += d * d
            self.trans += 0.3 * d / np.sqrt(gt)
        return self

    def label(self, texts: list[str], memory: dict | None = None):
        """Per text: words, and posterior label probabilities (words x languages).

        ``memory`` holds the emissions of words met before in the same task."""
        words = [words_of(t) for t in texts]
        memory = {} if memory is None else memory
        known, rows = memory.get("known", {}), memory.get("rows", np.zeros((0, len(self.langs)), np.float32))
        if len(known) > KEPT_WORDS:
            known, rows = {}, rows[:0]
        new = list({w for t in words for w in t}.difference(known))
        if new:
            known.update(zip(new, range(len(rows), len(rows) + len(new))))
            rows = np.concatenate([rows, self.emissions(new).astype(np.float32)])
        memory.update(known=known, rows=rows)
        ids = [np.fromiter(map(known.__getitem__, t), np.int64, len(t)) for t in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        if not n.sum():
            return words, [np.zeros((0, len(self.langs)))] * len(texts)
        post, _ = Chain(n).run(rows[np.concatenate(ids)], self.trans)
        return words, np.split(post, np.cumsum(n)[:-1])


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          train_docs: int = TRAIN_DOCS, max_languages: int = MAX_LANGUAGES, **options) -> Model | None:
    """A model learned from a bounded sample of ``df``; None without labelled rows."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = rows.groupBy(F.col(lang).alias("l")).count().limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} language values")
    if not found:
        return None
    share = F.lit(0)
    for r in found:
        part = min(1.0, train_docs / r["count"])
        share = F.when(F.col(lang) == r["l"], int(part * (1 << 31))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit(11), F.col(key).cast("string")), F.lit(1 << 31))
    sample = (rows.where(drawn < share).select(F.col(lang).alias("l"), F.col(text).alias("t"), drawn.alias("d"))
              .limit(2 * train_docs * len(found)).collect())
    sample.sort(key=lambda r: (r["l"], r["d"], r["t"]))
    langs = sorted({r["l"] for r in sample if LETTERS.search(r["t"])})
    if not langs:
        return None
    used = [r for r in sample if r["l"] in langs]
    return Model(langs).fit([r["t"] for r in used], [r["l"] for r in used], **options)


def identify(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    spark = df.sparkSession
    prepare(spark, SMALL_BATCH)
    keep = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    if model is None:
        return df.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    src = df.select(*keep)
    at = keep.index(text)

    def run(it):
        crf, memory = shared.value, {}
        for whole in it:
            for b in slices(pa.RecordBatch.from_arrays([whole.column(at), pa.array(range(whole.num_rows))],
                                                       names=["t", "i"]), "t", 2 * PIECE):
                lang, score = [], []
                _, post = crf.label([t or "" for t in b.column(0).to_pylist()], memory)
                for p in post:
                    mean = p.mean(axis=0) if len(p) else None
                    best = int(np.argmax(np.round(mean, 9))) if len(p) else -1
                    lang.append(crf.langs[best] if len(p) else "und")
                    score.append(min(1.0, float(mean[best])) if len(p) else 0.0)
                rows = whole.take(b.column(1))
                yield pa.RecordBatch.from_arrays(rows.columns + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=keep + ["lang_pred", "score"])

    return src.mapInArrow(tidy(run), with_fields(src.schema, ("lang_pred", "string"), ("score", "double")))


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_identified(df: DataFrame, text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """Rows of ``df`` (all columns) whose text is mostly in one learned language."""
    model = train(df.where(~held_out()), text, lang)
    name = "__text"
    named = df.select(F.struct("*").alias("__row"), F.col(text).alias(name))
    return identify(named, model, name).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("__row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


QUERIES = {"op4_language_id": op4_language_id}
SQL: dict = {}
