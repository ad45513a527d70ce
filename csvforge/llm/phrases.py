"""Operator 3: Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (LZ78: each phrase is the shortest piece not
yet in the dictionary).  Its fingerprint is the ``size`` smallest hashes of its
phrase set; two fingerprints estimate the Jaccard similarity of the phrase sets,
which follows how well one text compresses the other.  The dictionary starts anew
every ``WINDOW`` code points, so memory does not grow with a text.

The query also fingerprints, for every document, an edited text whose second half
comes from the next document in id order.  Documents meet their successor without a
global sort: approximate quantiles of the ids (values of the column) cut the id
range into buckets, one shuffle sorts each bucket, and the first document of a
bucket is also sent, as a look-ahead row, to the bucket before it.

Null text is empty; an empty text has the empty fingerprint, equal to itself
(likeness 1) and unlike any other (0).  Null ids come first.  Repeated ids are
ordered by text; rows equal in both follow each other.  Other columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, shuffle_parts, table
from .textnum import U, _powers, mix

SIZE = 64                     # hashes in a fingerprint
WINDOW = 1 << 20
LOWEST = -(1 << 63)           # stands for a null id


def parse(text: str, start: int, seen: set, ends: list, stop: int | None = None) -> int:
    """Extends the phrase ends from ``start``; stops at the end of the text, or before
    the first phrase that would end after ``stop``.  Returns where it stopped."""
    n, s, add, note = len(text), start, seen.add, ends.append
    top = n if stop is None else stop
    guess = 3
    while s < n:
        e = s + guess
        if e > n:
            e = n
        if text[s:e] in seen:
            e += 1
            while e <= n and text[s:e] in seen:
                e += 1
            if e > n:
                return s                       # the rest is a known phrase
        else:
            while e - 1 > s and text[s:e - 1] not in seen:
                e -= 1
        if e > top:
            return s
        add(text[s:e])
        note(e)
        guess = e - s
        s = e
    return s


def _hashes(text: str, ends: list) -> np.ndarray:
    if not ends:
        return np.zeros(0, U)
    e = np.asarray(ends, np.int64)
    s = np.concatenate(([0], e[:-1]))
    with np.errstate(over="ignore"):
        d = np.frombuffer(text[:ends[-1]].encode("utf-32-le", "surrogatepass"), "<u4").astype(U) + U(1)
        p, q = _powers(len(d) + 1)
        c = np.zeros(len(d) + 1, U)
        np.cumsum(d * p[:-1], out=c[1:])
        return mix((c[e] - c[s]) * q[s] + (e - s).astype(U))


def _lowest(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.unique(hashes)[:size]


def signature(text: str, size: int = SIZE) -> np.ndarray:
    out = np.zeros(0, U)
    for a in range(0, len(text), WINDOW):
        part, ends = text[a:a + WINDOW], []
        parse(part, 0, set(), ends)
        out = _lowest(np.concatenate((out, _hashes(part, ends))), size)
    return out


def signatures(text: str, cut: int, tail: str, size: int = SIZE):
    """Signatures of ``text`` and of ``text[:cut] + tail``; their common beginning is
    parsed once."""
    edited = text[:cut] + tail
    if max(len(text), len(edited)) > WINDOW:
        return signature(text, size), signature(edited, size)
    seen, ends = set(), []
    at = parse(text, 0, seen, ends, cut)
    seen2, ends2 = set(seen), list(ends)
    parse(text, at, seen, ends)
    parse(edited, at, seen2, ends2)
    return _lowest(_hashes(text, ends), size), _lowest(_hashes(edited, ends2), size)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of two phrase sets (exact below ``size`` phrases)."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:size]
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def text_of(sig: np.ndarray) -> str:
    return sig.astype(">u8").tobytes().hex()


def fingerprints(df: DataFrame, text: str = "text", columns=("doc_id",), size: int = SIZE) -> DataFrame:
    """``columns`` of every row with its ``fingerprint``: one narrow pass."""
    prepare(df.sparkSession)
    src = df.select(*columns, F.col(text).alias("__text"))

    @F.pandas_udf("string")
    def finger(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_of(signature(t or "", size)))

    return src.select(*columns, finger("__text").alias("fingerprint"))


def edited_pairs(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """Fingerprints of every text, its edited text, and their likenesses."""
    spark = df.sparkSession
    prepare(spark)
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("k", F.coalesce("doc_id", F.lit(LOWEST)))
    parts = shuffle_parts(spark)
    steps = [i / parts for i in range(1, parts)] or [0.5]
    row = docs.agg(F.percentile_approx("k", steps, 10 * parts).alias("q"), F.min("k").alias("low")).first()
    low = row["low"]
    cuts = np.array(sorted({q for q in row["q"] or [] if q > low}), np.int64)
    last = len(cuts)

    @F.pandas_udf("long")
    def bucket(k: pd.Series) -> pd.Series:
        b = np.searchsorted(cuts, k.to_numpy(), "right")
        first = (b > 0) & (cuts[np.maximum(b, 1) - 1] == k.to_numpy()) if last else np.zeros(len(b), bool)
        return pd.Series(2 * b + first)

    code = docs.withColumn("c", bucket("k")).withColumn("b", F.shiftright("c", 1).cast("int"))
    ahead = F.when(F.col("k") == F.lit(low), F.lit(last)).when(F.col("c") % 2 == 1, F.col("b") - 1)
    dest = F.array_compact(F.array(F.struct(F.col("b").alias("bucket"), F.lit(0).alias("ahead")),
                                   F.when(ahead.isNotNull(), F.struct(ahead.alias("bucket"), F.lit(1).alias("ahead")))))
    rows = (code.select("doc_id", "text", "k", F.explode(dest).alias("to"))
            .select("doc_id", "text", "k", F.col("to.bucket").alias("bucket"), F.col("to.ahead").alias("ahead"))
            .repartitionById(last + 1, F.col("bucket")).sortWithinPartitions("bucket", "ahead", "k", "text"))

    def follow(held, nxt):
        """The held document's row without ``near_next``, and its signature."""
        doc, t = held
        n = len(t)
        cut, tail = n - n // 2, nxt[:n // 2]
        own, edited = signatures(t, cut, tail, size)
        return {"doc_id": doc, "n_chars": n, "edited_sha256": hashlib.sha256((t[:cut] + tail).encode()).hexdigest(),
                "fingerprint": text_of(own), "edited_fingerprint": text_of(edited),
                "near_edited": likeness(own, edited, size)}, own

    def run(it):
        held = ready = None                    # the last document; the row before it, still without near_next
        at = -1
        for batch in it:
            out = []
            for doc, t, b, a in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if b != at:
                    held, ready, at = None, None, b
                if held is not None:
                    row, own = follow(held, t)
                    if ready is not None:
                        out.append(ready[0] | {"near_next": likeness(ready[1], own, size)})
                    ready = row, own
                    if a:                      # the look-ahead row: its signature ends the bucket
                        out.append(row | {"near_next": likeness(own, signature(t, size), size)})
                        ready = None
                held = None if a else (doc, t)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                       ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                       ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def op3_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))


QUERIES = {"op3_phrase_fingerprint": op3_phrase_fingerprint}
SQL: dict = {}
