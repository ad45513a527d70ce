"""Operator 5: packing documents into sequences by swap-based local search.

1. One narrow Arrow pass encodes every text, adds the end id, cuts documents
   longer than a sequence into full pieces, and returns lengths and checksums
   only.  The piece table is staged.
2. Pieces are dealt by a hash of their staged row number into groups of about
   ``group_pieces`` (bounded, whatever the input), so neither a hot source nor
   repeated rows make a large group.
3. In a group, best-fit decreasing gives a first packing.  While it has more
   bins than the volume needs, a local search exchanges one piece for one, two
   for one, or moves a piece between underfull bins; every step raises the sum
   of squared fills, so light bins drain until they are empty.

A null text is an empty one (its piece is the end id alone).  Repeated rows are
packed as often as they occur.  Other columns are not read.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BATCH, Workspace, prepare, table, tidy
from .textnum import PIECE, slices
from .tokens import VOCABULARY, encode_words

LENGTH = 4096                # tokens in a sequence
END_ID = 1
GROUP_PIECES = 16_384        # expected pieces packed by one task at a time
SEARCH_STEPS = 200_000       # improving steps tried in a group at most


def pieces(df: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
           length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    prepare(df.sparkSession, SMALL_BATCH)
    src = df.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    schema = src.select("doc_id").schema.add("piece", "integer").add("start", "long").add(
        "length", "long").add("ids_crc32", "long")
    end, step = np.uint32(end_id).tobytes(), 4 * length

    def run(it):
        for whole in it:
            for b in slices(whole, "__text", PIECE):
                texts = [t or "" for t in b.column(1).to_pylist()]
                row, piece, start, size, crc = [], [], [], [], []
                for i, own in enumerate(encode_words(texts, vocabulary)):
                    ids = own.astype("<u4").tobytes() + end
                    for k in range(0, len(ids), step):
                        part = ids[k:k + step]
                        row.append(i)
                        piece.append(k // step)
                        start.append(k // 4)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return src.mapInArrow(tidy(run), schema)


def best_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []                 # (room left, bin), sorted
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        at = bisect_left(free, (s, -1))
        if at < len(free):
            left, b = free.pop(at)
            bins[b].append(i)
        else:
            left, b = room, len(bins)
            bins.append([i])
        if left > s:
            insort(free, (left - s, b))
    return bins


def local_search(bins: list[list[int]], sizes, room: int, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Drain light bins into fuller ones; stops when no step raises the squared fill,
    when the volume needs every bin left, or after ``steps`` steps."""
    size = [int(s) for s in sizes]
    fill = [sum(size[i] for i in b) for b in bins]
    least = -(-sum(fill) // room)
    alive = len(bins)
    open_ = sorted((f, b) for b, f in enumerate(fill) if 0 < f < room)

    def put(b, new):
        nonlocal open_
        if 0 < fill[b] < room:
            k = bisect_left(open_, (fill[b], b))
            del open_[k]
        fill[b] = new
        if 0 < new < room:
            insort(open_, (new, b))

    def trade(d, t, out, back):
        """Give the pieces ``out`` of bin d to bin t for its pieces ``back``."""
        for i in out:
            bins[d].remove(i)
        for i in back:
            bins[t].remove(i)
        bins[t] += out
        bins[d] += back
        gain = sum(size[i] for i in out) - sum(size[i] for i in back)
        put(d, fill[d] - gain)
        put(t, fill[t] + gain)

    def improve(d) -> bool:
        """One step that takes tokens out of bin d into an underfull bin at least as full."""
        mine = sorted(bins[d], key=lambda i: -size[i])
        k = bisect_left(open_, (fill[d], d))
        targets = [b for _, b in reversed(open_[k + 1:])]
        for t in targets:                                        # move
            gap = room - fill[t]
            for i in mine:
                if size[i] <= gap:
                    trade(d, t, [i], [])
                    return True
        for t in targets:
            gap = room - fill[t]
            theirs = sorted(bins[t], key=lambda i: size[i])
            small = [size[j] for j in theirs]
            for i in mine:                                       # one for one
                at = bisect_left(small, size[i] - gap)
                if at < len(small) and small[at] < size[i]:
                    trade(d, t, [i], [theirs[at]])
                    return True
            for a in range(len(mine)):                           # two for one
                for b in range(a + 1, len(mine)):
                    two = size[mine[a]] + size[mine[b]]
                    at = bisect_left(small, two - gap)
                    if at < len(small) and small[at] < two:
                        trade(d, t, [mine[a], mine[b]], [theirs[at]])
                        return True
            for i in mine:                                       # one for two
                for a in range(len(theirs)):
                    at = bisect_left(small, size[i] - gap - small[a], a + 1)
                    if at < len(small) and small[a] + small[at] < size[i]:
                        trade(d, t, [i], [theirs[a], theirs[at]])
                        return True
        return False

    stuck: set[int] = set()
    while alive > least and steps > 0:
        d = next((b for _, b in open_ if b not in stuck), None)
        if d is None:
            break
        steps -= 1
        if improve(d):
            stuck.clear()
            if fill[d] == 0:
                alive -= 1
        else:
            stuck.add(d)
            if len(stuck) > 64:               # the lightest bins can't be drained any more
                break
    return [b for b in bins if b]


def pack(items: DataFrame, ws: Workspace, length: int = LENGTH,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the staged piece table."""
    cols = [f.name for f in items.schema.fields]
    items = ws.stage(items.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-items.count() // group_pieces))
    schema = items.select(*cols).schema.add("sequence_id", "long").add("offset", "long")

    def run(key, pdf):
        pdf = pdf.sort_values("__row", ignore_index=True)
        sizes = pdf["length"].to_numpy()
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, members in enumerate(local_search(best_fit(sizes, length), sizes, length)):
            at = 0
            for i in members:
                seq[i], off[i] = (int(key[0]) << 32) + b, at
                at += int(sizes[i])
        pdf["sequence_id"], pdf["offset"] = seq, off
        return pdf[cols + ["sequence_id", "offset"]]

    return (items.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
            .groupBy("__group").applyInPandas(run, schema))


def pack_documents(df: DataFrame, text: str = "text", key: str = "doc_id",
                   vocabulary: str = VOCABULARY, length: int = LENGTH, end_id: int = END_ID,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    ws = Workspace(df.sparkSession, "pack")
    return ws.finish(pack(pieces(df, text, key, vocabulary, length, end_id), ws, length, group_pieces))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
SQL: dict = {}
