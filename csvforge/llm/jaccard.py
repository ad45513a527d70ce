"""Operator 8: n-gram Jaccard join with signature trees.

The documents whose word-shingle sets have a Jaccard similarity of ``num / den``
or more are linked; the result gives the connected components of the links.

1. Equal sets are one class, found by a map-side combined aggregate, so a group
   of copies costs one row per task.
2. Classes meet in blocks: two sets that reach the bound share one of the first
   ``n - ceil(t n) + 1`` shingles in any fixed global order (prefix filter).  The
   order puts shingles that a fixed-size count sketch finds frequent last, which
   keeps passages shared by many documents out of the prefixes.
3. In each block a signature tree over bitmaps is traversed against itself.  A
   block larger than ``block`` members is cut into slots by a hash.
   - First every member offers its pair with the lowest-numbered class that may
     reach the bound (slots see the lowest member of their whole block too); one
     pair for each class is verified on the whole sets, and the links are joined
     to components.
   - Then blocks that still hold several components are traversed in full, slot
     against slot: all pairs of different components that the trees cannot rule
     out are verified.  No link between different components is lost, and a
     dense group never expands into all its pairs.
4. Verification intersects whole sets in the JVM.

Null or wordless texts have an empty set and are linked with nothing.  A null
``doc_id`` takes part; a component's id is its smallest non-null ``doc_id``.
Repeated rows are members of one class.  Other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .bloom import key_filter, passes
from .common import SMALL_BATCH, Workspace, free_name, prepare, shuffle_parts, table, tidy
from .components import components
from .sigtree import WORDS, bitmap, candidate_pairs, fine_bitmap, fine_may_reach, may_reach
from .textnum import PIECE, list_array, mix, shingle_sets, signed, slices, word_hashes

SKETCH_BITS = 22              # cells of the frequency sketch: 2**22, whatever the input
FILTER_BITS = 24              # bits of the filter for texts whose sets are needed: 2**24
BLOCK = 1024                  # members handled by one tree
U = np.uint64


def _sets(batch, column: str, k: int):
    for b in slices(batch, column, PIECE):
        words, first = word_hashes(b.column(b.schema.get_field_index(column)))
        yield b, shingle_sets(words, first, k)


def frequency_sketch(docs: DataFrame, k: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts of the hash cells that stand out within a task, summed over tasks.

    Only an ordering hint: any sketch gives the same links."""
    def run(it):
        cells = np.zeros(1 << bits, np.int32)
        for batch in it:
            for _, sets in _sets(batch, "text", k):
                found = list(sets)
                if found:
                    at, n = np.unique(np.concatenate(found) & U((1 << bits) - 1), return_counts=True)
                    cells[at.astype(np.int64)] += n.astype(np.int32)
        mean = cells.mean()
        hot = np.flatnonzero(cells > mean + 3 * np.sqrt(mean) + 2)
        for a in range(0, len(hot), 50_000):
            h = hot[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(cells[h].astype(np.int64))],
                                             names=["cell", "n"])

    rows = docs.select("text").mapInArrow(tidy(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toArrow()                                   # at most 2**bits rows
    out = np.zeros(1 << bits, np.int32)
    out[got["cell"].to_numpy()] = np.minimum(got["n"].to_numpy(), np.iinfo(np.int32).max)
    return out


def signatures(docs: DataFrame, k: int, num: int, den: int, sketch) -> DataFrame:
    """Per row of ``docs(rid, doc_id, text)``: set size, set key, prefix and bitmap."""
    schema = docs.select("rid", "doc_id").schema.add("n", "long").add("k1", "long").add("k2", "long")
    schema = schema.add("prefix", ArrayType(LongType())).add("bits", "binary")
    mask = len(sketch.value) - 1

    def run(it):
        for batch in it:
            for b, sets in _sets(batch, "text", k):
                n, k1, k2, prefix, bits = [], [], [], [], []
                with np.errstate(over="ignore"):
                    for s in sets:
                        n.append(len(s))
                        k1.append(int(mix(s).sum(dtype=U).view(np.int64)))
                        k2.append(int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U).view(np.int64)))
                        size = len(s) - -(-num * len(s) // den) + 1 if len(s) else 0
                        freq = sketch.value[(s & U(mask)).astype(np.int64)]
                        prefix.append(signed(s[np.lexsort((s, freq))[:size]]))
                        bits.append(bitmap(s).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                     pa.array(k2, pa.int64()), list_array(prefix), pa.array(bits, pa.binary())],
                    names=["rid", "doc_id", "n", "k1", "k2", "prefix", "bits"])

    return docs.select("rid", "doc_id", "text").mapInArrow(tidy(run), schema)


def _wanted(pairs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of 2**bits bits over the row numbers that stand in ``pairs(a, b)``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rid"))
    cells = ids.select(F.pmod(F.xxhash64("rid"), F.lit(1 << bits)).alias("c"))
    got = (cells.groupBy(F.shiftright("c", 6).alias("w"))
           .agg(F.expr("bit_or(shiftleft(1L, cast(c & 63 as int)))").alias("v")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy()] = got["v"].to_numpy()
    return out


def gather(docs: DataFrame, k: int, pairs: DataFrame, ws: Workspace, name: str, fine: bool) -> DataFrame:
    """``(rid, n, shape)`` of the texts in ``pairs``, read again: the shape is the whole set
    or its fine bitmap.  The filter may let a few other texts pass; joins drop them."""
    cell = F.pmod(F.xxhash64("rid"), F.lit(1 << FILTER_BITS))
    shared = docs.sparkSession.sparkContext.broadcast(_wanted(pairs))

    def run(it):
        for batch in it:
            c = batch.column(1).to_numpy()
            hit = (shared.value[c >> 6] >> (c & 63)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            for b, sets in _sets(batch, "text", k):
                found = list(sets)
                shape = (pa.array([fine_bitmap(s) for s in found], pa.binary()) if fine
                         else list_array([signed(s) for s in found]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in found], pa.int64()), shape],
                                                 names=["rid", "n", "shape"])

    kind = "binary" if fine else "array<long>"
    return ws.stage(docs.select("rid", cell.alias("c"), "text").mapInArrow(tidy(run), f"rid long, n long, shape {kind}"), name)


def verified(docs: DataFrame, k: int, pairs: DataFrame, ws: Workspace, name: str, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the bound.  Bitmaps of a byte an element
    rule out most other pairs first, so whole sets are brought together for few."""
    def screen(it):
        for batch in it:
            na, nb, fa, fb = (batch.column(i).to_pylist() for i in range(2, 6))
            ok = [fine_may_reach(x, y, p, q, num, den) for x, y, p, q in zip(fa, fb, na, nb)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def beside(shapes, names):
        left, right = (shapes.toDF(c, f"n{c}", f"s{c}") for c in "ab")
        return names.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")

    fine = gather(docs, k, pairs, ws, f"{name}-fine", True)
    likely = ws.stage(beside(fine, pairs).mapInArrow(tidy(screen), "a long, b long"), f"{name}-likely")
    ws.drop(fine)
    sets = gather(docs, k, likely, ws, f"{name}-sets", False)
    inter = F.size(F.array_intersect("sa", "sb"))
    links = beside(sets, likely).where(inter * F.lit(den) >= (F.col("na") + F.col("nb") - inter) * F.lit(num))
    out = ws.stage(links.select("a", "b"), f"{name}-links")
    ws.drop(likely, sets)
    return out


def block_pairs(blocks: DataFrame, num: int, den: int, first_only: bool) -> DataFrame:
    """Candidate pairs of the blocks ``(key, part, side, id, label, n, bits)``.

    ``first_only``: for each member just the lowest-numbered partner.  ``side`` 1 and
    2 tell two slots of a large block apart (pairs within a slot are its own job)."""
    cols = ["id", "label", "n", "side", "bits"]

    def solve(ids, labels, n, side, bits):
        order = np.lexsort((side, ids))
        ids, labels, n, side, bits = ids[order], labels[order], n[order], side[order], bits[order]
        i, j = candidate_pairs(bits, n, labels, num, den)
        keep = (side[i] == 0) | (side[i] != side[j])
        a, b = np.minimum(ids[i], ids[j])[keep], np.maximum(ids[i], ids[j])[keep]
        real = a != b
        a, b = a[real], b[real]
        if first_only and len(a):
            o = np.lexsort((a, b))
            a, b = a[o], b[o]
            f = np.concatenate(([True], b[1:] != b[:-1]))
            a, b = a[f], b[f]
        return a, b

    def run(it):
        held = None
        for batch in _ending(it):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not held.num_rows:
                continue
            key, part = held["key"].to_numpy(), held["part"].to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            ends = np.concatenate((new, [len(key)] if batch is None else [])).astype(int)
            if not len(ends):
                continue
            ids, labels, n, side = (held[c].to_numpy() for c in cols[:4])
            raw = held["bits"].combine_chunks()
            bits = np.frombuffer(b"".join(raw.slice(0, int(ends[-1])).to_pylist()), U).reshape(-1, WORDS)
            begins = np.concatenate(([0], ends[:-1]))
            two = begins[ends - begins == 2]                   # blocks of two, all at once
            ok = (labels[two] != labels[two + 1]) & (ids[two] != ids[two + 1])
            ok &= (side[two] == 0) | (side[two] != side[two + 1])
            two = two[ok]
            two = two[may_reach(bits[two], bits[two + 1], n[two], n[two + 1], num, den)]
            left = [np.minimum(ids[two], ids[two + 1])]
            right = [np.maximum(ids[two], ids[two + 1])]
            large = ends - begins > 2
            for at, e in zip(begins[large].tolist(), ends[large].tolist()):
                a, b = solve(ids[at:e], labels[at:e], n[at:e], side[at:e], bits[at:e])
                left.append(a)
                right.append(b)
            at = int(ends[-1])
            held = held.slice(at)
            if sum(map(len, left)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left), pa.int64()),
                                                  pa.array(np.concatenate(right), pa.int64())], names=["a", "b"])

    dealt = (blocks.repartition(shuffle_parts(blocks.sparkSession), "key", "part")
             .sortWithinPartitions("key", "part"))
    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def possible_entries(reps: DataFrame, filt) -> DataFrame:
    """``(key, id)`` of the prefix shingles that may stand in another prefix too."""
    def run(it):
        for b in it:
            lists = b.column(1)
            key = lists.flatten().to_numpy()
            ids = np.repeat(b.column(0).to_numpy(), pc.list_value_length(lists).to_numpy())
            ok = passes(filt.value, key.view(U))
            yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(ids[ok])], names=["key", "id"])

    return reps.select("id", "prefix").mapInArrow(tidy(run), "key long, id long")


def _ending(it):
    yield from it
    yield None


def linked_components(docs: DataFrame, ws: Workspace, k: int, num: int, den: int, block: int = BLOCK):
    """(sigs, classes, roots): staged signatures, ``(k1, k2, cid)`` and ``(node, root)``."""
    spark = docs.sparkSession
    docs = docs.withColumn("rid", F.monotonically_increasing_id())
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, k))
    sigs = ws.stage(signatures(docs, k, num, den, sketch), "signatures")
    classes = sigs.where("n > 0").groupBy("k1", "k2").agg(F.min("rid").alias("cid"))
    classes = ws.stage(classes, "classes")
    reps = sigs.join(classes.select(F.col("cid").alias("rid")), "rid", "left_semi")
    reps = ws.stage(reps.select(F.col("rid").alias("id"), "n", "prefix", "bits"), "representatives")
    met = (reps.select(F.explode("prefix").alias("key"), "id").groupBy("key")
           .agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("low")).where("c > 1"))
    met = ws.stage(met, "keys")
    shared = ws.stage(possible_entries(reps, spark.sparkContext.broadcast(key_filter(met))).join(met, "key"), "blocks")
    ws.drop(met)
    facts = reps.select("id", "n", "bits")

    # linear pass: each member with one partner, every class its own label
    slots = F.ceil(F.col("c") / F.lit(block)).cast("int")
    part = F.pmod(F.xxhash64("id"), slots).cast("int")
    own = shared.select("key", part.alias("part"), "id")
    lows = (shared.where(F.col("c") > block).select("key", F.col("low").alias("id"), slots.alias("s")).distinct()
            .select("key", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("part"), "id"))
    blocks = (own.unionByName(lows).distinct().join(facts, "id")
              .select("key", "part", F.lit(0).alias("side"), "id", F.col("id").alias("label"), "n", "bits"))
    first = block_pairs(blocks, num, den, True).groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = ws.stage(first, "pairs-1")
    links = verified(docs, k, first, ws, "first", num, den)
    roots = ws.stage(components(links, ws, "cc1"), "roots-1")

    # what is left: blocks that hold several components, in full
    label = F.coalesce("root", "id")
    named = shared.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", label.alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                     F.count(F.lit(1)).alias("c")).where("x <> y").select("key", "c")
    named = named.join(mixed, "key").withColumn("s", slots).withColumn("p", F.pmod(F.xxhash64("id"), F.col("s")).cast("int"))
    spread = named.select("key", "id", "label", "p", "s", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("q"))
    blocks = (spread.join(facts, "id")
              .select("key", (F.least("p", "q").cast("long") * F.col("s") + F.greatest("p", "q")).alias("part"),
                      F.when(F.col("p") == F.col("q"), 0).when(F.col("p") < F.col("q"), 1).otherwise(2).alias("side"),
                      "id", "label", "n", "bits"))
    rest = ws.stage(block_pairs(blocks, num, den, False).join(first, ["a", "b"], "left_anti"), "pairs-2")
    ws.drop(shared, first, reps)
    more = verified(docs, k, rest, ws, "rest", num, den)
    roots = components(links.unionAll(more), ws, "cc2")
    return sigs, classes, roots


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5,
                    num: int = 8, den: int = 10, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row per input row.  Two documents
    are linked when the Jaccard similarity of their k-word shingles is >= num / den."""
    prepare(df.sparkSession, SMALL_BATCH)
    ws = Workspace(df.sparkSession, "jaccard")
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sigs, classes, roots = linked_components(docs, ws, k, num, den, block)
    named = (classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
             .select("k1", "k2", F.coalesce("root", "cid").alias("root")))
    rows = sigs.select("doc_id", "n", "k1", "k2", "rid").join(named, ["k1", "k2"], "left")
    rows = ws.stage(rows.select("doc_id", "n", F.coalesce("root", "rid").alias("root")), "rooted")
    low = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return ws.finish(rows.join(low, "root")
                     .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))


def one_of_each(df: DataFrame, text: str = "text", k: int = 5, num: int = 8, den: int = 10,
                block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` (all columns) without near duplicates: of each component the
    first row in scan order stays; texts without words all stay."""
    prepare(df.sparkSession, SMALL_BATCH)
    ws = Workspace(df.sparkSession, "one")
    docs = df.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sigs, classes, roots = linked_components(docs, ws, k, num, den, block)
    named = (classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
             .select("k1", "k2", F.coalesce("root", "cid").alias("root")))
    rid = free_name(df.columns, "__rid")
    gone = ws.stage(sigs.join(named, ["k1", "k2"]).where("n > 0 AND root <> rid").select(F.col("rid").alias(rid)), "gone")
    return ws.finish(df.withColumn(rid, F.monotonically_increasing_id()).join(gone, rid, "left_anti").drop(rid))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


QUERIES = {"op8_ngram_jaccard": op8_ngram_jaccard}
SQL: dict = {}
