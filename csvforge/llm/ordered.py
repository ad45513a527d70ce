"""Ordered rows of a key in bounded segments, however many rows the key has.

Rows are range-partitioned by key and order, so one key with a third of all rows is
dealt over many tasks, then sorted inside a task and cut into segments of bounded rows
and bytes.  Tasks stream: nothing but the segment at hand is held.  Rows that agree in
key, turn, role and text are interchangeable and may be dealt over tasks too.

Order inside a key: turn (nulls first), role, the first 32 characters of the text, a
hash of the text.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .common import Workspace, prepare, shuffle_parts, with_fields

ROWS = 1024                   # most rows of a segment
BYTES = 4 << 20               # a segment ends before the row that would start beyond these characters
OUT_BYTES = 4 << 20           # text in one Arrow batch handed back


class Batches:
    """Collects rows (tuples) and cuts them into Arrow batches by characters of text."""

    def __init__(self, schema: pa.Schema, size: int = OUT_BYTES):
        self.schema, self.size, self.rows, self.n = schema, size, [], 0

    def add(self, row: tuple, chars: int):
        self.rows.append(row)
        self.n += chars + 64
        if self.n >= self.size:
            yield from self.flush()

    def flush(self):
        if self.rows:
            cols = list(zip(*self.rows))
            self.rows, self.n = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, self.schema.types)], schema=self.schema)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def stream(batches, names):
    """Rows of Arrow batches as tuples of the named columns."""
    for b in batches:
        yield from zip(*[b.column(b.schema.get_field_index(n)).to_pylist() for n in names])


def segments(rows: DataFrame, ws: Workspace, rows_most: int = ROWS, bytes_most: int = BYTES) -> DataFrame:
    """``rows(conv, turn, role, text)`` -> a written table ``(conv, part, no, whole, turn, role, text)``
    with arrays in the last three; ``(part, no)`` orders the segments and is their key.
    ``whole`` marks segments that are sure to hold all rows of their key."""
    spark = rows.sparkSession
    prepare(spark)
    keyed = rows.select("conv", "turn", "role", "text", F.substring("text", 1, 32).alias("head"),
                        F.xxhash64("text").alias("hash"),
                        (F.monotonically_increasing_id() % 1021).alias("salt"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "head", "hash", "salt")]
    dealt = (keyed.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
             .select("conv", "turn", "role", "text"))
    own = rows.schema
    schema = with_fields(rows.select("conv").schema, ("part", "integer"), ("no", "long"), ("whole", "boolean"),
                         ("turn", ArrayType(own["turn"].dataType)), ("role", ArrayType(StringType())),
                         ("text", ArrayType(StringType())))
    out_schema = arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext
        part, no = TaskContext.get().partitionId(), 0
        out = Batches(out_schema)
        first = True                                   # the partition's first key may have begun elsewhere
        key, begun, seg, size = None, False, [], 0     # begun: a segment of the key was emitted before

        def close(whole):
            nonlocal no, seg, size
            row = (key, part, no, whole, *map(list, zip(*seg)))
            n, no, seg, size = size, no + 1, [], 0
            return out.add(row, n)

        for conv, turn, role, text in stream(batches, ("conv", "turn", "role", "text")):
            if seg and conv != key:
                yield from close(not first and not begun)
                first, begun = False, False
            elif seg and (len(seg) >= rows_most or size >= bytes_most):
                yield from close(False)
                begun = True
            key = conv
            seg.append((turn, role, text))
            size += len(text or "")
        if seg:
            yield from close(False)                    # the last key may go on elsewhere
        yield from out.flush()

    return ws.stage(dealt.mapInArrow(run, schema), "segments")


def blocks(seg: DataFrame, ws: Workspace, rows_most: int = ROWS, bytes_most: int = BYTES) -> DataFrame:
    """Segments cut anew at places that depend on the key's rows alone, not on how they were
    dealt: ``(conv, a, b, whole, head, turn, role, text)``.  ``a`` counts ``rows_most`` rows,
    ``b`` counts ``bytes_most`` characters before a row; (a, b) orders the blocks of a key.
    ``head`` is the key's first row (role, text), given to its later blocks."""
    none = F.lit(None).cast("struct<role:string,text:string>")
    whole = seg.where("whole").select("conv", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "whole",
                                      none.alias("head"), "turn", "role", "text")
    rest = seg.where("NOT whole")
    sizes = rest.select("conv", "part", "no", F.size("role").alias("n"), F.aggregate(
        "text", F.lit(0).cast("long"), lambda s, t: s + F.coalesce(F.length(t), F.lit(0))).alias("m"))
    w = Window.partitionBy("conv").orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", "no", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"),     # one row per segment
                          F.coalesce(F.sum("m").over(w), F.lit(0)).alias("m0"))
    running = F.aggregate("text", F.array(F.lit(0).cast("long")), lambda s, t: F.concat(
        s, F.array(F.element_at(s, -1) + F.coalesce(F.length(t), F.lit(0)))))
    one = (rest.join(before, ["part", "no"]).withColumn("at", running)
           .select("conv", "n0", "m0", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("role") - 1).alias("i"),
                                                              F.slice("at", 1, F.size("role")).alias("m"), "turn", "role", "text")).alias("r")))
    one = one.select("conv", (F.col("n0") + F.col("r.i")).alias("pos"), (F.col("m0") + F.col("r.m")).alias("m"), "r.turn", "r.role", "r.text")
    one = ws.stage(one.withColumn("a", F.floor(F.col("pos") / rows_most)).withColumn("b", F.floor(F.col("m") / bytes_most)), "cut")
    group = one.groupBy("conv", "a", "b").agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "role", "text"))).alias("r"))
    lead = one.where("pos = 0").select(F.col("conv").alias("lead_conv"), F.struct("role", "text").alias("head"))
    cut = (group.join(lead, F.col("conv").eqNullSafe(F.col("lead_conv")))
           .select("conv", "a", "b", F.lit(False).alias("whole"), F.when(F.col("a") + F.col("b") > 0, F.col("head")).alias("head"),
                   F.col("r.turn").alias("turn"), F.col("r.role").alias("role"), F.col("r.text").alias("text")))
    return whole.unionByName(cut)


def gathered(df: DataFrame, *order) -> DataFrame:
    """All rows of a key in one task, in their order, to be streamed (never held together)."""
    return df.repartition(shuffle_parts(df.sparkSession), "conv").sortWithinPartitions("conv", *order)
