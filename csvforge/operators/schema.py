"""Schema inference and merging (per record, per key, global).

A record's schema is the list of its fields' types; merging keeps, per
column, the set of observed types as a bit mask, so the merge is one
``groupBy(key).agg(bit_or(...))``: Spark runs it as a partial aggregate in
every task and a final aggregate after a shuffle of one row per key and task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as ft
from ..functions.infer import infer_code, type_bit


def record_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per-record inference: one type-code column ``<c>`` per text column."""
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, *[infer_code(F.col(c)).alias(c) for c in columns])


def merge_masks(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                engine: str = "vector", flag: str | None = None) -> DataFrame:
    """Merged type masks of text columns, one row per key (one row if no key).

    All columns are aggregated in a single pass (wide form).  ``engine="vector"``
    classifies in Arrow batches and emits one partial row per key and task;
    ``"sql"`` evaluates the Column-expression rules; both give the same masks.
    With ``flag`` (a boolean column), flagged rows are skipped and counted in
    ``_n_flag``."""
    aggs = [F.bit_or(F.col(c)).alias(c) for c in columns]
    if flag is not None:
        aggs.append(F.sum("_n_flag").alias("_n_flag"))
    if engine == "vector":
        from ..functions.vector import jvm_regions, keyed_partial_masks
        sel = df.select(*keys, *columns, *([flag] if flag else []))
        schema = T.StructType([sel.schema[k] for k in keys]
                              + [T.StructField(c, T.IntegerType()) for c in columns]
                              + ([T.StructField("_n_flag", T.LongType())] if flag else []))
        partial = sel.mapInArrow(keyed_partial_masks(list(keys), list(columns), flag, jvm_regions(df.sparkSession)), schema)
        return partial.groupBy(*keys).agg(*aggs) if keys else partial.agg(*aggs)
    good = F.lit(True) if flag is None else ~F.coalesce(F.col(flag), F.lit(False))
    bits = df.select(*keys, *[F.when(good, type_bit(F.col(c))).alias(c) for c in columns],
                     *([F.col(flag).cast("long").alias("_n_flag")] if flag else []))
    if keys:
        return bits.groupBy(*keys).agg(*aggs)
    return bits.agg(*aggs)


def merge_masks_long(df: DataFrame, fields: str, keys: Sequence[str] = ()) -> DataFrame:
    """Merged type masks of an ``array<string>`` column, long form:
    ``(keys..., pos, mask, n_fields)``; works for any number of tables and widths."""
    exploded = df.select(*keys, F.posexplode(F.col(fields)).alias("pos", "value"))
    bits = exploded.select(*keys, "pos", type_bit(F.col("value")).alias("bit"))
    return bits.groupBy(*keys, "pos").agg(F.bit_or(F.col("bit")).alias("mask"))


def merge_masks_sparse(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), engine: str = "vector",
                     flag: str | None = None) -> DataFrame:
    """Merged type masks in long form ``(keys..., pos, mask, n)``: one row per key and column with
    a value, ``pos`` its place in ``columns``; and per key a row with ``pos = -1`` whose ``n``
    counts the rows that ``flag`` marks (they are left out otherwise).

    The plan has four columns whatever the width of the table: partial aggregates are sparse
    rows, merged by ``bit_or``."""
    if engine == "vector":
        from ..functions.vector import jvm_regions, keyed_sparse_masks
        schema = T.StructType([df.schema[k] for k in keys]).add("pos", "integer").add("mask", "integer").add("n", "long")
        wanted = {*keys, *columns, flag}
        partial = df.drop(*[c for c in df.columns if c not in wanted]).mapInArrow(keyed_sparse_masks(list(keys), list(columns), flag, jvm_regions(df.sparkSession)), schema)
    else:
        good = "true" if flag is None else f"NOT coalesce({flag}, false)"
        values = F.expr("array(" + ", ".join(f"`{c}`" for c in columns) + ")")
        rows = df.select(*keys, F.expr(good).alias("_good"), values.alias("_values"))
        long = rows.select(*keys, "_good", F.posexplode(F.when(F.col("_good"), F.concat(F.array(F.lit(None).cast("string")), "_values"))
                                                        .otherwise(F.array(F.lit("")))).alias("pos", "value"))
        partial = long.select(*keys, (F.col("pos") - 1).alias("pos"), F.when(F.col("pos") > 0, type_bit(F.col("value"))).alias("mask"),
                              F.when((F.col("pos") == 0) & ~F.col("_good"), 1).otherwise(0).cast("long").alias("n"))
    return partial.groupBy(*keys, "pos").agg(F.coalesce(F.bit_or("mask"), F.lit(0)).alias("mask"), F.sum("n").alias("n"))


def resolved_types(masks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mask columns -> type name columns (same names)."""
    others = [c for c in masks.columns if c not in columns]
    return masks.select(*others, *[ft.type_name(ft.resolve_mask(F.col(c))).alias(c)
                                   for c in columns])


def collect_schema(masks_row) -> list[int]:
    """Driver side: a collected one-row mask result -> list of type codes."""
    return [ft.resolve_mask_py(int(m or 0)) for m in masks_row]


def infer_schema(df: DataFrame, columns: Sequence[str], engine: str = "vector") -> list[int]:
    """Global merged schema of the given text columns (one small action)."""
    row = merge_masks(df, columns, engine=engine).first()
    return collect_schema([row[c] for c in columns])


def infer_struct(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None,
                 widen_int: bool = False) -> T.StructType:
    return ft.table_schema(list(names or columns), infer_schema(df, columns), widen_int)


def merge_type_columns(a: Column, b: Column) -> Column:
    """Common type of two type-code columns."""
    bits = F.array(*[F.lit(ft.BIT[c]) for c in range(len(ft.TYPE_NAMES))])
    bit = lambda c: F.element_at(bits, c + 1)
    return ft.resolve_mask(bit(a).bitwiseOR(bit(b)))
