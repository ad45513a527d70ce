"""Typed rows: cast every text column by its merged type (one ``select``)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import types as ft
from ..functions.convert import cast_field, cast_trusted, trusted_sql
from ..functions.infer import infer_code, is_empty


def fill_typed(df: DataFrame, columns: Sequence[str], codes: Sequence[int],
               names: Sequence[str] | None = None, keep: Sequence[str] = (),
               widen_int: bool = False, trusted: bool = False, promote: bool = False) -> DataFrame:
    """Typed projection of text columns; empty text becomes NULL.  ``trusted``:
    the codes were inferred from these same values (cheaper casts, same result).
    ``promote``: a DATE value in a DATETIME column is its midnight, not NULL."""
    names = list(names or columns)
    if not (len(columns) == len(codes) == len(names)):
        raise ValueError(f"{len(names)} column names for {len(codes)} column types")
    cast = cast_trusted if trusted else cast_field
    texts = [trusted_sql(c, code, widen_int) if trusted else None for c, code in zip(columns, codes)]
    return df.select(*keep, *[(F.expr(sql) if sql else cast(F.col(c), code, widen_int, promote)).alias(n)
                              for c, code, n, sql in zip(columns, codes, names, texts)])


def lossy_sum(value: Column, code: int, promote: bool = False, where: Column | None = None) -> Column:
    """Aggregate: non-empty values that the cast turns into NULL (of the rows ``where`` holds)."""
    lost = (~is_empty(value)) & cast_field(value, code, promote=promote).isNull()
    return F.sum((lost if where is None else lost & where).cast("long"))


def lossy_counts(df: DataFrame, columns: Sequence[str], codes: Sequence[int], promote: bool = False) -> DataFrame:
    """Audit of values a typed cast turns into NULL, per column:
    ``(column, field_type, n_lossy)``; e.g. DATE values in a DATETIME column."""
    wide = df.agg(*[lossy_sum(F.col(c), code, promote).alias(c) for c, code in zip(columns, codes)])
    stack = ", ".join(f"'{c}', '{ft.TYPE_NAMES[code]}', coalesce(`{c}`, 0L)" for c, code in zip(columns, codes))
    return wide.selectExpr(f"stack({len(columns)}, {stack}) as (column, field_type, n_lossy)")


def observed_types(df: DataFrame, column: str) -> DataFrame:
    """Count of values per inferred type in one text column."""
    return (df.select(ft.type_name(infer_code(F.col(column))).alias("field_type"))
            .groupBy("field_type").count())
