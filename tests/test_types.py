import itertools

import pytest
from pyspark.sql import functions as F

from csvforge.functions import types as ft
from csvforge.operators.schema import merge_type_columns

I, L, D, B, DA, TI, DT, S, U = (ft.INT, ft.LONG, ft.DOUBLE, ft.BOOLEAN, ft.DATE, ft.TIME,
                                ft.DATETIME, ft.STRING, ft.UNKNOWN)


@pytest.mark.parametrize("a,b,want", [
    (I, I, I), (S, S, S), (U, U, U),
    (U, I, I), (D, U, D), (U, S, S),
    (S, I, S), (B, S, S), (DT, S, S),
    (DA, DT, DT), (DT, TI, DT), (DA, TI, S),
    (I, D, D), (L, D, D), (D, I, D), (I, L, L), (L, I, L),
    (B, I, S), (B, D, S), (B, DA, S), (I, DA, S), (D, TI, S),
])
def test_common_type(a, b, want):
    assert ft.common_type(a, b) == want
    assert ft.common_type(b, a) == want


def test_merge_lists():
    assert ft.merge_types([I, DA, S, B, L, DA], [L, DT, D, TI, D, U]) == [L, DT, S, S, D, DA]
    assert ft.merge_types([S, DT, I, B], [L, DA, TI, D]) == [S, DT, S, S]
    assert ft.merge_types([], [I, S]) == [I, S]
    assert ft.merge_types([I], []) == [I]
    with pytest.raises(ValueError):
        ft.merge_types([I], [I, S])


def test_set_merge_is_order_free():
    # merging by the set of observed types gives one answer for every order
    for combo in itertools.product([I, L, D, B, DA, TI, DT, S, U], repeat=3):
        mask = 0
        for c in combo:
            mask |= ft.BIT[c]
        got = ft.resolve_mask_py(mask)
        pair = ft.common_type(ft.common_type(combo[0], combo[1]), combo[2])
        if {DA, TI, DT} <= set(combo):
            assert got == S          # the one order-dependent set is resolved to STRING
        else:
            assert got == pair


def test_resolve_mask_column_matches_python(spark):
    df = spark.range(256).select(F.col("id").cast("int").alias("m"))
    rows = df.select("m", ft.resolve_mask(F.col("m")).alias("c")).collect()
    for r in rows:
        assert r.c == ft.resolve_mask_py(r.m), r.m


def test_merge_type_columns(spark):
    pairs = list(itertools.product(range(9), repeat=2))
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.select("a", "b", merge_type_columns(F.col("a"), F.col("b")).alias("c")).collect():
        assert r.c == ft.common_type(r.a, r.b)


def test_table_schema():
    names = [f"name{i}" for i in range(1, 10)]
    codes = [I, L, D, B, DA, TI, DT, S, U]
    sch = ft.table_schema(names, codes)
    assert [f.dataType.simpleString() for f in sch.fields] == [
        "int", "bigint", "double", "boolean", "date", "string", "timestamp_ntz", "string", "string"]
    assert all(f.nullable for f in sch.fields)
    assert [ft.warehouse_type(c) for c in codes] == [
        "INT64", "INT64", "FLOAT64", "BOOL", "DATE", "TIME", "DATETIME", "STRING", "STRING"]
    with pytest.raises(ValueError):
        ft.table_schema(names[:2], codes)
