import random

import pytest
from pyspark.sql import functions as F

from csvforge.functions import types as ft
from csvforge.operators import (lossy_counts, merge_masks, merge_masks_long, observed_types,
                                quarantine, record_types, require_width, resolved_types)
from csvforge.sinks import warehouse_schema

from helpers import write


@pytest.fixture(scope="module")
def text(spark):
    rows = [("1", "2018-11-18T10:00:00", "y", ""), ("2", "2018-11-18", "n", "a"),
            ("3000000000", "10:15", "t", "")]
    return spark.createDataFrame(rows, "a string, b string, c string, d string")


def test_record_types_and_resolution(text):
    rec = record_types(text, ["a", "b"]).collect()
    assert [r.a for r in rec] == [ft.INT, ft.INT, ft.LONG]
    assert [r.b for r in rec] == [ft.DATETIME, ft.DATE, ft.TIME]
    names = resolved_types(merge_masks(text, ["a", "b", "c", "d"]), ["a", "b", "c", "d"]).first()
    assert tuple(names) == ("LONG", "STRING", "BOOLEAN", "STRING")


def test_long_form_masks_equal_wide(text):
    arr = text.select(F.lit("k").alias("key"), F.array("a", "b", "c", "d").alias("f"))
    long = {r.pos: r.mask for r in merge_masks_long(arr, "f", ["key"]).collect()}
    wide = merge_masks(text, ["a", "b", "c", "d"]).first()
    assert [long[i] for i in range(4)] == list(wide)


def test_lossy_counts_and_observed(text):
    rows = {r.column: (r.field_type, r.n_lossy) for r in
            lossy_counts(text, ["b"], [ft.DATETIME]).collect()}
    assert rows == {"b": ("DATETIME", 2)}
    seen = {r.field_type: r["count"] for r in observed_types(text, "b").collect()}
    assert seen == {"DATETIME": 1, "DATE": 1, "TIME": 1}


def test_width_checks(spark):
    df = spark.createDataFrame([(["1", "2"],), (["1"],), (["1", "2", "3"],)], "f array<string>")
    good, bad = quarantine(df, "f", 2)
    assert good.count() == 1 and sorted(r.n_fields for r in bad.collect()) == [1, 3]
    with pytest.raises(ValueError, match="wrong number of fields"):
        require_width(df, "f", 2)


def test_warehouse_schema():
    assert warehouse_schema(["a", "b"], [ft.INT, ft.TIME]) == [
        {"name": "a", "type": "INT64", "mode": "NULLABLE"},
        {"name": "b", "type": "TIME", "mode": "NULLABLE"}]
    with pytest.raises(ValueError):
        warehouse_schema(["a"], [ft.INT, ft.INT])


def test_lookup_join(spark):
    from csvforge.operators.lookup import lookup_join
    recs = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    lk = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k int, name string")
    joined = lookup_join(recs, lk, "k")
    assert joined.count() == 30
    assert sorted(r.name for r in joined.where("v < 3").collect()) == ["a", "b", "c"]
    dup = spark.createDataFrame([(0, "a"), (0, "b")], "k int, name string")
    with pytest.raises(Exception, match="not unique"):
        lookup_join(recs, dup, "k").collect()


def test_sparse_masks_equal_wide_masks(spark):
    from csvforge.operators import merge_masks_sparse
    rnd = random.Random(3)
    values = ["1", "2.5", "x", "2020-01-01", "10:15", "", None, "true", "99999999999"]
    rows = [(f"t{rnd.randrange(3)}", rnd.random() < 0.2, *[rnd.choice(values) for _ in range(6)]) for _ in range(300)]
    df = spark.createDataFrame(rows, "t string, bad boolean, " + ", ".join(f"c{i} string" for i in range(6))).repartition(5)
    cols = [f"c{i}" for i in range(6)]
    want = {r.t: r for r in merge_masks(df, cols, ["t"], flag="bad").collect()}
    for engine in ("vector", "sql"):
        got = {}
        for r in merge_masks_sparse(df, cols, ["t"], engine=engine, flag="bad").collect():
            got[r.t, r.pos] = r.n if r.pos < 0 else r["mask"]
        assert {k: v for k, v in got.items() if v} == {
            **{(t, i): r[c] for t, r in want.items() for i, c in enumerate(cols) if r[c]}, **{(t, -1): r["_n_flag"] for t, r in want.items()}}
    assert merge_masks_sparse(df.where("t = 'none'"), cols, ["t"]).count() == 0


def test_thousands_of_columns(spark, tmp):
    """A table wider than a plan with one aggregate per column could stand."""
    from csvforge import IngestOptions, read_tables
    n = 2500
    rows = [[["7", "2.5", "x", "2020-01-01", ""][(i + r) % 5] if i % 97 == 0 else str(i * r) for i in range(n)] for r in range(6)]
    write(f"{tmp}/w.csv", ",".join(f"col{i}" for i in range(n)) + "\n" + "\n".join(map(",".join, rows)) + "\n")
    t = read_tables(spark, f"{tmp}/w.csv")["w"]
    assert len(t.codes) == n and {t.types[i] for i in range(0, n, 97)} == {"STRING"} and t.types[1] == "INT"
    got = sorted((r.col1, r.col2499, r.col97) for r in t.data.select("col1", "col2499", "col97").collect())
    assert got == sorted((r, 2499 * r, rows[r][97] or None) for r in range(6))
