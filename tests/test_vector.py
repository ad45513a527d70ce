"""The vectorized classifier agrees with the Column-expression classifier."""
import random

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from csvforge.functions import types as ft
from csvforge.functions.infer import infer_code
from csvforge.functions.vector import classify_array, jvm_regions, know_regions

from test_infer import CASES

PIECES = ["0", "1", "9", "12", "2018", "-", "+", ".", ":", "T", "t", "Z", "z", "e", "E", "x", "p",
          "NaN", "Infinity", "nan", " ", "\t", "\n", "d", "F", "true", "No", "y", "2147483647",
          "2147483648", "9223372036854775807", "9223372036854775808", "0000", "02", "29", "30",
          "13", "23", "24", "59", "60", "[Europe/Paris]", "[UTC]", "[Nope/X]", "[EST]", "18:00",
          "05:00", "é", "😀", ",", '"', "000000000", "0x", "1.5", "a"]


def _gen(rnd):
    return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 7)))


def _shaped(rnd):
    y, m, d = rnd.randint(1, 2400), rnd.randint(0, 13), rnd.randint(0, 32)
    h, mi, s = rnd.randint(0, 25), rnd.randint(0, 61), rnd.randint(0, 61)
    date = f"{y:04d}-{m:02d}-{d:02d}"
    time = f"{h:02d}:{mi:02d}" + rnd.choice(["", f":{s:02d}", f":{s:02d}.{rnd.randint(0, 10**9)}"])
    off = rnd.choice(["", "Z", "+05:00", "-18:00", "+18:30", "+23:59", "[Europe/Paris]", "+01:00[Europe/Paris]"])
    return rnd.choice([date, date + off, time, time + off, date + "T" + time + off,
                       str(rnd.randint(-10**20, 10**20)), repr(rnd.uniform(-1e9, 1e9))])


def _long_year(rnd):
    year = rnd.choice(["", "+", "-"]) + str(rnd.choice([0, 4, 44, 100, 400, 2000, 2023, 9999, 10000, 10004, 290000, 5881580,
                                                        99999999, 999999999, 1000000000])).zfill(rnd.choice([1, 4, 5, 7, 10, 11]))
    date = f"{year}-{rnd.choice(['01', '02', '02', '12', '13'])}-{rnd.choice(['01', '28', '29', '30', '31'])}"
    return date + rnd.choice(["", "", "Z", "+05:00", "T10:15", "T10:15:30.5-03:00", "T01:02:03+01:00[Asia/Tokyo]", "x"])


def _compare(spark, values):
    know_regions(jvm_regions(spark))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    sql = [r.c for r in df.select(infer_code(F.col("v")).alias("c")).orderBy("i").collect()]
    vec = list(classify_array(pa.array(values, pa.string())))
    bad = [(v, ft.TYPE_NAMES[a], ft.TYPE_NAMES[b]) for v, a, b in zip(values, sql, vec) if a != b]
    assert not bad, bad[:10]


def test_cases_agree(spark):
    _compare(spark, [v for v, _ in CASES] + [None])


def test_random_agree(spark):
    rnd = random.Random(7)
    _compare(spark, [_gen(rnd) for _ in range(3000)] + [_shaped(rnd) for _ in range(3000)])
    _compare(spark, [_long_year(rnd) for _ in range(3000)])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-:.T+eZ[] aN", max_size=24), min_size=1, max_size=40))
def test_hypothesis_agree(spark, values):
    _compare(spark, values)


def test_trusted_cast_equals_guarded_cast(spark):
    from csvforge.functions.convert import cast_field, cast_trusted, trusted_sql
    from csvforge.functions.vector import mask_of
    know_regions(jvm_regions(spark))
    rnd = random.Random(11)
    columns = {
        "ints": [str(rnd.randint(-10**6, 10**6)) for _ in range(200)] + ["", "007", "+5"],
        "longs": [str(rnd.randint(-10**15, 10**15)) for _ in range(200)] + ["1"],
        "doubles": [repr(rnd.uniform(-1e6, 1e6)) for _ in range(200)] + ["1d", "0x1p3", " 12", "NaN", "5"],
        "bools": [rnd.choice(["Y", "n", "TRUE", "f", "yes", "No", ""]) for _ in range(200)],
        "dates": [_shaped(rnd)[:10] for _ in range(300)],
        "times": ["10:15", "23:59:59.5", "00:00:00.000", "12:30+05:00", "", "07:08:09Z"],
        "datetimes": ["2018-11-18T11:25:33", "2018-11-18", "10:15", "2018-11-18t01:02:03.123456789+05:00",
                      "2018-11-18T11:25:33+05:00[Europe/Paris]", "2018-11-18T11:25Z", ""],
        "strings": ["a", "", "1", "x y"],
    }
    for name, values in columns.items():
        code = ft.resolve_mask_py(mask_of(pa.array(values, pa.string())))
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        rows = df.select("i", cast_field(F.col("v"), code).alias("a"),
                         cast_trusted(F.col("v"), code).alias("b")).collect()
        bad = [(values[r.i], r.a, r.b) for r in rows if r.a != r.b and not (r.a != r.a and r.b != r.b)]
        assert not bad, (name, ft.TYPE_NAMES[code], bad[:5])
        sql = trusted_sql("v", code)
        if sql:
            same = df.select(F.expr(sql).alias("s"), cast_trusted(F.col("v"), code).alias("b"))
            assert same.where("NOT (s <=> b)").count() == 0 and same.schema["s"].dataType == same.schema["b"].dataType


def test_engines_agree_on_ingest(spark, tmp):
    import os
    from csvforge.options import IngestOptions
    from csvforge.plans.ingest import read_tables
    rnd = random.Random(3)
    lines = ["a,b,c,d"] + [",".join([_shaped(rnd).replace(",", ""), str(rnd.randint(0, 9)),
                                     rnd.choice(["y", "n", ""]), _gen(rnd).replace(",", "").replace('"', "")
                                     .replace("\n", "")]) for _ in range(500)]
    os.makedirs(f"{tmp}/e", exist_ok=True)
    with open(f"{tmp}/e/t.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    a = read_tables(spark, f"{tmp}/e", IngestOptions(infer_engine="vector", bad_rows="quarantine"))["t"]
    b = read_tables(spark, f"{tmp}/e", IngestOptions(infer_engine="sql", bad_rows="quarantine"))["t"]
    assert a.codes == b.codes and a.n_bad == b.n_bad
    assert sorted(map(repr, a.data.collect())) == sorted(map(repr, b.data.collect()))


def test_keyed_masks_engines_agree(spark):
    from csvforge.operators.schema import merge_masks
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None, "c"]), rnd.randint(0, 2), _shaped(rnd), _gen(rnd), rnd.choice(["1", "x", ""]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, k2 int, v1 string, v2 string, v3 string").repartition(3)
    for keys in ([], ["k"], ["k", "k2"]):
        a = {tuple(r) for r in merge_masks(df, ["v1", "v2", "v3"], keys, engine="vector").collect()}
        b = {tuple(r) for r in merge_masks(df, ["v1", "v2", "v3"], keys, engine="sql").collect()}
        assert a == b, keys


def test_long_and_signed_years_as_the_jdk_reads_them(spark):
    """Type, days and shown text of dates with signs and up to ten digits, against the JDK's parsers."""
    from csvforge.functions.convert import to_date, to_datetime
    time = spark._jvm.java.time
    rnd = random.Random(6)
    values = sorted({_long_year(rnd) for _ in range(260)})

    def parsed(kind, form, v):
        try:
            return getattr(time, kind).parse(v, getattr(time.format.DateTimeFormatter, form))
        except Exception as e:
            assert "DateTime" in repr(e)
            return None
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", infer_code(F.col("v")).alias("code"), F.unix_date(to_date(F.col("v"))).alias("days"),
        F.unix_seconds(to_datetime(F.col("v")).cast("timestamp")).alias("secs"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert zone == "UTC"
    n = 0
    for r in df.collect():
        date = parsed("LocalDate", "ISO_DATE", r.v)
        moment = None if date else (parsed("LocalDateTime", "ISO_LOCAL_DATE_TIME", r.v)
                                    or parsed("LocalDateTime", "ISO_OFFSET_DATE_TIME", r.v)
                                    or parsed("ZonedDateTime", "ISO_ZONED_DATE_TIME", r.v))
        assert r.code == (ft.DATE if date else ft.DATETIME if moment else ft.STRING), r.v
        if date:
            days = date.toEpochDay()
            assert r.days == (days if abs(days) < 1 << 31 else None), r.v
            n += 1
        elif moment:
            local = moment.toLocalDateTime() if hasattr(moment, "toLocalDateTime") and moment.getClass().getSimpleName() == "ZonedDateTime" else moment
            secs = local.toEpochSecond(time.ZoneOffset.UTC)
            assert r.secs == (secs if abs(secs) < 9_223_372_036_854 - 86_400 else None), r.v
            n += 1
    assert n > 40


def test_trusted_casts_of_long_years(spark):
    from csvforge.functions.convert import cast_field, cast_trusted
    for code, values in ((ft.DATE, ["+10000-01-01", "-0044-03-15Z", "2018-11-18", "+0000044000-02-29", "+5881581-01-01", ""]),
                         (ft.DATETIME, ["+10000-01-01T10:15", "-0044-03-15T01:02:03Z", "-0044-03-15", "10:15", "2018-11-18T11:25"])):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        rows = df.select("v", cast_field(F.col("v"), code).cast("string").alias("a"),
                         cast_trusted(F.col("v"), code).cast("string").alias("b")).collect()
        assert [(r.v, r.a) for r in rows] == [(r.v, r.b) for r in rows]


def test_zone_ids_come_with_the_task(spark, monkeypatch):
    """Types do not depend on time-zone files: without the driver's list there is no guess."""
    import pytest
    from csvforge.functions import vector
    monkeypatch.setattr(vector, "_REGIONS", set())
    vector.valid_zone.cache_clear()
    with pytest.raises(RuntimeError, match="know_regions"):
        vector.valid_zone("Europe/Paris")
    know_regions(jvm_regions(spark))
    assert vector.valid_zone("Europe/Paris") and not vector.valid_zone("Nope/X") and not vector.valid_zone("EST")
    vector.valid_zone.cache_clear()


def test_masks_of_many_keys_are_handed_on(spark, monkeypatch):
    from csvforge.functions import vector
    monkeypatch.setattr(vector, "KEYS_HELD", 3)
    batches = [pa.RecordBatch.from_pydict({"k": [f"k{i}", f"k{i + 1}"], "c": [str(i), "x"], "bad": [False, i % 2 == 0]}) for i in range(20)]
    got = {}
    for b in vector.keyed_partial_masks(["k"], ["c"], "bad")(batches):
        for r in b.to_pylist():
            m, n = got.get(r["k"], (0, 0))
            got[r["k"]] = (m | r["c"], n + r["_n_flag"])
    whole = {r["k"]: (r["c"], r["_n_flag"]) for b in vector.keyed_partial_masks(["k"], ["c"], "bad")([pa.Table.from_batches(batches).combine_chunks().to_batches()[0]])
             for r in b.to_pylist()}
    assert got == whole and len(got) == 21
