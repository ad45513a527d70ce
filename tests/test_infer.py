import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from csvforge.functions import convert, infer

# (text, type); expected values were checked against the JDK's own parsers
# (Integer/Long/Double.parseDouble, ISO_DATE, ISO_TIME, ISO local/offset/zoned date-time).
CASES = [
    ("123", "INT"), ("12345678901234", "LONG"), ("2.31", "DOUBLE"), ("true", "BOOLEAN"),
    ("Y", "BOOLEAN"), ("No", "BOOLEAN"), ("T", "BOOLEAN"), ("2018-11-18", "DATE"),
    ("11:25:33", "TIME"), ("2018-11-18T11:25:33", "DATETIME"), ("abc", "STRING"), ("", "UNKNOWN"),
    ("2018-11-18+18:01", "DATE"), ("2018-11-18+23:59", "DATE"), ("2018-11-18+24:00", "STRING"),
    ("2018-11-18+05", "STRING"), ("2018-11-18z", "DATE"), ("2018-02-30", "STRING"),
    ("+2018-11-18", "STRING"), ("10:15", "TIME"), ("10:15:30.", "TIME"), ("10:15:30.000", "TIME"),
    ("10:15:30.123456789", "TIME"), ("10:15:30.1234567891", "STRING"), ("24:00", "STRING"),
    ("10:15+18:01", "TIME"), ("2018-11-18t11:25:33", "DATETIME"), ("2018-11-18T11:25", "DATETIME"),
    ("2018-11-18T11:25:33+18:01", "STRING"), ("2018-11-18T11:25:33+05:00[Europe/Paris]", "DATETIME"),
    ("2018-11-18T11:25:33Z[Europe/Paris]", "DATETIME"), ("2018-11-18T11:25:33[Europe/Paris]", "STRING"),
    ("2018-11-18T11:25:33+05:00[Nope/Zone]", "STRING"), ("2018-11-18T11:25:33+05:00[EST]", "STRING"),
    ("2018-11-18T11:25:33+05:00[europe/paris]", "STRING"), ("2018-11-18 11:25:33", "STRING"),
    ("1d", "DOUBLE"), ("1.5F", "DOUBLE"), ("0x1p3", "DOUBLE"), ("NaN", "DOUBLE"),
    ("-Infinity", "DOUBLE"), ("nan", "STRING"), (" 12", "DOUBLE"), ("\t12\n", "DOUBLE"),
    ("1e5", "DOUBLE"), (".5", "DOUBLE"), ("1.", "DOUBLE"), ("+.5e-3", "DOUBLE"), ("0x.8p1", "DOUBLE"),
    ("1_0", "STRING"), ("99999999999999999999", "DOUBLE"), ("007", "INT"), ("-0", "INT"),
    ("0", "INT"), ("1", "INT"), ("2147483647", "INT"), ("2147483648", "LONG"),
    ("-2147483648", "INT"), ("9223372036854775807", "LONG"), ("9223372036854775808", "DOUBLE"),
    ("12\n", "DOUBLE"), ("abc\n", "STRING"), ("FALSE", "BOOLEAN"), ("yes ", "STRING"),
]


@pytest.fixture(scope="module")
def inferred(spark):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
    return {r.v: r for r in df.select(
        "v", infer.infer_type_name(F.col("v")).alias("t"), convert.to_date(F.col("v")).alias("d"),
        convert.to_time(F.col("v")).alias("tm"), convert.to_datetime(F.col("v")).alias("ts"),
        convert.to_double(F.col("v")).alias("dbl"), convert.to_int(F.col("v")).alias("i"),
        convert.to_long(F.col("v")).alias("l"), convert.to_boolean(F.col("v")).alias("b")).collect()}


@pytest.mark.parametrize("value,want", CASES)
def test_infer(inferred, value, want):
    assert inferred[value].t == want


def test_conversions(inferred):
    assert inferred["2018-11-18+18:01"].d == dt.date(2018, 11, 18)
    assert inferred["10:15"].tm == "10:15:00"
    assert inferred["10:15:30."].tm == "10:15:30"
    assert inferred["10:15:30.000"].tm == "10:15:30"
    assert inferred["10:15:30.123456789"].tm == "10:15:30.123456789"
    assert inferred["2018-11-18T11:25"].ts == dt.datetime(2018, 11, 18, 11, 25)
    assert inferred["2018-11-18T11:25:33+05:00[Europe/Paris]"].ts == dt.datetime(2018, 11, 18, 7, 25, 33)
    assert inferred["2018-11-18T11:25:33Z[Europe/Paris]"].ts == dt.datetime(2018, 11, 18, 12, 25, 33)
    assert inferred["0x1p3"].dbl == 8.0
    assert inferred["1d"].dbl == 1.0
    assert inferred["\t12\n"].dbl == 12.0
    assert inferred["2147483648"].i is None and inferred["2147483648"].l == 2147483648
    assert inferred["Y"].b is True and inferred["No"].b is False and inferred["T"].b is True
    assert inferred["abc"].b is None


def test_lossy_datetime_column(spark):
    df = spark.createDataFrame([("2018-11-18",), ("2018-11-18T10:00:00",), ("10:00",), ("",)], "v string")
    rows = df.select(convert.cast_field(F.col("v"), 6).alias("x")).collect()
    assert [r.x for r in rows] == [None, dt.datetime(2018, 11, 18, 10), None, None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(min_value=-(2 ** 70), max_value=2 ** 70), min_size=1, max_size=20))
def test_integer_ranges(spark, ints):
    df = spark.createDataFrame([(str(i),) for i in ints], "v string")
    got = [r.t for r in df.select(infer.infer_type_name(F.col("v")).alias("t")).collect()]
    want = ["INT" if -2 ** 31 <= i < 2 ** 31 else "LONG" if -2 ** 63 <= i < 2 ** 63 else "DOUBLE"
            for i in ints]
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=20))
def test_double_round_trip(spark, xs):
    df = spark.createDataFrame([(repr(x),) for x in xs], "v string")
    rows = df.select(infer.infer_type_name(F.col("v")).alias("t"),
                     convert.to_double(F.col("v")).alias("d")).collect()
    for x, r in zip(xs, rows):
        assert r.t == "DOUBLE" and r.d == x


def test_zones_need_no_parser_to_be_refused(spark):
    """Known regions are told by one regex; only offsets go to the datetime parser, and both agree
    with it on every zone."""
    import re

    from csvforge.functions.infer import ZONE_CASE_RE, is_valid_zone, region_regex, words_regex
    assert words_regex(["ab", "a", "ac"]) == "a(?:b|c)?"
    odd = ["Nope/Zone", "Asia", "Asia/Tokyo2", "asia/tokyo", "UTC+3", "UTC+03:00", "GMT0", "UT", "Z", "+05:00", "+5", "Zebra", "X", ""]
    zones = [*spark._jvm.java.time.ZoneId.getAvailableZoneIds(), *odd]
    df = spark.createDataFrame([(z,) for z in zones], "z string")
    parsed = F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), "z"), F.lit("yyyy-MM-dd VV")).isNotNull() & F.col("z").rlike(ZONE_CASE_RE)
    rows = df.select("z", is_valid_zone(F.col("z")).alias("ours"), parsed.alias("parsed")).collect()
    assert [r for r in rows if r.ours != r.parsed] == [] and sum(r.ours for r in rows) > 500
    known = re.compile(region_regex().replace(r"\z", r"\Z"))
    assert not known.match("Nope/Zone") and known.match("Asia/Tokyo")
