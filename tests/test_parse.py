from pyspark.sql import functions as F

from csvforge.functions.text import java_split
from csvforge.options import IngestOptions
from csvforge.sources.records import parse_csv_records

TEXT = ('2011,Oslo,"Fjord ""north arm"" pier"\n'
        '2012,Oslo,"Fjord ""north arm, outer"" pier"\n'
        '2015,Turin,"Bridge, old"\n'
        '2020,Porto,"CLOSED\nsteps, tower, quay"')


def test_csv_records(spark):
    recs = ['2011,Oslo,"Fjord ""north arm"" pier"', '2015,Turin,"Bridge, old"',
            '2020,Porto,"CLOSED\nsteps, tower, quay"', '1,2', '1,2,3,4']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(recs)], "i int, record string")
    rows = parse_csv_records(df, "record", 3, IngestOptions(), names=["y", "m", "d"],
                             count_fields=True).orderBy("i").collect()
    assert rows[0].d == 'Fjord "north arm" pier'
    assert rows[1].d == "Bridge, old"
    assert rows[2].d == "CLOSED\nsteps, tower, quay"
    assert [r.corrupt for r in rows] == [False, False, False, True, True]
    assert [r.n_fields for r in rows] == [3, 3, 3, 2, 4]


def test_regex_mode_keeps_quotes(spark):
    df = spark.createDataFrame([(TEXT,)], "t string")
    recs = df.select(F.posexplode(java_split(F.col("t"), r"\n(?=\d{4})")).alias("i", "r"))
    fields = recs.select("i", java_split(F.col("r"), r",(?=\S+)").alias("f")).orderBy("i").collect()
    flat = [x for r in fields for x in r.f]
    assert flat == ["2011", "Oslo", '"Fjord ""north arm"" pier"',
                    "2012", "Oslo", '"Fjord ""north arm, outer"" pier"',
                    "2015", "Turin", '"Bridge, old"',
                    "2020", "Porto", '"CLOSED\nsteps, tower, quay"']


def test_java_split_semantics(spark):
    cases = [("a,b,,", ",", ["a", "b"]), (",,,", ",", []), ("", ",", [""]), (",a", ",", ["", "a"]),
             ("abc", ",", ["abc"]), ("a  b ", " +", ["a", "b"])]
    df = spark.createDataFrame([(s, r) for s, r, _ in cases], "s string, r string")
    for (s, r, want) in cases:
        got = df.where((F.col("s") == s) & (F.col("r") == r)).select(java_split(F.col("s"), r).alias("x")).first().x
        assert got == want, (s, r)


def _java_split_py(s, regex):
    import re
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_property(spark):
    import random
    rnd = random.Random(4)
    values = ["".join(rnd.choice("ab, \n|") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for regex in [",", " +", "\\n+", "\\|"]:
        got = {r.i: r.x for r in df.select("i", java_split(F.col("v"), regex).alias("x")).collect()}
        for i, v in enumerate(values):
            assert got[i] == _java_split_py(v, regex), (v, regex)
