from pyspark.sql import functions as F

from csvforge.operators.headers import header_table, split_header


def _table(spark, lines, case_sensitive=True):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, header_line string")
    rows = header_table(df, case_sensitive=case_sensitive).orderBy("i").collect()
    return [(r.names, r.valid) for r in rows]


def test_normalize_and_validate(spark):
    got = _table(spark, [
        '"YEAR","MAKE",DESCRIPTION',      # quotes stripped
        "BIRTH.DATE,GENDER,HEIGHT",        # non-word -> _
        "1997,Ford,E350",                  # data where the header should be
        "a,b,a",                           # duplicate
        "a,,b",                            # blank
        "naïve col😀,x",                   # non-ASCII -> one _ per character
        "N,name",                          # N infers as BOOLEAN -> invalid
        "A,a",                             # distinct when case-sensitive
    ])
    assert got[0] == (["YEAR", "MAKE", "DESCRIPTION"], True)
    assert got[1] == (["BIRTH_DATE", "GENDER", "HEIGHT"], True)
    assert got[2][1] is False
    assert got[3][1] is False
    assert got[4][1] is False
    assert got[5] == (["na_ve_col_", "x"], True)
    assert got[6][1] is False
    assert got[7][1] is True
    assert _table(spark, ["A,a"], case_sensitive=False)[0][1] is False


def test_quote_aware_split(spark):
    df = spark.createDataFrame([('a,"b,c",d',), ("x|y|z",), ("one",)], "l string")
    rows = df.select(split_header(F.col("l")).alias("c"),
                     split_header(F.col("l"), sep="|").alias("p")).collect()
    assert rows[0].c == ["a", '"b,c"', "d"]
    assert rows[1].p == ["x", "y", "z"]           # literal, not a regex alternation
    assert rows[2].c == ["one"]


def test_any_non_string_matches_per_element_rule(spark):
    import random
    from csvforge.functions import types as ft
    from csvforge.functions.infer import infer_code
    from csvforge.operators.headers import any_non_string
    rnd = random.Random(2)
    pieces = ["a", "Y", "no", "12", "1e5", "0x1p3", "NaN", "10:15", "2018-11-18", "2018-02-30",
              "2018-11-18T10:00", "x_y", " 12", "TRUE", "nan", "1_0", "", "é", "2018-11-18T10:00+05:00[Nope/X]"]
    rows = [[rnd.choice(pieces) for _ in range(rnd.randint(1, 5))] for _ in range(400)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, names array<string>")
    got = df.select("i", any_non_string(F.col("names")).alias("a"),
                    F.exists("names", lambda x: infer_code(x) != F.lit(ft.STRING)).alias("b")).collect()
    bad = [(rows[r.i], r.a, r.b) for r in got if r.a != r.b]
    assert not bad, bad[:5]


def test_quote_aware_split_property(spark):
    import random
    rnd = random.Random(8)
    lines = ["".join(rnd.choice('ab,"') for _ in range(rnd.randint(0, 14))) for _ in range(400)]

    def expected(line):
        out, cur = [], ""
        for i, ch in enumerate(line):
            if ch == "," and line[i + 1:].count('"') % 2 == 0:
                out.append(cur)
                cur = ""
            else:
                cur += ch
        return out + [cur]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    got = {r.i: r.c for r in df.select("i", split_header(F.col("l")).alias("c")).collect()}
    for i, l in enumerate(lines):
        assert got[i] == expected(l), l


def test_normalize_headers_matches_per_element(spark):
    import random
    from csvforge.functions.text import normalize_header
    from csvforge.operators.headers import normalize_headers
    rnd = random.Random(6)
    alphabet = ['"', "a", "Z", "9", "_", ".", " ", "é", "😀", "\n", "\r", "-", " "]
    rows = [["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 5)))
             for _ in range(rnd.randint(1, 4))] for _ in range(500)] + [[], ['"'], ['""'], ['a"\n']]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, names array<string>")
    got = df.select("i", normalize_headers(F.col("names")).alias("a"),
                    F.transform("names", lambda x: normalize_header(x)).alias("b")).collect()
    bad = [(rows[r.i], r.a, r.b) for r in got if r.a != r.b]
    assert not bad, bad[:5]
