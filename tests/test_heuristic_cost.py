"""What the heuristic split, the inference and the date-time cast spend on a row."""
import random

import numpy as np
import pyarrow as pa

from csvforge.functions import types as ft
from csvforge.functions import vector
from csvforge.sources import bytescan as bs


class _File:
    def __init__(self, data):
        self.data, self.n_read = data, 0

    def read_at(self, n, at):
        got = self.data[at:at + n]
        self.n_read += len(got)
        return got


def test_window_is_not_read_whole_where_its_first_lines_tell():
    data = b"a,b,c\n" + b"".join(b"%d,x,y\n" % i for i in range(60_000))
    f = _File(data)
    point = bs.heuristic_split_point(f, 65_536, 131_072, len(data), 3, ord(","), ord('"'))
    assert data[point - 1:point] == b"\n" and f.n_read < 20_000


def test_window_head_gives_the_point_of_the_whole_window(monkeypatch):
    rnd = random.Random(4)
    parts = ['"a b"', "x", "", '"l\nm"', '"q""q"', "7", '""']
    data = "".join(",".join(rnd.choice(parts) for _ in range(3)) + rnd.choice(["\n", "\r\n", "\r"]) for _ in range(900)).encode()
    spans = [(s, min(len(data), s + 700)) for s in range(0, len(data), 37)]

    def points():
        return [bs.heuristic_split_point(_File(data), s, e, len(data), 3, ord(","), ord('"')) for s, e in spans]

    monkeypatch.setattr(bs, "WINDOW_HEAD", 1 << 20)
    whole = points()
    for head in (8, 40, 200):
        monkeypatch.setattr(bs, "WINDOW_HEAD", head)
        assert points() == whole


def test_repeated_values_are_judged_once(monkeypatch):
    seen, judge = [], vector.classify_array
    monkeypatch.setattr(vector, "classify_array", lambda a: (seen.append(len(a)), judge(a))[1])
    values = ["1", "x", None, "", "2020-01-01", "yes", "+5", "99999999999"] * 1000
    batch = pa.record_batch({"k": pa.array(["t"] * len(values)), "c": pa.array(values)})
    (_, masks, _), = vector._task_masks([batch], ["k"], ["c"], None)
    assert sum(seen) < 100
    want = int(np.bitwise_or.reduce([ft.BIT[c] for c in (ft.INT, ft.STRING, ft.UNKNOWN, ft.DATE, ft.BOOLEAN, ft.LONG)]))
    assert int(masks[("t",)][0]) == want


def test_regexes_see_only_texts_they_may_match(monkeypatch):
    seen, full = [], vector._full
    monkeypatch.setattr(vector, "_full", lambda a, r: (seen.append(len(a)), full(a, r))[1])
    codes = vector.classify_array(pa.array(["some words %d" % i for i in range(5000)] + ["-4", "1.5", "t", "12:30", None]))
    assert max(seen) < 10
    assert codes[-5:].tolist() == [ft.INT, ft.DOUBLE, ft.BOOLEAN, ft.TIME, ft.UNKNOWN] and (codes[:-5] == ft.STRING).all()


def test_zoned_date_times_are_cast_apart_from_the_others(spark):
    from csvforge.operators.fill import fill_typed
    rows = spark.range(4).selectExpr("element_at(array('2020-01-02T03:04:05.5', '2020-07-01T12:00:00+02:00[Europe/Paris]', '', null),"
                                     " int(id) + 1) AS c")
    typed = fill_typed(rows, ["c"], [ft.DATETIME], trusted=True)
    assert sorted(str(r[0]) for r in typed.collect()) == ["2020-01-02 03:04:05.500000", "2020-07-01 12:00:00", "None", "None"]
    plan = spark._jvm.PythonSQLUtils.explainString(typed._jdf.queryExecution(), "simple")
    own = plan[plan.index("transform(array(c"):]
    assert plan.count("RLIKE") == own.count("RLIKE") > 0       # the zone's tests are all in the lambda
