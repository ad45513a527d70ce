import csv
import io
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from csvforge.options import IngestOptions
from csvforge.sources import bytescan as bs

from helpers import write


class _F:
    """In-memory stand-in for a pyarrow random access file."""

    def __init__(self, data: bytes):
        self.data = data

    def read_at(self, n, pos):
        return self.data[pos:pos + n]


def test_line_reader_terminators():
    data = b"a\nb\rc\r\nd\n\n\re"
    r = bs.LineReader(_F(data), 0, len(data))
    lines = []
    while r.pos < len(data):
        lines.append(r.read_line())
    assert lines == [b"a", b"b", b"c", b"d", b"", b"", b"e"]


def test_line_reader_across_blocks(monkeypatch):
    monkeypatch.setattr(bs, "READ_BLOCK", 3)
    data = b"abcdefgh\r\nij\n"
    r = bs.LineReader(_F(data), 0, len(data))
    assert r.read_line() == b"abcdefgh" and r.pos == 10
    assert r.read_line() == b"ij" and r.pos == 13


def test_java_split_count():
    c = ord(",")
    assert bs.java_split_count(b"a,b,c", c) == 3
    assert bs.java_split_count(b"a,b,,", c) == 2
    assert bs.java_split_count(b",,,", c) == 0
    assert bs.java_split_count(b"", c) == 1
    assert bs.java_split_count(b"abc", c) == 1


def _kinds(line):
    return bs.classify_quotes(np.frombuffer(line, np.uint8), ord('"'), ord(","))[1].tolist()


def test_quote_kinds():
    K = bs
    assert _kinds(b'7,"a ""b"""') == [K.OPEN, K.UNKNOWN, K.UNKNOWN, K.UNKNOWN, K.UNKNOWN, K.UNKNOWN]
    assert _kinds(b'7,pier,"Bridge, old"') == [K.OPEN, K.CLOSED]
    assert _kinds(b'quay",x') == [K.CLOSED]


HEADER = b"Year,Make,Description\n"


def _heuristic(data: bytes, start: int, end: int, n=3):
    return bs.heuristic_split_point(_F(data), start, end, len(data), n, ord(","), ord('"'))


def test_heuristic_open_quote_line():
    body = b'1997,Ford,"partial\nmore"\n"quoted start",2000,x\n1,2,3\n'
    data = HEADER + body
    start = len(HEADER) + 3                        # inside the first record
    want = data.index(b'"quoted start"')
    # the line after the partial one closes a quote -> point after it
    assert _heuristic(data, start, len(data)) == data.index(b'"quoted start"')
    assert _heuristic(data, data.index(b"more"), len(data)) == want


def test_heuristic_closed_quote_line():
    data = HEADER + b'1,2,"a\nb\ncont",x\nZ,Y,W\n'
    start = data.index(b"b\ncont") - 1             # window starts inside the quoted field
    assert _heuristic(data, start, len(data)) == data.index(b"Z,Y,W")


def test_heuristic_column_counts():
    data = HEADER + b"1,2,3\n4,5,6\n7,8,9\n"
    start = data.index(b"1,2,3") + 2
    assert _heuristic(data, start, len(data)) == data.index(b"7,8,9")


def test_heuristic_no_point():
    data = HEADER + b"x\n\n\n\n\n\n\n\n"            # blank / narrow lines never qualify
    assert _heuristic(data, len(HEADER) + 1, len(data)) is None


def _scan(data, quote='"', sep=",", rec=None, trim=True, after=b""):
    return bs.Scan(data, after, bs.Dialect(ord(quote), ord(sep), rec, trim))


def _walk(data, after, d, state):
    """The automaton byte by byte: (record ends, what a line reader may miss, state behind)."""
    ends, inside = [], 0
    for i, b in enumerate(data):
        follow = (data[i + 1:i + 2] or after[:1])
        line_end = b == d.rec if d.rec is not None else b == 10 or (b == 13 and follow != b"\n")
        if state == bs.QUOTED:
            inside += line_end
            state = bs.SEEN if b == d.quote else state
        elif state == bs.SEEN and b == d.quote:
            state = bs.QUOTED
        elif line_end:
            ends.append(i + 1)
            state = bs.FIELD
        elif b == d.sep:
            state = bs.FIELD
        elif state == bs.FIELD and b == d.quote:
            state = bs.QUOTED
        elif b <= 0x20 and (state in (bs.SEEN, bs.SPACED) or (state == bs.FIELD and d.trim)):
            inside += state == bs.SEEN and not (b == 13 and follow == b"\n")
            state = bs.SPACED if state != bs.FIELD else state
        else:
            state = bs.PLAIN
    return ends, inside, state


@pytest.mark.parametrize("rec", [None, 10, ord(";")])
@pytest.mark.parametrize("trim", [True, False])
def test_scan_equals_the_automaton_walked_byte_by_byte(rec, trim):
    rnd = random.Random(f"{rec}{trim}")
    d = bs.Dialect(ord('"'), ord(","), rec, trim)
    for n in list(range(6)) * 150 + [rnd.randrange(7, 60) for _ in range(900)]:
        data = bytes(rnd.choice(b'"""",,;a \t\r\n\n') for _ in range(n))
        after = bytes(rnd.choice(b'"a\n\r') for _ in range(rnd.randrange(2)))
        scan = bs.Scan(data, after, d)
        for state in bs.STATES:
            ends, inside, behind = _walk(data, after, d, state)
            assert (scan.ends(state).tolist(), int(scan.inside(state).sum()) + scan.spaced(state), scan.state(state)) == (ends, inside, behind), (
                data, after, state)


def test_chunk_functions_compose(monkeypatch):
    monkeypatch.setattr(bs, "READ_BLOCK", 1)
    rnd = random.Random(2)
    for _ in range(60):
        data = bytes(rnd.choice(b'"",a \r\n') for _ in range(80))
        d = bs.Dialect(ord('"'), ord(","), None, True)
        cuts = [0, *sorted(rnd.sample(range(1, 80), 5)), 80]
        state = bs.FIELD
        for a, b in zip(cuts, cuts[1:]):
            behind, inside, _ = bs.transitions(_F(data), a, b, d)
            _, want, after = _walk(data[a:b], data[b:], d, state)
            assert (inside[state], behind[state]) == (want, after)
            state = after


def test_scan_examples():
    assert _scan(b'a,"b\nc"\nd\n').ends(bs.FIELD).tolist() == [8, 10]
    assert _scan(b'a,"b\nc"\nd\n').ends(bs.QUOTED).tolist() == [5, 8, 10]
    assert _scan(b'5" x,1\n"a"b,"c\n').ends(bs.FIELD).tolist() == [7]
    assert _scan(b"a\rb\r\nc\n\r", after=b"\n").ends(bs.FIELD).tolist() == [2, 5, 7]


def _whole_rows(rows, n):
    """Per file, the rows of full width as text, and how many are not."""
    out = {}
    for r in rows:
        good, bad = out.setdefault(r.file, ([], [0]))
        if r.corrupt:
            bad[0] += 1
        else:
            good.append(str(tuple(r[f"c{i}"] for i in range(n))))
    return {k: (sorted(g), b) for k, (g, b) in out.items()}


@pytest.mark.parametrize("chunk", [1, 17, 4096])
def test_stray_quotes_read_as_the_parser_reads_the_whole_file(spark, tmp, chunk):
    """Random quotes anywhere: records of chunked files equal the parser's own on whole files."""
    from csvforge.sources.files import list_files
    from csvforge.sources.records import parse_csv_records
    from csvforge.sources.splitter import read_records
    rnd = random.Random(7)
    parts = ["a", "b", " ", '"', '""', "x\"y", '5" x', '"\n"', '"a" a"', '"q,\nr"', "\n"]
    for i in range(25):
        body = "\n".join(",".join("".join(rnd.choice(parts) for _ in range(rnd.randrange(4))) for _ in range(3)) for _ in range(12))
        write(f"{tmp}/in/f{i}.csv", body + '\nz,"end",y\n')
    opts = IngestOptions(chunk_size=chunk, line_sep="\n")
    recs = read_records(list_files(spark, f"{tmp}/in"), opts)
    names = [f"c{i}" for i in range(3)]
    parsed = parse_csv_records(recs, "record", 3, opts, names=names).selectExpr("*", "substring_index(path, '/', -1) AS file")
    own = dict(opts.csv_parser_options(), header="false", multiLine="true", lineSep="\n")
    whole = (spark.read.schema(", ".join(f"{c} string" for c in names) + ", _corrupt_record string").options(**own)
             .csv(f"{tmp}/in").selectExpr("*", "_metadata.file_name AS file", "_corrupt_record IS NOT NULL AS corrupt"))
    blank = "concat_ws('', c0, c1, c2) <> '' OR NOT corrupt"           # the reader of lines skips lines of blanks
    assert _whole_rows(parsed.where(blank).collect(), 3) == _whole_rows(whole.where(blank).collect(), 3)


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n", "mixed"])
@pytest.mark.parametrize("quoted", [False, True])
def test_line_ends(spark, tmp, end, quoted):
    """LF, CR, CRLF and mixed files give the same table, for every chunk size."""
    from csvforge import read_tables
    rnd = random.Random(4)
    rows = [(i, f"n{i}", f'a\r\nb\rc{i}' if quoted and i % 3 == 0 else f"t{i}") for i in range(90)]
    ends = [rnd.choice(["\n", "\r", "\r\n"]) if end == "mixed" else end for _ in rows] + ["\r" if end == "mixed" else end]
    text = "k,name,note" + ends[-1] + "".join(
        f"{k},{n}," + (f'"{t}"' if "\r" in t else t) + e for (k, n, t), e in zip(rows, ends))
    path = write(f"{tmp}/t.csv", text)
    for chunk in (5, 1 << 20):
        t = read_tables(spark, path, IngestOptions(chunk_size=chunk))["t"]
        assert t.columns == ["k", "name", "note"] and t.n_bad == 0
        assert sorted((r.k, r.name, r.note) for r in t.data.collect()) == rows


def _random_table(seed, n_rows=60, n_cols=4):
    rnd = random.Random(seed)
    alphabet = 'ab ,"\nxé\r'
    rows = []
    for _ in range(n_rows):
        rows.append([("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) or "z")
                     .strip(" ") or "z" for _ in range(n_cols)])
    return rows


def _csv_bytes(header, rows, terminator="\n"):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator=terminator)
    w.writerow(header)
    w.writerows(rows)
    return buf.getvalue().encode("utf-8")


@pytest.mark.parametrize("seed,chunk,term", [(1, 7, "\n"), (2, 64, "\n"), (3, 257, "\n"),
                                             (4, 4096, "\n"), (5, 13, "\r\n"), (6, 100, "\r\n")])
def test_exact_split_equals_whole_file_parse(spark, tmp, seed, chunk, term):
    from csvforge.sources.files import list_files
    from csvforge.sources.records import parse_csv_records
    from csvforge.sources.splitter import read_records
    header = ["c0", "c1", "c2", "c3"]
    rows = _random_table(seed)
    path = write(os.path.join(tmp, "t.csv"), _csv_bytes(header, rows, term))
    opts = IngestOptions(chunk_size=chunk, trim=False)
    files = list_files(spark, path)
    recs = read_records(files, opts).where("rec_start > 0")
    parsed = parse_csv_records(recs, "record", 4, opts, names=header)
    got = sorted((r.rec_start, [r.c0, r.c1, r.c2, r.c3]) for r in parsed.collect())
    want = [r for r in csv.reader(io.StringIO(_csv_bytes(header, rows, term).decode(), newline=""))][1:]
    assert [g[1] for g in got] == want
    assert not parsed.where("corrupt").count()


def test_heuristic_points_are_record_starts(spark, tmp):
    from csvforge.sources.files import list_files
    from csvforge.sources.splitter import point_ranges, read_headers, split_points
    from pyspark.sql import functions as F
    lines = [b"%d,make%d,plain description %d" % (i, i, i) for i in range(300)]
    quoted = [b'%d,make,"multi\nline, %d"' % (i, i) for i in range(300, 400)]
    data = HEADER + b"\n".join(lines + quoted) + b"\n"
    path = write(os.path.join(tmp, "h.csv"), data)
    opts = IngestOptions(chunk_size=512, split_mode="heuristic")
    files = read_headers(list_files(spark, path), opts, exact=False).withColumn("n_headers", F.lit(3))
    pts = sorted(r.point for r in split_points(files, opts).collect())
    starts = {0, len(HEADER)} | {m + 1 for m in range(len(data)) if data[m:m + 1] == b"\n"}
    assert pts[0] == len(HEADER) and pts[-1] == len(data)
    assert len(pts) > 10
    for p in pts:
        assert p in starts
        assert not data[p:].startswith(b"line, ")   # never inside a quoted field
    ranges = point_ranges(split_points(files, opts), files).collect()
    assert sum(r.end - r.start for r in ranges) == len(data) - len(HEADER)


def test_regex_points(spark, tmp):
    from csvforge.sources.files import list_files
    from csvforge.sources.splitter import read_headers, split_points
    recs = [b"%04d,make,text with\nnewline %d" % (1990 + i % 20, i) for i in range(200)]
    data = HEADER + b"\n".join(recs) + b"\n"
    path = write(os.path.join(tmp, "r.csv"), data)
    opts = IngestOptions(record_regex=r"\n(?=\d{4},)", field_regex=",", chunk_size=512)
    files = read_headers(list_files(spark, path), opts, exact=False)
    pts = sorted(r.point for r in split_points(files, opts).collect())
    assert pts[0] == len(HEADER) and pts[-1] == len(data)
    for p in pts[1:-1]:
        assert data[p - 1:p] == b"\n" and data[p:p + 4].isdigit() and data[p + 4:p + 5] == b","


def _simple_heuristic(data: bytes, start: int, end: int, n: int):
    """Whole-buffer restatement of the importer's rule (lines via regex)."""
    import re as _re
    lines = [(m.start(), m.end(), m.group(1)) for m in _re.finditer(rb"([^\r\n]*)(\r\n|\r|\n|$)", data)
             if m.start() < len(data) or m.group(0)]
    def line_at(pos):
        for s, e, body in lines:
            if s == pos:
                return e, body
        return len(data), b""
    pos, _ = line_at(start) if any(s == start for s, _, _ in lines) else (None, None)
    if pos is None:   # start inside a line: skip to the end of that line
        pos = next(e for s, e, _ in lines if s <= start < max(e, s + 1))
    prev = None
    while pos < end:
        nxt, line = line_at(pos)
        kinds = _kinds(line)
        if not kinds:
            if prev and bs.java_split_count(prev, ord(",")) + bs.java_split_count(line, ord(",")) > n + 1:
                return pos
            prev = line
        else:
            prev = None
            if kinds[0] == bs.OPEN:
                return pos
            if kinds[-1] == bs.CLOSED:
                return nxt
        if nxt == pos:
            break
        pos = nxt
    return None


@pytest.mark.parametrize("seed", range(6))
def test_heuristic_matches_simple_restatement(seed, monkeypatch):
    monkeypatch.setattr(bs, "READ_BLOCK", 7)         # force block-boundary handling
    rnd = random.Random(seed)
    parts = [rnd.choice(['1,2,3', 'a,"b', 'c",d', '"q",x', 'x,y', '', 'x,"y""z",w', '7,8,9,10'])
             + rnd.choice(["\n", "\r\n", "\r"]) for _ in range(60)]
    data = b"h1,h2,h3\n" + "".join(parts).encode()
    for start in range(9, len(data) - 1, 5):
        end = min(start + rnd.randint(5, 60), len(data))
        assert _heuristic(data, start, end) == _simple_heuristic(data, start, end, 3), (start, end)


def test_exact_points_are_true_boundaries(spark, tmp):
    from csvforge.sources.files import list_files
    from csvforge.sources.splitter import split_points, read_headers
    rows = _random_table(9, n_rows=200)
    data = _csv_bytes(["c0", "c1", "c2", "c3"], rows)
    path = write(os.path.join(tmp, "e.csv"), data)
    opts = IngestOptions(chunk_size=97, trim=False)
    files = read_headers(list_files(spark, path), opts)
    pts = sorted(r.point for r in split_points(files, opts, mode="exact").collect())
    true_starts = {0, *_walk(data, b"", bs.Dialect(34, 44, None, False), bs.FIELD)[0]}
    assert pts and all(p in true_starts or p == len(data) for p in pts)
    # every chunk start that is followed by a boundary inside its chunk yields one
    for c in range(97, len(data), 97):
        inside = [p for p in true_starts if c <= p < min(c + 97, len(data))]
        if inside:
            assert min(inside) in pts


def test_range_bytes(spark, tmp):
    from csvforge.sources.splitter import read_range_bytes
    letters = b"abcdefghijklmnopqrstuvwxyz"
    a = write(os.path.join(tmp, "rb", "a.txt"), letters)
    b = write(os.path.join(tmp, "rb", "b.txt"), letters.upper())
    pts = [(p, x) for p in ("file:" + a,) for x in (26, 0, 1, 14, 10, 10)] + \
          [("file:" + b, x) for x in (0, 26, 13)]
    df = spark.createDataFrame(pts, "path string, point bigint")
    got = sorted((r.path.rsplit("/", 1)[-1], r.start, bytes(r.content)) for r in read_range_bytes(df).collect())
    assert got == [("a.txt", 0, b"a"), ("a.txt", 1, b"bcdefghij"), ("a.txt", 10, b"klmn"),
                   ("a.txt", 14, b"opqrstuvwxyz"), ("b.txt", 0, b"ABCDEFGHIJKLM"), ("b.txt", 13, b"NOPQRSTUVWXYZ")]
    empty = spark.createDataFrame([], "path string, point bigint")
    assert read_range_bytes(empty).count() == 0


def test_record_ends_with_blanks_and_stray_quotes():
    data = b'1,screen 5",x\n2,"a\nb",y\n3," q ""z"" ",w\n4,z'
    assert _scan(data).ends(bs.FIELD).tolist() == [data.index(b"2,"), data.index(b"3,"), data.index(b"4,")]
    assert _scan(b'a,  "x\ny",z\n').ends(bs.FIELD).tolist() == [12]          # blanks before a quote
    assert _scan(b'a,  "x\ny",z\n', trim=False).ends(bs.FIELD).tolist() == [7, 12]


@pytest.mark.parametrize("seed", range(5))
def test_record_ends_match_csv_module(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(['a', 'b', ',', '"', '""', ' ', '\n', 'x"y']) for _ in range(400))
    text = text.rstrip("\n") + "\n"
    data = text.encode()
    ends = _scan(data, rec=10, trim=False).ends(bs.FIELD).tolist()
    starts = [0] + ends[:-1]
    pieces = [data[s:e].decode() for s, e in zip(starts, ends)]
    whole = list(csv.reader(io.StringIO(text, newline="")))
    per_piece = [row for p in pieces for row in csv.reader(io.StringIO(p, newline=""))]
    assert per_piece == whole


def test_length_limits():
    data = b'"open quote never closed\n' + b"x" * 100
    with pytest.raises(ValueError, match="no record end outside quotes"):
        bs.first_end(_F(data), 0, len(data), bs.Dialect(34, 44), bs.FIELD, limit=50)
    assert bs.first_end(_F(b"a,b\nc"), 0, 5, bs.Dialect(34, 44), bs.FIELD, limit=50) == 4
    r = bs.LineReader(_F(b"y" * 100), 0, 100)
    with pytest.raises(ValueError, match="longer than 10 bytes"):
        r.read_line(10)
    from csvforge.sources.splitter import _check_ranges, MAX_RECORD_BYTES
    _check_ranges(1, 10, 10)
    with pytest.raises(ValueError, match="no split point"):
        _check_ranges(1, MAX_RECORD_BYTES + 1, MAX_RECORD_BYTES + 1)


REGEX_SEPARATORS = {r"\r?\n": ["\r\n", "\n"], r"-+\n": ["-\n", "-----\n"], r"\n(?! )": ["\n"], r";": [";", ";;;"],
                    r"(?<=x\n)": ["x\n"]}


def _java_split(text, regex):
    """String.split on a whole text: trailing empty strings are dropped."""
    parts = re.split(regex, text)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _regex_file(rnd, regex):
    seps = REGEX_SEPARATORS[regex]
    body = "".join(f"k{i},{'y' * rnd.randint(0, 9)}{rnd.choice(['', chr(233), chr(0x65e5)])}"
                   + (f"{chr(10)} more{i}" if regex == r"\n(?! )" and i % 3 == 0 else "") + rnd.choice(seps) for i in range(60))
    return body + rnd.choice(["", seps[0] * 40, "last,one", "last,one\n"])


@pytest.mark.parametrize("regex", [r"\r?\n", r"-+\n", r"\n(?! )", r";"])
def test_regex_records_do_not_depend_on_chunks(spark, tmp, regex):
    """Rows and bad records equal a split of the whole text, for every chunk size and whatever
    stands at chunk edges; empty records at the end of a file are none."""
    from csvforge import read_tables
    rnd = random.Random(regex)
    want = {}
    for i in range(3):
        body = _regex_file(rnd, regex)
        write(f"{tmp}/in/f{i}.csv", "a,b\n" + body)
        recs = _java_split(body if body.endswith(tuple(REGEX_SEPARATORS[regex])) else re.sub("\n$", "", body), regex)
        want[f"f{i}"] = (sorted((r.split(",")[0], r.split(",")[1] or None) for r in recs if r.count(",") == 1 and not r.endswith(",")),
                         sum(not (r.count(",") == 1 and not r.endswith(",")) for r in recs))
    for chunk in (7, 333, 1 << 20):
        got = read_tables(spark, f"{tmp}/in", IngestOptions(record_regex=regex, field_regex=",", chunk_size=chunk, bad_rows="quarantine"))
        assert {k: (sorted((r.a, r.b) for r in t.data.collect()), t.n_bad) for k, t in got.items()} == want, chunk


def test_regex_search_grows_only_where_it_must(spark, tmp, monkeypatch):
    """Separators longer than a piece, none for a long stretch, and one cut by a piece's edge."""
    from csvforge.sources import regexsplit
    from csvforge.sources.files import list_files
    from csvforge.sources.splitter import read_headers, split_points
    data = HEADER + b"a" * 30_000 + b"-" * 20_000 + b"\n" + b"b" * 3000 + b"--\n" + b"c" * 50_000 + b"-\n" + b"d" * 9000
    path = write(os.path.join(tmp, "r.csv"), data)
    opts = IngestOptions(record_regex=r"-+\n", field_regex=",", chunk_size=16_384)
    files = read_headers(list_files(spark, path), opts, exact=False)
    rounds = []
    real = regexsplit._pieces
    monkeypatch.setattr(regexsplit, "_pieces", lambda o, left, reach: rounds.append(reach) or real(o, left, reach))
    pts = sorted((r.point, r.sep_len) for r in split_points(files, opts).collect())
    ends = [(m.end(), m.end() - m.start()) for m in re.finditer(rb"-+\n", data)
            if any(w <= m.start() < w + 16_384 for w in range(16_384, len(data) - len(data) % 16_384 + 1, 16_384))]
    assert [p for p in pts if p[1]] == ends and len(rounds) > 1
    monkeypatch.setattr(regexsplit, "MAX_REACH", 1 << 14)
    with pytest.raises(ValueError, match="reaches beyond"):
        split_points(files, opts)


def test_regex_search_reads_little(spark, tmp, monkeypatch):
    """Points cost a few KiB a window, not the windows."""
    from csvforge.sources import regexsplit
    from csvforge.sources.files import list_files
    from csvforge.sources.splitter import read_headers, split_points
    path = write(os.path.join(tmp, "r.csv"), HEADER + b"".join(b"%04d,x,%s\n" % (1900 + i % 90, b"t" * 50) for i in range(40_000)))
    opts = IngestOptions(record_regex=r"\n(?=\d{4},)", field_regex=",", chunk_size=1 << 18)
    files = read_headers(list_files(spark, path), opts, exact=False)
    rounds = []
    real = regexsplit._pieces
    monkeypatch.setattr(regexsplit, "_pieces", lambda o, left, reach: rounds.append(left + reach) or real(o, left, reach))
    n = split_points(files, opts).count() - 2
    assert n == os.path.getsize(path) >> 18 and sum(rounds) < 0.05 * (1 << 18)


def test_regex_offsets_of_invalid_bytes_and_other_encodings(spark, tmp):
    from csvforge import read_tables
    for name, raw, enc in (("u", b"a,b\n" + b"k\xff\xfe,\xc3\xa9\xe6\x97\n" * 40, "utf-8"),
                           ("l", "a,b\n".encode("latin-1") + "k\xe9\xe9,\xfc\n".encode("latin-1") * 40, "latin-1")):
        path = write(f"{tmp}/{name}.csv", raw)
        for chunk in (9, 1 << 20):
            t = read_tables(spark, path, IngestOptions(record_regex="\n", field_regex=",", chunk_size=chunk, encoding=enc))[name]
            rows = t.data.collect()
            assert t.n_bad == 0 and len(rows) == 40 and len(set(rows)) == 1


def test_adjacent_chunks_of_a_task_are_read_together(tmp, monkeypatch):
    """Few reads for many small chunks; the records do not depend on which chunks come together."""
    import pyarrow as pa
    from csvforge.sources import bytescan as bs, splitter
    opts = IngestOptions(chunk_size=64)
    body = "a,b\n" + "".join(f'{i},"x\n{"y" * (i % 90)}"\n' if i % 3 else f"{i},z\n" for i in range(200))
    path = f"{tmp}/f.csv"
    with open(path, "w", newline="") as f:
        f.write(body)
    size, state, rows = len(body), bs.FIELD, []
    with splitter.open_input(path) as f:
        for k, start in enumerate(range(0, size, 64)):
            end = min(start + 64, size)
            rows.append({"path": path, "size": size, "chunk_idx": k, "start": start, "end": end, "state": state, "table": "t"})
            state = bs.transitions(f, start, end, opts.dialect)[0][state]
    opened, real = [], splitter.open_input
    monkeypatch.setattr(splitter, "open_input", lambda p: opened.append(p) or real(p))

    def read(parts):
        run = splitter._read_exact(opts)
        return sorted((r["rec_start"], r["record"]) for p in parts for b in run([pa.RecordBatch.from_pylist(p)]) for r in b.to_pylist())
    together = read([rows[::-1]])
    assert len(opened) == 1 and len(together) == 201
    assert together == read([[r] for r in rows]) == read([rows[::2], rows[1::2]])
    del opened[:]
    import pandas as pd
    out = list(splitter._chunk_functions(opts)([pd.DataFrame(rows[::-1]).drop(columns="state")]))[0]
    assert len(opened) == 1 and list(out["chunk_idx"]) == list(range(len(rows)))
    state = bs.FIELD
    for row, behind in zip(rows, out["behind"]):
        assert row["state"] == state
        state = behind[state]
