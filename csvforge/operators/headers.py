"""Header rows: split, normalize, validate and gate."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import types as ft
from ..functions.infer import BOOLEAN_WORDS, DOUBLE_RE, TIME_RE, col_of, infer_code

# A separator no type pattern can match (private-use character).
_SEP = "\ue000"
_EASY = ("(?i:" + "|".join(BOOLEAN_WORDS) + ")|" + DOUBLE_RE + "|" + TIME_RE)
_ANY_EASY = _SEP + "(?:" + _EASY + ")(?=" + _SEP + ")"
_ANY_DATE_LIKE = _SEP + r"(?:\d{4}|[+-]\d{4,10})-\d{2}-\d{2}"


def any_non_string(names: Column) -> Column:
    """True if some name infers to a non-STRING type.  Boolean words, numbers and
    times are found by one regex over the joined names (code-generated); the
    per-element rule chain (an interpreted lambda) runs only when some name looks
    like a date, whose calendar and zone need checking."""
    names = col_of(names)
    joined = F.concat(F.lit(_SEP), F.array_join(names, _SEP), F.lit(_SEP))
    empty = F.array_contains(names, "") | (F.size(F.array_compact(names)) != F.size(names))
    easy = joined.rlike(_ANY_EASY)
    dated = joined.rlike(_ANY_DATE_LIKE)
    return empty | easy | (dated & F.exists(names, lambda x: infer_code(x) != F.lit(ft.STRING)))
from ..functions.text import normalize_header


def _lit_re(ch: str) -> str:
    return "\\" + ch if not ch.isalnum() else ch


def split_header(line: Column, sep: str = ",", quote: str = '"') -> Column:
    """Split a header line on the literal delimiter, ignoring delimiters inside
    quotes (a delimiter is a split point when an even number of quotes follows)."""
    line = col_of(line)
    s, q = _lit_re(sep), _lit_re(quote)
    nq = "[^" + q + "]"
    regex = s + "(?=(?:" + nq + "*" + q + nq + "*" + q + ")*" + nq + r"*\z)"
    return F.split(F.regexp_replace(line, r"\r?\n\z", ""), regex, -1)


def normalize_headers(names: Column, quote: str = '"') -> Column:
    return F.transform(col_of(names), lambda x: normalize_header(x, quote))


def valid_headers(names: Column, case_sensitive: bool = True) -> Column:
    """False if a name is blank, a name infers as a non-STRING type (data was
    found where the header should be), or names repeat."""
    names = col_of(names)
    blank = F.exists(names, lambda x: x.isNull() | (F.trim(x) == ""))
    typed = any_non_string(names)
    keyed = names if case_sensitive else F.transform(names, lambda x: F.lower(x))
    dup = F.size(F.array_distinct(keyed)) != F.size(keyed)
    return ~(blank | typed | dup)


def header_table(lines: DataFrame, line_col: str = "header_line", sep: str = ",",
                 quote: str = '"', case_sensitive: bool = True) -> DataFrame:
    """``(..., header_line)`` -> adds ``raw_names``, ``names`` and ``valid``."""
    raw = split_header(F.col(line_col), sep, quote)
    return (lines.withColumn("raw_names", raw)
            .withColumn("names", normalize_headers(F.col("raw_names"), quote))
            .withColumn("valid", valid_headers(F.col("names"), case_sensitive)))


def gate_headers(headers: DataFrame, path_col: str = "path", line_col: str = "header_line",
                 max_report: int = 20) -> None:
    """Raise with line and file when any header is invalid."""
    bad = headers.where(~F.col("valid")).select(path_col, line_col).limit(max_report).collect()
    if bad:
        msgs = [f"no usable header in {r[path_col]}: {r[line_col]}" for r in bad]
        raise ValueError("\n".join(msgs))
