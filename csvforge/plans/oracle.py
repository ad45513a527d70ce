"""DuckDB SQL text for the independent oracle of the registered queries.

These mirror the Spark expressions of ``csvforge.functions`` in plain SQL
(RE2 regexes, ``regexp_full_match``, ``TRY_CAST``), so the driver can run them
on the same parquet tables.
"""
from __future__ import annotations

from ..functions import infer as I
from ..functions import types as ft

BOOL_LIST = ", ".join(f"'{w}'" for w in I.BOOLEAN_WORDS)
TRUE_LIST = ", ".join(f"'{w}'" for w in I.TRUE_WORDS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def infer_code_sql(v: str) -> str:
    """Type code of text ``v`` (no bracketed zones in oracle inputs)."""
    dt = I.DATE_PART + "[Tt]" + I.TIME_PART + "(?:" + I.OFFSET_STRICT + ")?"
    return f"""(CASE
      WHEN {v} IS NULL OR {v} = '' THEN {ft.UNKNOWN}
      WHEN length({v}) <= 5 AND lower({v}) IN ({BOOL_LIST}) THEN {ft.BOOLEAN}
      WHEN regexp_full_match({v}, {q(I.INT_RE)}) AND TRY_CAST({v} AS INTEGER) IS NOT NULL THEN {ft.INT}
      WHEN regexp_full_match({v}, {q(I.INT_RE)}) AND TRY_CAST({v} AS BIGINT) IS NOT NULL THEN {ft.LONG}
      WHEN regexp_full_match({v}, {q(I.DOUBLE_RE)}) THEN {ft.DOUBLE}
      WHEN regexp_full_match({v}, {q(I.DATE_RE)}) AND TRY_CAST(substr({v}, 1, 10) AS DATE) IS NOT NULL THEN {ft.DATE}
      WHEN regexp_full_match({v}, {q(I.TIME_RE)}) THEN {ft.TIME}
      WHEN regexp_full_match({v}, {q(dt)}) AND TRY_CAST(substr({v}, 1, 10) AS DATE) IS NOT NULL THEN {ft.DATETIME}
      ELSE {ft.STRING} END)"""


def type_name_sql(code: str) -> str:
    names = ", ".join(f"'{n}'" for n in ft.TYPE_NAMES)
    return f"([{names}][({code}) + 1])"


def infer_name_sql(v: str) -> str:
    return type_name_sql(infer_code_sql(v))


def bit_sql(v: str) -> str:
    c = infer_code_sql(v)
    return f"(CASE WHEN {c} = {ft.UNKNOWN} THEN 0 ELSE (1 << {c}) END)"


def resolve_sql(m: str) -> str:
    """Mask -> type name."""
    B = ft.BIT
    single = " ".join(f"WHEN {m} = {B[c]} THEN '{ft.TYPE_NAMES[c]}'" for c in range(ft.STRING + 1))
    integral = B[ft.INT] | B[ft.LONG]
    numeric = integral | B[ft.DOUBLE]
    d_dt = B[ft.DATE] | B[ft.DATETIME]
    t_dt = B[ft.TIME] | B[ft.DATETIME]
    return f"""(CASE WHEN {m} IS NULL OR {m} = 0 THEN 'UNKNOWN' {single}
      WHEN ({m} & {255 & ~integral}) = 0 THEN 'LONG'
      WHEN ({m} & {255 & ~numeric}) = 0 THEN 'DOUBLE'
      WHEN ({m} & {B[ft.DATETIME]}) <> 0 AND (({m} & {255 & ~d_dt}) = 0 OR ({m} & {255 & ~t_dt}) = 0) THEN 'DATETIME'
      ELSE 'STRING' END)"""


_TIME_G = (r"^((?:[01]\d|2[0-3]):[0-5]\d)(?::([0-5]\d)(?:\.(\d{0,9}))?)?" + I.OFFSET_LENIENT + "?$")


def to_time_sql(v: str) -> str:
    hm = f"regexp_extract({v}, {q(_TIME_G)}, 1)"
    sec = f"regexp_extract({v}, {q(_TIME_G)}, 2)"
    frac = f"regexp_replace(regexp_extract({v}, {q(_TIME_G)}, 3), '0+$', '')"
    return (f"(CASE WHEN regexp_matches({v}, {q(_TIME_G)}) THEN {hm} || ':' || "
            f"(CASE WHEN {sec} = '' THEN '00' ELSE {sec} END) || "
            f"(CASE WHEN {frac} = '' THEN '' ELSE '.' || {frac} END) END)")


_DT_L = r"^(\d{4}-\d{2}-\d{2})[Tt](" + I.TIME_PART + ")"


def to_datetime_sql(v: str) -> str:
    """Offset dropped without shift (oracle inputs have no bracketed zone)."""
    return (f"TRY_CAST(regexp_extract({v}, {q(_DT_L)}, 1) || ' ' || "
            f"regexp_extract({v}, {q(_DT_L)}, 2) AS TIMESTAMP)")


def java_split_sql(s: str, regex: str) -> str:
    parts = f"regexp_split_to_array({s}, {q(regex)})"
    trailing = (f"coalesce(list_position(list_transform(list_reverse({parts}), lambda x: x <> ''), true) - 1, "
                f"len({parts}))")
    return (f"(CASE WHEN {s} = '' THEN [''] ELSE "
            f"list_slice({parts}, 1, len({parts}) - {trailing}) END)")


def normalize_header_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^\"|\"$', '', 'g'), '\\W', '_', 'g')"
