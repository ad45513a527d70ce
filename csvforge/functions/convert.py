"""Typed conversion of text fields (the cast step), as native Column expressions.

Each converter returns NULL for empty text and for text its type does not
accept, e.g. a DATE value in a DATETIME column (a *lossy* cast, counted by
``operators.fill.lossy_counts``).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import types as ft
from .infer import (TRUE_WORDS, DATE_PART, DATE_RE, DOUBLE_RE, INT_RE, OFFSET_LENIENT, TIME_PART, anchored,
                    col_of, date_text, is_boolean_word, is_datetime_text, is_empty, is_true,
                    zone_of)

_TIME_GROUPS = (r"\A((?:[01]\d|2[0-3]):[0-5]\d)(?::([0-5]\d)(?:\.(\d{0,9}))?)?"
                + OFFSET_LENIENT + r"?\z")
# of texts whose shape is known: the time behind the date, and the offset behind the time
_DT_LOCAL = r"[Tt]([0-9:.]+)"
_DT_OFFSET = r"[Tt][0-9:.]+([Zz]|[+-][0-9:]+)?"


def to_int(v: Column) -> Column:
    v = col_of(v)
    return F.when(v.rlike(anchored(INT_RE)), v.try_cast("int"))


def to_long(v: Column) -> Column:
    v = col_of(v)
    return F.when(v.rlike(anchored(INT_RE)), v.try_cast("bigint"))


def to_double(v: Column) -> Column:
    v = col_of(v)
    return F.when(v.rlike(anchored(DOUBLE_RE)), v.try_cast("double"))


def to_boolean(v: Column) -> Column:
    v = col_of(v)
    return F.when(is_boolean_word(v), is_true(v))


def to_date(v: Column) -> Column:
    """ISO date, an optional offset is accepted and dropped.  NULL beyond the years a DATE holds
    (5,881,580)."""
    v = col_of(v)
    return F.when(v.rlike(anchored(DATE_RE)), date_text(v).try_cast("date"))


def to_time(v: Column) -> Column:
    """ISO local time text: seconds always present, fraction without trailing zeros."""
    v = col_of(v)
    hm = F.regexp_extract(v, _TIME_GROUPS, 1)
    sec = F.regexp_extract(v, _TIME_GROUPS, 2)
    frac = F.regexp_replace(F.regexp_extract(v, _TIME_GROUPS, 3), "0+$", "")
    text = F.concat(hm, F.lit(":"), F.when(sec == "", F.lit("00")).otherwise(sec),
                    F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    return F.when(v.rlike(_TIME_GROUPS), text)


def to_datetime(v: Column) -> Column:
    """Zone-less date-time.  A plain offset is dropped without shifting; with a
    bracketed zone the instant (local minus offset) is shown in that zone.  NULL beyond
    the years a timestamp holds (about 290,000)."""
    v = col_of(v)
    local = F.concat(date_text(v), F.lit(" "), F.regexp_extract(v, _DT_LOCAL, 1)).try_cast("timestamp_ntz")
    offset = F.upper(F.regexp_extract(v, _DT_OFFSET, 1))
    zone = zone_of(v)
    shifted = F.convert_timezone(F.when(offset == "Z", F.lit("UTC")).otherwise(offset), zone, local)
    return F.when(is_datetime_text(v), F.when(zone.isNull(), local).otherwise(shifted))


def midnight(v: Column) -> Column:
    """A DATE value as the first moment of its day (offset dropped), else NULL."""
    return to_date(v).cast("timestamp_ntz")


def cast_field(v: Column, code: int, widen_int: bool = False, promote: bool = False) -> Column:
    """Text -> typed value for a column of field type ``code``; with ``promote`` a DATE value
    in a DATETIME column becomes its midnight."""
    v = col_of(v)
    converter = {
        ft.INT: to_long if widen_int else to_int,
        ft.LONG: to_long,
        ft.DOUBLE: to_double,
        ft.BOOLEAN: to_boolean,
        ft.DATE: to_date,
        ft.TIME: to_time,
        ft.DATETIME: (lambda v: F.coalesce(to_datetime(v), midnight(v))) if promote else to_datetime,
    }.get(code)
    if converter is None:  # STRING and UNKNOWN keep the text; empty is absent
        return F.when(~is_empty(v), v)
    return F.when(~is_empty(v), converter(v)).cast(ft.spark_type(code, widen_int))


def cast_trusted(v: Column, code: int, widen_int: bool = False, promote: bool = False) -> Column:
    """Cast for a column whose merged type came from inference over these same
    values: every non-empty value already has the column's shape (or, in a
    DATETIME column, is a DATE/TIME value that casts to NULL), so the regex
    guards of :func:`cast_field` are replaced by plain casts.  The result equals
    ``cast_field`` on such columns."""
    v = col_of(v)
    nonempty = ~is_empty(v)
    if code == ft.INT:
        out = v.try_cast("bigint" if widen_int else "int")
    elif code == ft.LONG:
        out = v.try_cast("bigint")
    elif code == ft.DOUBLE:
        out = v.try_cast("double")
    elif code == ft.BOOLEAN:
        out = F.lower(v).isin(*TRUE_WORDS)
    elif code == ft.DATE:
        out = date_text(v).try_cast("date")
    elif code == ft.TIME:
        out = to_time(v)
    elif code == ft.DATETIME:
        local = F.concat(date_text(v), F.lit(" "),
                         F.regexp_extract(v, _DT_LOCAL, 1)).try_cast("timestamp_ntz")
        has_t = (F.locate("T", v) > 0) | (F.locate("t", v) > 0)
        # as a lambda the rare zoned case stays out of the code generated for every row,
        # which would be too long for the JVM to compile
        zoned = F.element_at(F.transform(F.array(v), to_datetime), 1)
        out = F.when(has_t, F.when(F.locate("[", v) > 0, zoned).otherwise(local))
        if promote:
            out = F.when(has_t, out).otherwise(midnight(v))
    else:
        return F.when(nonempty, v)
    return F.when(nonempty, out).cast(ft.spark_type(code, widen_int))


def trusted_sql(name: str, code: int, widen_int: bool = False) -> str | None:
    """:func:`cast_trusted` of a column as SQL text, for the types whose cast is one (a plan of
    thousands of columns is made much faster from texts); None for the others."""
    v = "`" + name.replace("`", "``") + "`"
    plain = {ft.INT: "bigint" if widen_int else "int", ft.LONG: "bigint", ft.DOUBLE: "double"}.get(code)
    if plain:
        return f"CASE WHEN {v} <> '' THEN try_cast({v} AS {plain}) END"
    if code == ft.BOOLEAN:
        words = ", ".join(f"'{w}'" for w in TRUE_WORDS)
        return f"CASE WHEN {v} <> '' THEN lower({v}) IN ({words}) END"
    if code in (ft.STRING, ft.UNKNOWN):
        return f"CASE WHEN {v} <> '' THEN {v} END"
    return None
