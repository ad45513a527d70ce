"""Per-value type inference as one native Column expression.

The rules are tried in a fixed order; the first that accepts the text wins:
empty -> UNKNOWN, boolean word -> BOOLEAN, 32-bit integer -> INT, 64-bit
integer -> LONG, Java double literal -> DOUBLE, ISO date -> DATE, ISO time ->
TIME, ISO date-time -> DATETIME, anything else -> STRING.

Spark's own casts are more lenient than the JDK parsers whose semantics we
follow (``try_cast`` trims blanks, accepts ``2018-1-8``, ``nan``, space
separated timestamps ...), so every cast is guarded by an anchored regex.
``\\A``/``\\z`` are used because ``$`` also matches before a final newline.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import types as ft

# ---------------------------------------------------------------------------
# Fixed values (must equal the importer's semantics).
# Boolean words, compared case-insensitively:
BOOLEAN_WORDS = ["true", "false", "yes", "no", "y", "n", "t", "f"]
# Words that cast to true (every other boolean word casts to false):
TRUE_WORDS = ["true", "yes", "y", "t"]
# Regex building blocks for the JDK grammar of numbers and ISO-8601 text.
# Offsets after a date or a time: hours 00-23, any minutes/seconds 00-59.
OFFSET_LENIENT = r"(?:[Zz]|[+-](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d)?)"
# Offsets of a date-time must be a valid zone offset, at most 18:00.
OFFSET_STRICT = r"(?:[Zz]|[+-](?:(?:0\d|1[0-7]):[0-5]\d(?::[0-5]\d)?|18:00(?::00)?))"
# A year has four digits; more (up to 999999999) need a sign; the year zero has no minus.
YEAR = r"(?:\d{4}|[+](?:0\d{9}|\d{5,9})|-(?:0\d{9}|\d{4,9}))"
DATE_PART = YEAR + r"-\d{2}-\d{2}"
TIME_PART = r"(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{0,9})?)?"
ZONE_ID = r"\[[A-Za-z0-9][A-Za-z0-9~/._+-]*\]"
# Region ids are case-sensitive: every segment starts upper-case; or an offset.
ZONE_CASE_RE = r"\A(?:[A-Z][A-Za-z0-9_+:-]*(?:/[A-Z][A-Za-z0-9_+-]*)*|[+-][0-9:]+)\z"
DEC_NUM = r"(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
HEX_NUM = r"0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?\d+"
# ---------------------------------------------------------------------------

INT_RE = r"[+-]?\d+"
DOUBLE_RE = (r"[\x00-\x20]*[+-]?(?:NaN|Infinity|(?:" + DEC_NUM + "|" + HEX_NUM
             + r")[fFdD]?)[\x00-\x20]*")
DATE_RE = DATE_PART + OFFSET_LENIENT + "?"
TIME_RE = TIME_PART + OFFSET_LENIENT + "?"
DATETIME_RE = DATE_PART + "[Tt]" + TIME_PART + "(?:" + OFFSET_STRICT + "(?:" + ZONE_ID + ")?)?"


def col_of(v) -> Column:
    """Accept a column name or a Column."""
    return F.col(v) if isinstance(v, str) else v


def anchored(regex: str) -> str:
    """Whole-string Java regex."""
    return r"\A(?:" + regex + r")\z"


def _match(col: Column, regex: str) -> Column:
    return col.rlike(anchored(regex))


def is_empty(v: Column) -> Column:
    v = col_of(v)
    return v.isNull() | (v == F.lit(""))


def is_boolean_word(v: Column) -> Column:
    v = col_of(v)
    return (F.length(v) <= 5) & F.lower(v).isin(*BOOLEAN_WORDS)


def is_true(v: Column) -> Column:
    """Boolean value of a field of a BOOLEAN column: true for true/yes/y/t."""
    v = col_of(v)
    return F.when(is_empty(v), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(F.lower(v).isin(*TRUE_WORDS), F.lit(False)))


def is_signed(v: Column) -> Column:
    """Starts with a sign: the year of such a date may be long or before the year zero."""
    return F.ascii(v).isin(43, 45)


def date_text(v: Column) -> Column:
    """The date at the start of a date or date-time text (shape already checked), without
    superfluous zeros of a signed year."""
    signed = F.regexp_replace(F.regexp_extract(v, r"\A([+-]\d{4,10}-\d{2}-\d{2})", 1), r"\A([+-])0+(\d{4,}-)", "$1$2")
    return F.when(is_signed(v), signed).otherwise(F.substring(v, 1, 10))


def _valid_calendar_date(v: Column) -> Column:
    """Real month and day.  The calendar repeats every 400 years, so a signed year is judged
    by its last four digits: no year is too long for it."""
    year = F.regexp_extract(v, r"\A[+-](\d+)-", 1)
    proxy = F.concat((F.lit(2000) + F.right(year, F.lit(4)).try_cast("int") % 400).cast("string"),
                     F.regexp_extract(v, r"\A[+-]\d+(-\d{2}-\d{2})", 1))
    return F.when(is_signed(v), proxy.try_cast("date").isNotNull() & ~v.rlike(r"\A-0+-")).otherwise(
        F.substring(v, 1, 10).try_cast("date").isNotNull())


def _try_cast(v: Column, to: str) -> Column:
    return v.try_cast(to)


def zone_of(v: Column) -> Column:
    """Bracketed zone id of a date-time text (shape already checked), or NULL."""
    v = col_of(v)
    at = F.instr(v, "[")
    return F.when(at > 0, F.substring(v, at + 1, F.length(v) - at - 1))


def words_regex(words: Iterable[str]) -> str:
    """Regex of exactly these words, common beginnings written once (so that few
    alternatives are tried per character)."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        by_first.setdefault(w[:1], []).append(w[1:])
    end = by_first.pop("", None)
    parts = [re.escape(c) + words_regex(rest) for c, rest in by_first.items()]
    if not parts:
        return ""
    return parts[0] if len(parts) == 1 and not end else "(?:" + "|".join(parts) + (")?" if end else ")")


@functools.lru_cache(maxsize=1)
def region_regex() -> str:
    """Anchored regex of the region ids that the JDK knows and the ISO zoned parser accepts."""
    names = SparkSession.active()._jvm.java.time.ZoneId.getAvailableZoneIds()
    case = re.compile(ZONE_CASE_RE.replace(r"\z", r"\Z"))
    return anchored(words_regex(z for z in names if case.match(z)))


def is_valid_zone(zone: Column) -> Column:
    """Zone id the JDK's ISO zoned parser accepts: a known region (case-sensitive) or an
    offset, alone or behind UTC, GMT or UT (checked by Spark's datetime parser with the
    ``VV`` zone-id pattern, which is slow for zones that do not exist)."""
    parsed = F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), zone), F.lit("yyyy-MM-dd VV"))
    offset = zone.rlike(r"\A(?:[+-]|UT|GMT|Z)") & zone.rlike(ZONE_CASE_RE) & parsed.isNotNull()
    return zone.rlike(region_regex()) | offset


def is_datetime_text(v: Column) -> Column:
    v = col_of(v)
    base = _match(v, DATETIME_RE) & _valid_calendar_date(v)
    zone = zone_of(v)
    return base & (zone.isNull() | is_valid_zone(zone))


def _classify(v: Column, out) -> Column:
    """The rule chain; ``out(code)`` gives the result literal of a type.

    The groups {boolean word}, {INT, LONG, DOUBLE}, {DATE}, {TIME}, {DATETIME}
    can never accept the same text, so a flat CASE may test them in any order
    (INT before LONG before DOUBLE is kept), each regex once, and the first
    character rules out most groups before any regex runs."""
    lit = lambda code: F.lit(out(code))
    c0 = F.ascii(v)                       # code point of the first character; 0 for ""
    digit = (c0 >= 48) & (c0 <= 57)
    sign = c0.isin(43, 45)                # '+' '-'
    integral = (F.when(_try_cast(v, "int").isNotNull(), lit(ft.INT))
                .when(_try_cast(v, "bigint").isNotNull(), lit(ft.LONG))
                .otherwise(lit(ft.DOUBLE)))   # too long for 64 bits: still a double literal
    # a dash behind the year: the fifth character, or later behind a sign
    dated = (digit & (F.substring(v, 5, 1) == F.lit("-"))) | (sign & (F.locate("-", v, 6) > 0))
    double_initial = digit | sign | c0.isin(46, 73, 78) | (c0 <= 32)   # '.', 'I', 'N', blanks
    word_initial = c0.isin(*[ord(ch) for ch in "tTfFyYnN"])
    return (F.when(v.isNull() | (c0 == 0), lit(ft.UNKNOWN))
            .when((digit | sign) & _match(v, INT_RE), integral)
            .when(dated & _match(v, DATE_RE) & _valid_calendar_date(v), lit(ft.DATE))
            .when(dated & is_datetime_text(v), lit(ft.DATETIME))
            .when(digit & (F.substring(v, 3, 1) == F.lit(":")) & _match(v, TIME_RE), lit(ft.TIME))
            .when(word_initial & is_boolean_word(v), lit(ft.BOOLEAN))
            .when(double_initial & _match(v, DOUBLE_RE), lit(ft.DOUBLE))
            .otherwise(lit(ft.STRING)))


def _classify_ordered(v: Column, out) -> Column:
    """The rule chain in its plain declared order (reference for tests)."""
    lit = lambda code: F.lit(out(code))
    return (F.when(is_empty(v), lit(ft.UNKNOWN))
            .when(is_boolean_word(v), lit(ft.BOOLEAN))
            .when(_match(v, INT_RE) & _try_cast(v, "int").isNotNull(), lit(ft.INT))
            .when(_match(v, INT_RE) & _try_cast(v, "bigint").isNotNull(), lit(ft.LONG))
            .when(_match(v, DOUBLE_RE), lit(ft.DOUBLE))
            .when(_match(v, DATE_RE) & _valid_calendar_date(v), lit(ft.DATE))
            .when(_match(v, TIME_RE), lit(ft.TIME))
            .when(is_datetime_text(v), lit(ft.DATETIME))
            .otherwise(lit(ft.STRING)))


def infer_code(v: Column) -> Column:
    """Field type code of one text value (see module doc for the order)."""
    v = col_of(v)
    return _classify(v, lambda code: code)


def type_bit(v: Column) -> Column:
    """Bit of the value's type (0 for UNKNOWN), the input of ``bit_or`` merging."""
    v = col_of(v)
    return _classify(v, lambda code: ft.BIT[code])


def infer_type_name(v: Column) -> Column:
    v = col_of(v)
    return ft.type_name(infer_code(v))
