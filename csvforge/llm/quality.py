"""Operator 9: quality rules as a bitmask ledger (native functions only).

Every rule is evaluated once per text.  The ledger keeps the measurements and one
long with a bit per failed rule.  Policies are versioned sets of bits, applied
afterwards by a bitwise AND; ablations (what a policy would keep without one of its
rules) are one aggregate over the ledger and need no text.

All work is narrow: one scan, no shuffle.  Repeated windows are found inside a text
by sorting its window hashes (64-bit), so long texts cost n log n.

Null or wordless text has all measurements 0 and fails ``few_words``.  Repeated rows
are rows of their own; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, let, space_words, table

WINDOW = 8
RULES = {                     # name -> SQL condition of failure, over the measurements; bit = position
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 4 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "capitals": "n_upper > n_lower AND n_upper > n_words",
    "exclamations": "2 * n_exclaims > n_words",
}
POLICIES = {                  # version -> rules it enforces
    "1-base": ("few_words", "repeated_windows"),
    "2-full": tuple(RULES),
}
POLICY = "2-full"
BASE = POLICIES["1-base"]


def mask(names) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def repeat_words(w: Column, size: int = WINDOW) -> Column:
    """Words of ``w`` that stand in a window of ``size`` words found twice or more."""
    def covered(s):
        twin = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(-size).alias("last"))
        return F.aggregate(F.sort_array(F.transform(twin, lambda x: x["p"])), start,
                           lambda a, p: F.struct((a["c"] + F.least(F.lit(size), p - a["last"])).alias("c"), p.alias("last")),
                           lambda a: a["c"])

    def count(h):
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), covered))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
    return F.when(F.size(w) > size, let(hashes, count)).otherwise(F.lit(0).cast("long"))


def measure(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("doc_id"), t.alias("t")).withColumn("w", space_words("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    count = lambda rx: F.regexp_count("t", F.lit(rx)).cast("long")
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        (F.length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        let(lines, lambda a: F.struct(F.size(a).cast("long").alias("n"),
                                      (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("d"))).alias("l"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        count("[A-Z]").alias("n_upper"), count("[a-z]").alias("n_lower"), count("!").alias("n_exclaims"),
    ).select("doc_id", "n_words", "word_chars", "n_symbols", F.col("l.d").alias("n_dup_lines"), "n_repeat_words",
             F.col("l.n").alias("n_lines"), "n_upper", "n_lower", "n_exclaims")


def ledger(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measurements and ``fail_bits`` of every row."""
    bits = " | ".join(f"CASE WHEN {cond} THEN {1 << i}L ELSE 0L END" for i, cond in enumerate(RULES.values()))
    return measure(df, text, key).withColumn("fail_bits", F.expr(bits))


def verdict(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """``base_failed`` and ``kept`` of a ledger's rows under a policy."""
    failed = lambda names: F.col("fail_bits").bitwiseAND(F.lit(mask(names))) != 0
    return (rows.withColumn("base_failed", failed(BASE))
            .withColumn("kept", ~failed(BASE) & ~failed(POLICIES[policy])))


def ablation(rows: DataFrame, policies=POLICIES) -> DataFrame:
    """Per policy and rule of it: rows that fail the rule, rows that fail nothing else of
    the policy (kept if the rule were dropped), and rows kept.  One aggregate."""
    bits = F.col("fail_bits")
    cases = [(p, r) for p, names in policies.items() for r in names]
    parts = []
    for p, r in cases:
        own = bits.bitwiseAND(F.lit(mask(policies[p])))
        parts.append(F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                              F.count_if(bits.bitwiseAND(F.lit(mask([r]))) != 0).alias("n_failed"),
                              F.count_if(own == mask([r])).alias("n_only"), F.count_if(own == 0).alias("n_kept")))
    return rows.agg(F.array(*parts).alias("a")).select(F.inline("a"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict(ledger(table(spark, sf_dir, "documents")))


def _sql() -> str:
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(RULES.values()))
    rx = r"[^\x20\x09-\x0D]+"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '{rx}') AS w FROM documents),
p AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
q AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM p),
r AS (SELECT rid, count(DISTINCT k) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS k FROM q WHERE c > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(length(regexp_replace(t, '[^a-z]', '', 'g')) AS BIGINT) AS n_lower,
  CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{rx}')) AS l FROM d) LEFT JOIN r USING (rid)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
SELECT *, fail_bits & {mask(BASE)} <> 0 AS base_failed, fail_bits & {mask(BASE) | mask(POLICIES[POLICY])} = 0 AS kept FROM b"""


QUERIES = {"op9_quality_rules": op9_quality_rules}
SQL = {"op9_quality_rules": _sql()}
