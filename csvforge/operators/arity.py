"""Record width checks: strict (raise) or quarantine (split good / bad rows)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_width(df: DataFrame, fields: str, expected) -> DataFrame:
    """Adds ``n_fields`` and ``width_ok`` (``expected`` is an int or a column name)."""
    exp = F.lit(expected) if isinstance(expected, int) else F.col(expected)
    return (df.withColumn("n_fields", F.size(F.col(fields)))
            .withColumn("width_ok", F.col("n_fields") == exp))


def quarantine(df: DataFrame, fields: str, expected) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows by width; both lazy, computed from one plan."""
    w = with_width(df, fields, expected)
    return w.where("width_ok").drop("width_ok"), w.where("not width_ok").drop("width_ok")


def require_width(df: DataFrame, fields: str, expected, max_report: int = 5) -> None:
    """Strict mode: raise if any record has the wrong number of fields."""
    _, bad = quarantine(df, fields, expected)
    rows = bad.limit(max_report).collect()
    if rows:
        raise ValueError("Records with the wrong number of fields: "
                         + "; ".join(f"{r['n_fields']} fields: {r[fields]}" for r in rows))
