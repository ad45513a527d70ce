"""Keyed side-input lookup (file key -> header / schema) as an equi-join.

The lookup side holds one row per file or table.  Spark picks the join by the sizes
it measures at run time (broadcast below its byte threshold, shuffle beyond)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(records: DataFrame, lookup: DataFrame, on, how: str = "inner",
                unique_key: bool = True) -> DataFrame:
    """Join a per-key map onto records.  With ``unique_key`` a key that stands in the
    map more than once fails the job when it runs (no extra job, nothing collected)."""
    keys = [on] if isinstance(on, str) else list(on)
    if unique_key:
        others = [c for c in lookup.columns if c not in keys]
        many = F.raise_error(F.concat(F.lit("lookup keys are not unique: "),
                                      F.to_json(F.struct(*keys)))).cast("boolean")
        lookup = (lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                            *[F.first(c).alias(c) for c in others])
                  .where(F.when(F.col("__n") > 1, many).otherwise(True)).drop("__n"))
    return records.join(lookup, keys, how)
