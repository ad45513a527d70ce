"""Record text -> fields.

Standard mode parses each record with Spark's own CSV parser (``from_csv``:
RFC 4180 quoting, quote doubled to escape, newlines inside quotes kept), in
PERMISSIVE mode with a corrupt-record column that flags short and long rows.
(Regex mode splits text with ``functions.text.java_split``.)
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.headers import split_header
from ..options import IngestOptions


def field_names(n: int) -> list[str]:
    return [f"_c{i}" for i in range(n)]


def csv_fields(record: Column, n: int, options: IngestOptions) -> Column:
    """Struct of ``n`` string fields plus ``_corrupt_record`` (non-null when the
    record does not have exactly ``n`` fields or is malformed)."""
    schema = ", ".join(f"`{c}` string" for c in field_names(n)) + ", `_corrupt_record` string"
    return F.from_csv(record, schema, options.csv_parser_options())


def closed_fields(record: Column, n: int, options: IngestOptions) -> Column:
    """``csv_fields`` of a record closed by one more delimiter, NULL for most records.

    At the end of its input the parser adds a quote to a last field that has blanks and text
    behind a closing quote (``"a" b"``); before a delimiter or a line end it does not."""
    q = re.escape(options.quote)
    odd = record.contains(options.quote) & record.rlike(q + r"[\x00-\x20]+[^\x00-\x20]")
    return csv_fields(F.when(odd, F.concat(record, F.lit(options.sep))), n + 1, options)


def count_csv_fields(record: Column, options: IngestOptions) -> Column:
    """Number of fields of a CSV record (delimiters outside quotes + 1)."""
    return F.size(split_header(record, options.sep, options.quote))


def parse_csv_records(df: DataFrame, record_col: str, n: int, options: IngestOptions,
                      names: Sequence[str] | None = None, keep: Sequence[str] = (),
                      count_fields: bool = False) -> DataFrame:
    """``record`` text -> ``n`` string columns (``names``) + ``corrupt`` flag
    (+ ``n_fields`` when asked; counted exactly only for corrupt rows)."""
    names = list(names or field_names(n))
    keep = [c for c in (keep or [c for c in df.columns if c != record_col])]
    record = F.col(record_col)
    parsed = df.select(*keep, record, csv_fields(record, n, options).alias("_p"),
                       closed_fields(record, n, options).alias("_q"))
    # plain SQL texts: a table may have thousands of columns
    cols = [f"CASE WHEN _closed THEN _q.{c} ELSE _p.{c} END AS `{nm}`" for c, nm in zip(field_names(n), names)]
    parsed = parsed.withColumn("_closed", F.col("_q").isNotNull() & F.col("_q._corrupt_record").isNull())
    out = [*[f"`{c}`" for c in keep], *cols, "_p._corrupt_record IS NOT NULL AS corrupt"]
    if count_fields:
        n_fields = F.when(F.col("_p._corrupt_record").isNotNull(), count_csv_fields(record, options)).otherwise(F.lit(n))
        parsed, out = parsed.withColumn("_n_fields", n_fields), [*out, "_n_fields AS n_fields"]
    return parsed.selectExpr(*out)
