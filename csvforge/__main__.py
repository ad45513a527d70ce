"""Command line: ``python -m csvforge --input PATH [--output DIR | --database DB] ...``

Maps the importer's CSV flags onto :class:`csvforge.IngestOptions` and runs
:func:`csvforge.plans.ingest.ingest` (one table per file, created if needed,
truncated on write)."""
from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="csvforge", description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True, nargs="+", help="files, folders or globs")
    target = p.add_mutually_exclusive_group(required=True)
    target.add_argument("--output", help="folder receiving one table folder per file")
    target.add_argument("--database", help="catalog database receiving the tables")
    p.add_argument("--table_name", help="put all files into this one table")
    p.add_argument("--csv_delimiter", default=",")
    p.add_argument("--csv_quote", default='"')
    p.add_argument("--csv_record_separator", help="default: LF, CR and CRLF all end a record")
    p.add_argument("--csv_delimiter_regex")
    p.add_argument("--csv_record_separator_regex")
    p.add_argument("--split_mode", choices=["exact", "heuristic"], default="exact")
    p.add_argument("--bad_rows", choices=["error", "quarantine"], default="error")
    p.add_argument("--bad_headers", choices=["error", "skip"], default="error")
    p.add_argument("--format", default="parquet", help="table storage format")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    from pyspark.sql import SparkSession

    from csvforge.options import IngestOptions
    from csvforge.plans.ingest import ingest
    a = parser().parse_args(argv)
    options = IngestOptions(sep=a.csv_delimiter, quote=a.csv_quote,
                            line_sep=a.csv_record_separator
                            and a.csv_record_separator.encode().decode("unicode_escape"),
                            field_regex=a.csv_delimiter_regex,
                            record_regex=a.csv_record_separator_regex,
                            split_mode=a.split_mode, bad_rows=a.bad_rows,
                            bad_headers=a.bad_headers)
    spark = spark or SparkSession.builder.appName("csvforge").getOrCreate()
    results = ingest(spark, a.input, options, output=a.output, database=a.database,
                     table_name=a.table_name, fmt=a.format)
    for name, res in results.items():
        print(f"{name}: {res.target} ({', '.join(f'{c} {t}' for c, t in zip(res.columns, res.types))})"
              + (f"; {res.n_bad} bad records in {res.bad_target}" if res.n_bad else ""))
    for path, line in getattr(results, "skipped_files", []):
        print(f"skipped {path}: invalid header {line!r}")
    return results


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
