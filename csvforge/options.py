"""Ingestion options (the importer's CSV settings, passed by value to tasks)."""
from __future__ import annotations

from dataclasses import dataclass

# Importer defaults.
DEFAULT_CHUNK_SIZE = 2 * 1024 * 1024   # target chunk size for splitting large files
MAX_COLUMNS = 8192                      # maximum number of columns per record


def check_regexes(spark, *patterns: str | None) -> None:
    """Reject malformed patterns by the engine that runs them: a constant Spark expression
    (Java regex), evaluated while the plan is made."""
    for rx in patterns:
        if rx is not None:
            try:
                spark.sql("SELECT rlike('', :rx)", args={"rx": rx}).collect()
            except Exception as e:
                raise ValueError(f"invalid regex {rx!r}: {str(e).splitlines()[0]}") from e


@dataclass(frozen=True)
class IngestOptions:
    sep: str = ","                  # one-character field delimiter
    quote: str = '"'                # one-character quote; doubled to escape
    line_sep: str | None = None     # record separator: None (LF, CR and CRLF), "\n", "\r\n" or one character
    field_regex: str | None = None  # regex mode: field separator (Java regex)
    record_regex: str | None = None # regex mode: record separator (Java regex)
    trim: bool = True               # ignore surrounding spaces of unquoted fields
    comment: str | None = None      # lines starting with it are skipped (off by default)
    encoding: str = "utf-8"
    chunk_size: int = DEFAULT_CHUNK_SIZE   # bytes of a chunk (a task may read several)
    split_mode: str = "exact"       # "exact" (field automaton) or "heuristic" (importer rule)
    max_columns: int = MAX_COLUMNS
    widen_int: bool = False         # INT columns as 64-bit, like the warehouse
    promote: bool = False           # DATE values in a DATETIME column become midnights (else NULL)
    bad_rows: str = "error"         # "error" or "quarantine" for records of wrong width
    bad_headers: str = "error"      # "error" or "skip" (files without a valid header)
    case_sensitive_headers: bool = False  # Spark resolves names case-insensitively
    infer_engine: str = "vector"    # "vector" (Arrow, in tasks) or "sql" (Column expressions)

    def __post_init__(self):
        if len(self.sep) != 1:
            raise ValueError("sep must be one character; use field_regex for longer ones")
        if not self.quote or len(self.quote) != 1:
            raise ValueError("quote must be exactly one character")
        if not self.regex_mode and max(ord(self.sep), ord(self.quote)) > 0x7F:
            raise ValueError("sep and quote must be ASCII characters; use field_regex for others")
        if self.line_sep is not None:
            if not self.line_sep:
                raise ValueError("line_sep must not be empty")
            if self.line_sep not in ("\n", "\r\n") and len(self.line_sep.encode(self.encoding)) != 1:
                raise ValueError("line_sep must be LF, CRLF or one single-byte character")
        if (self.field_regex is None) != (self.record_regex is None):
            raise ValueError("field_regex and record_regex must be given together")
        if self.regex_mode:                # without a session they are checked when they are first used
            from pyspark.sql import SparkSession
            spark = SparkSession.getActiveSession()
            if spark is not None:
                check_regexes(spark, self.field_regex, self.record_regex)
        if self.split_mode not in ("exact", "heuristic"):
            raise ValueError("split_mode must be 'exact' or 'heuristic'")
        if self.infer_engine not in ("vector", "sql"):
            raise ValueError("infer_engine must be 'vector' or 'sql'")
        if self.bad_headers not in ("error", "skip"):
            raise ValueError("bad_headers must be 'error' or 'skip'")
        if self.bad_rows not in ("error", "quarantine"):
            raise ValueError("bad_rows must be 'error' or 'quarantine'")
        if self.chunk_size is None:
            object.__setattr__(self, "chunk_size", DEFAULT_CHUNK_SIZE)
        if self.chunk_size < 1:
            raise ValueError("chunk_size must be positive")

    @property
    def regex_mode(self) -> bool:
        return self.record_regex is not None

    @property
    def dialect(self):
        """What byte scans need: the record byte is LF for both LF and CRLF, None for any line end."""
        from .sources.bytescan import Dialect
        rec = None if self.line_sep is None else ord(self.line_sep[-1:].encode(self.encoding))
        return Dialect(ord(self.quote), ord(self.sep), rec, self.trim)

    def csv_parser_options(self) -> dict[str, str]:
        """Options of Spark's CSV parser for one record."""
        opts = {
            "sep": self.sep, "quote": self.quote, "escape": self.quote,
            "ignoreLeadingWhiteSpace": str(self.trim).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim).lower(),
            "maxColumns": str(self.max_columns), "maxCharsPerColumn": "-1",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
        }
        return opts
