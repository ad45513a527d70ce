"""csvforge: raw delimited-file ingestion on Spark.

Reads CSV and CSV-like files (plain, gzip, zip, tar, lz4), splits big files at
record boundaries in parallel, parses, infers one schema per table from every
row, casts with strict rules and writes one table per file.
"""
from .options import IngestOptions
from .plans.ingest import TableResult, ingest, read_tables

__all__ = ["IngestOptions", "TableResult", "ingest", "read_tables"]
__version__ = "0.1.0"
