"""Operators for training-data pipelines (licence scans, mixing, fingerprints,
language identification, packing, rendering, token counts, near duplicates,
quality rules).  Nothing else in the library imports this package."""
