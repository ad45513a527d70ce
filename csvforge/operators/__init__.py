"""DataFrame operators: schema merge, typed fill, headers, arity, lookup."""
from .arity import quarantine, require_width, with_width
from .fill import fill_typed, lossy_counts, observed_types
from .headers import gate_headers, header_table, normalize_headers, split_header, valid_headers
from .lookup import lookup_join
from .schema import (infer_schema, infer_struct, merge_masks, merge_masks_long, merge_masks_sparse, record_types,
                     resolved_types)

__all__ = ["quarantine", "require_width", "with_width", "fill_typed", "lossy_counts",
           "observed_types", "gate_headers", "header_table", "normalize_headers", "split_header",
           "valid_headers", "lookup_join", "infer_schema", "infer_struct", "merge_masks",
           "merge_masks_long", "merge_masks_sparse", "record_types", "resolved_types"]
