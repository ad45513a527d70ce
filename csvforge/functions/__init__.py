"""Native Column expressions: type inference, typed casts and text helpers."""
from . import types
from .convert import (cast_field, to_boolean, to_date, to_datetime, to_double, to_int,
                      to_long, to_time)
from .infer import infer_code, infer_type_name, is_true, type_bit
from .text import (base_name, java_split, normalize_header, table_name, uri_bucket, uri_path,
                   uri_scheme)

__all__ = ["types", "cast_field", "to_boolean", "to_date", "to_datetime", "to_double", "to_int",
           "to_long", "to_time", "infer_code", "infer_type_name", "is_true", "type_bit",
           "base_name", "java_split", "normalize_header", "table_name", "uri_bucket",
           "uri_path", "uri_scheme"]
