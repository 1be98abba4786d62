"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from clickspark.functions.scalar import (
    ascii_only,
    blank_or_null,
    entropy_term,
    hash_unit,
    hex_bucket,
    key_string,
    sigmoid,
    split_fields,
    strip_ws,
)

__all__ = [
    "ascii_only", "blank_or_null", "entropy_term", "hash_unit", "hex_bucket",
    "key_string", "sigmoid", "split_fields", "strip_ws",
]
