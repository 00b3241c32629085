"""Column-level building blocks (no jobs, no joins)."""

from .jsonfields import json_path, json_value, parse_flat, upsert_field
from .keys import as_col, join_key, join_key_with_variants, normalise

__all__ = [
    "as_col",
    "join_key",
    "join_key_with_variants",
    "json_path",
    "json_value",
    "normalise",
    "parse_flat",
    "upsert_field",
]
