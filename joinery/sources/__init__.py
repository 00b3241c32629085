"""Sources, sinks and declared schemas."""

from .mixed import scan_mixed
from .readers import detect_format, scan, scan_table, scan_with_quarantine
from .schema import SchemaLike, assert_schema, conform, schema_diff, schema_from_spec
from .sinks import MULTI_LINE, dated_path, write_bucketed, write_csv, write_dated
from .versions import config_digest, drop_old_versions, finished, input_fingerprint, read_version, versions, write_version

__all__ = [
    "MULTI_LINE",
    "SchemaLike",
    "assert_schema",
    "config_digest",
    "conform",
    "dated_path",
    "detect_format",
    "drop_old_versions",
    "finished",
    "input_fingerprint",
    "read_version",
    "scan",
    "scan_mixed",
    "scan_table",
    "scan_with_quarantine",
    "schema_diff",
    "schema_from_spec",
    "write_bucketed",
    "versions",
    "write_csv",
    "write_dated",
    "write_version",
]
