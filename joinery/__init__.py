"""joinery — batch enrichment of large tables with Spark DataFrame / SQL
operators: composite join keys, lookup enrichment with defaults, JSON field
read and upsert, latest snapshots, merges, span expansion, join-side profiles
and per-source option profiles."""

__version__ = "0.1.0"

from .functions import join_key, json_value, normalise  # noqa: E402
from .operators import *  # noqa: F403
from .operators import __all__ as _ops
from .plans import (
    ActivityStep,
    HierarchyStep,
    enrich_frame,
    run_enrichment,
    span_expansion_job,
    tag_json_with_indicator,
    work_item_key,
)
from .sources import (
    assert_schema,
    conform,
    dated_path,
    read_version,
    scan,
    scan_table,
    scan_with_quarantine,
    schema_from_spec,
    write_bucketed,
    write_csv,
    write_dated,
    write_version,
)

__all__ = [
    *_ops,
    "ActivityStep",
    "HierarchyStep",
    "assert_schema",
    "conform",
    "dated_path",
    "enrich_frame",
    "join_key",
    "json_value",
    "normalise",
    "read_version",
    "run_enrichment",
    "scan",
    "scan_table",
    "scan_with_quarantine",
    "schema_from_spec",
    "span_expansion_job",
    "tag_json_with_indicator",
    "work_item_key",
    "write_bucketed",
    "write_csv",
    "write_dated",
    "write_version",
]
