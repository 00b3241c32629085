"""Composite jobs (enrichment workflow) and the registered test queries."""

from .domain import work_item_key
from .jobs import span_expansion_job, tag_json_with_indicator
from .workflow import ActivityStep, HierarchyStep, combine, enrich_frame, enrichment_branches, run_enrichment

__all__ = [
    "ActivityStep",
    "HierarchyStep",
    "combine",
    "enrich_frame",
    "enrichment_branches",
    "run_enrichment",
    "span_expansion_job",
    "tag_json_with_indicator",
    "work_item_key",
]
