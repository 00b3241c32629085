"""Streaming use of the enrichment operators.

The original job is batch-only. The lookup enrichments are stream-static
left-outer joins, which Structured Streaming runs per micro-batch without
state, so ``enrich`` / ``enrich_hierarchy`` / ``with_indicator`` / ``json_put``
/ ``expand_days`` apply to a streaming frame unchanged. The full-outer
``merge`` is not allowed between a stream and a static frame (Spark rejects
it); a streaming job uses the one-pass ``chain`` combination instead.

Each micro-batch joins the static lookups again: keep them small enough to
broadcast (``strategy="auto"`` on the steps checks that), or the lookup is
shuffled once per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.workflow import ActivityStep, HierarchyStep, enrich_frame


def enrich_stream(
    stream: DataFrame,
    key=None,
    activity: ActivityStep | None = None,
    hierarchy: HierarchyStep | None = None,
    activity_flag: str | None = None,
    hierarchy_flag: str | None = None,
) -> DataFrame:
    """``enrich_frame`` in chain mode for a streaming primary with static
    lookups (no state, no watermark needed)."""
    if not stream.isStreaming:
        raise ValueError("enrich_stream expects a streaming frame")
    for side in (activity and activity.lookup, hierarchy and hierarchy.snapshot):
        if side is not None and side.isStreaming:
            raise ValueError("lookups must be static frames")
    return enrich_frame(stream, key=key, activity=activity, hierarchy=hierarchy, mode="chain",
                        activity_flag=activity_flag, hierarchy_flag=hierarchy_flag)
