"""DataFrame → DataFrame operators (chain them with ``df.transform``)."""

from .aggregates import latest_snapshot, match_stats, span_bounds
from .hotkeys import frequent_keys, frequent_values
from .joins import (
    NOT_DEFINED,
    common_columns,
    enrich,
    enrich_hierarchy,
    enrich_sql,
    inner_sql,
    json_get,
    merge,
    with_indicator,
)
from .jsonops import json_put
from .keys import with_join_key
from .profile import (
    advise_broadcast,
    advise_join,
    broadcast_threshold,
    checked_broadcast,
    join_profile,
    profiles_frame,
    row_width,
    with_profile,
)
from .sketches import key_sketches, union_profile, write_sketches
from .snapshots import SnapshotState
from .timeseries import expand_days

__all__ = [
    "NOT_DEFINED",
    "SnapshotState",
    "advise_broadcast",
    "advise_join",
    "broadcast_threshold",
    "checked_broadcast",
    "common_columns",
    "enrich",
    "enrich_hierarchy",
    "enrich_sql",
    "expand_days",
    "frequent_keys",
    "frequent_values",
    "inner_sql",
    "join_profile",
    "json_get",
    "json_put",
    "key_sketches",
    "latest_snapshot",
    "match_stats",
    "merge",
    "profiles_frame",
    "row_width",
    "span_bounds",
    "union_profile",
    "with_indicator",
    "with_join_key",
    "with_profile",
    "write_sketches",
]
