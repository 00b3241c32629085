"""The latest snapshot kept up to date: new rows are merged into a stored state, so the
history is read once (A1)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.versions import drop_old_versions, read_version, versions, write_version
from .aggregates import latest_snapshot

#: The state's place has no date of its own.
_EPOCH = dt.date(1970, 1, 1)


class SnapshotState:
    """``latest_snapshot`` of all batches seen so far, stored under ``base``.

    The snapshot of a union is the snapshot of the snapshots: a batch is reduced to a row per
    entity first, then merged with the state by the same rule. So any split of the rows into
    batches, in any order, late and repeated rows included, gives the rows of one
    ``latest_snapshot`` over all of them. A batch costs its own rows and the state, which has
    a row per entity, not the history.

    The state is written as versions: readers never see a gap, and a batch that fails leaves
    the state before it. A batch that is named and was the last one merged is not merged
    again (it would change nothing either)."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], ts: str, out: str = "latest_snap_date", latest_only: bool = False, keep: int = 2):
        self.spark, self.base, self.keys, self.ts, self.out = spark, base, list(keys), ts, out
        self.latest_only, self.keep = latest_only, keep
        self._where = (base, "snapshot_state", _EPOCH)

    def read(self) -> DataFrame:
        """The current state; ``FileNotFoundError`` before the first batch."""
        return read_version(self.spark, *self._where)

    def update(self, batch: DataFrame, name: str | None = None) -> int:
        """Merge a batch; returns the rows of the state."""
        known = versions(self.spark, *self._where)
        if known and name is not None and known[0].inputs == name:
            return known[0].rows
        found = latest_snapshot(batch, self.keys, self.ts, self.out, self.latest_only)
        if known:
            both = self.read().unionByName(found)
            found = latest_snapshot(both.withColumnRenamed(self.out, "__ts"), self.keys, "__ts", self.out, self.latest_only)
        rows = write_version(found, *self._where, inputs=name).rows
        drop_old_versions(self.spark, *self._where, keep=self.keep)
        return rows

    def follow(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Merge every micro-batch of ``stream`` (default trigger: all there is, then stop).
        A micro-batch that Spark replays after a failure is known by its number."""
        writer = stream.writeStream.foreachBatch(lambda batch, number: self.update(batch, f"{checkpoint}#{number}") and None)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
