"""Composite enrichment: key → activity labels → hierarchy snapshot → merge
(W1, W2, W3).

``enrich_frame`` builds the lazy plan; ``run_enrichment`` reads the sources
named by a config, writes each enabled output and returns the written paths.

Modes for combining the two enrichments:

* ``"merge"`` (the original job): full-outer merge of the two enriched frames
  on their common columns. Each side re-reads the primary, and rows with a NULL
  in a shared column come out once per side (see ``operators.merge``).
* ``"merge_null_safe"``: the same with ``<=>`` comparison.
* ``"chain"``: the hierarchy join applied to the activity result — one pass
  over the primary, no merge shuffle. Equals ``"merge"`` when the shared
  columns are non-NULL and primary rows are unique.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import NOT_DEFINED, common_columns, enrich, enrich_hierarchy, latest_snapshot, merge
from ..session import checkpoint_root
from ..sources import config_digest, finished, input_fingerprint, scan, scan_table, schema_from_spec, write_dated, write_version
from . import domain

log = logging.getLogger(__name__)

MODES = ("merge", "merge_null_safe", "chain")


@dataclass
class ActivityStep:
    """Left-join a label list on the key and take labels with a default."""

    lookup: DataFrame
    on: str | tuple[str, str] = domain.KEY_COL
    take: Mapping[str, str] = field(default_factory=lambda: dict(domain.ACTIVITY_TAKE))
    defaults: Any = NOT_DEFINED
    strategy: str = "catalyst"
    unique: bool = False


@dataclass
class HierarchyStep:
    """Left-join a snapshot on a field of the JSON column, keeping its columns."""

    snapshot: DataFrame
    json_col: str
    field: str = domain.HIERARCHY_FIELD
    right_key: str = domain.HIERARCHY_KEY
    out: str | None = None
    strategy: str = "catalyst"
    unique: bool = False


def _activity(df: DataFrame, step: ActivityStep, flag: str | None) -> DataFrame:
    return enrich(
        df, step.lookup, step.on, step.take, defaults=step.defaults, strategy=step.strategy,
        only_where=F.col(flag) if flag else None, unique=step.unique,
    )


def _hierarchy(df: DataFrame, step: HierarchyStep, flag: str | None) -> DataFrame:
    return enrich_hierarchy(
        df, step.snapshot, step.json_col, field=step.field, right_key=step.right_key,
        out=step.out, strategy=step.strategy, only_where=F.col(flag) if flag else None,
        unique=step.unique,
    )


def enrichment_branches(
    primary: DataFrame,
    key: Callable[[DataFrame], DataFrame] | None = domain.work_item_key,
    activity: ActivityStep | None = None,
    hierarchy: HierarchyStep | None = None,
    activity_flag: str | None = None,
    hierarchy_flag: str | None = None,
) -> dict[str, DataFrame]:
    """The keyed primary and each enabled enrichment, as lazy frames."""
    keyed = key(primary) if key else primary
    out = {"keyed": keyed}
    if activity is not None:
        out["activity"] = _activity(keyed, activity, activity_flag)
    if hierarchy is not None:
        out["hierarchy"] = _hierarchy(keyed, hierarchy, hierarchy_flag)
    return out


def _same_keys(branches: Mapping[str, DataFrame]) -> bool:
    """Whether the columns both enrichments share are all the keyed primary's, which an
    enrichment keeps as they are."""
    return set(common_columns(branches["activity"], branches["hierarchy"])) <= set(branches["keyed"].columns)


def combine(
    branches: Mapping[str, DataFrame],
    mode: str = "merge",
    hierarchy: HierarchyStep | None = None,
    hierarchy_flag: str | None = None,
) -> DataFrame:
    """The final frame from the branches: merged (both enabled), the single
    enrichment (one enabled), or the keyed primary (none, with a warning)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    a, b = branches.get("activity"), branches.get("hierarchy")
    if a is not None and b is not None:
        if mode == "chain":
            if hierarchy is None:
                raise ValueError("chain mode needs the hierarchy step")
            return _hierarchy(a, hierarchy, hierarchy_flag)
        return merge(a, b, null_safe=(mode == "merge_null_safe"), same_keys=_same_keys(branches))
    if a is not None:
        return a
    if b is not None:
        return b
    log.warning("no enrichment is enabled: returning the keyed primary")
    return branches["keyed"]


def enrich_frame(
    primary: DataFrame,
    key: Callable[[DataFrame], DataFrame] | None = domain.work_item_key,
    activity: ActivityStep | None = None,
    hierarchy: HierarchyStep | None = None,
    mode: str = "merge",
    activity_flag: str | None = None,
    hierarchy_flag: str | None = None,
    write_to: Mapping[str, str] | None = None,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Frame in, frame out: key the primary, apply the enabled enrichments and
    combine them by ``mode``. ``activity_flag`` / ``hierarchy_flag`` name
    boolean columns (e.g. from ``with_profile``) that switch an enrichment per
    row; a row whose flag is false keeps its columns with defaults / NULLs.

    ``write_to`` maps ``"activity"`` / ``"hierarchy"`` / ``"merged"`` to base
    paths: those outputs are written as ``{base}/{name}_{YYYYMMDD}`` (dated
    ``as_of``, default today) and the returned frame is read back from the
    written final output, so its lineage starts at the files."""
    branches = enrichment_branches(primary, key, activity, hierarchy, activity_flag, hierarchy_flag)
    if not write_to:
        return combine(branches, mode, hierarchy, hierarchy_flag)
    spark = primary.sparkSession
    written, final, frame = _write_outputs(
        spark, branches, hierarchy, hierarchy_flag, mode, write_to, as_of or dt.date.today()
    )
    return spark.read.parquet(written[final]) if final in written else frame


def _write_outputs(
    spark: SparkSession,
    branches: Mapping[str, DataFrame],
    hier: HierarchyStep | None,
    hier_flag: str | None,
    mode: str,
    paths: Mapping[str, str | None],
    as_of,
    unique: bool = False,
    want_frame: bool = True,
    put: Callable[[str, Callable[[], DataFrame]], str] | None = None,
) -> tuple[dict[str, str], str | None, DataFrame | None]:
    """Write each enrichment whose base path is set, then the combination of
    both. The combination continues from the written enrichments (or from a
    reliable checkpoint under ``spark.checkpoint.dir`` when one was not
    written), so the primary is not recomputed for it. Returns the written
    paths, the name of the final output (``None`` when nothing is enabled) and
    the final frame (built from the written sides where there are some; ``None`` if
    neither a merged path nor ``want_frame`` asks for it, and then nothing is
    checkpointed). ``put`` writes an output, given its name and what makes its frame, and
    returns its path; by default ``write_dated``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    def dated(name: str, made: Callable[[], DataFrame]) -> str:
        return write_dated(made(), paths[name], domain.OUTPUT_NAMES[name], as_of)

    put = put or dated
    written: dict[str, str] = {}
    for name in ("activity", "hierarchy"):
        if name in branches and paths.get(name):
            written[name] = put(name, functools.partial(branches.__getitem__, name))
    have_a, have_h = "activity" in branches, "hierarchy" in branches
    if not (have_a and have_h):
        if not have_a and not have_h:
            log.warning("both enrichments are off: nothing to do")
            return written, None, branches["keyed"]
        name = "activity" if have_a else "hierarchy"
        return written, name, branches[name]

    if not want_frame and not paths.get("merged"):
        return written, "merged", None

    def side(name: str) -> DataFrame:
        if name in written:
            return spark.read.parquet(written[name])
        checkpoint_root(spark)
        return branches[name].checkpoint(eager=True)

    def made() -> DataFrame:
        if mode == "chain":
            # continue from the written activity output instead of recomputing it
            base = spark.read.parquet(written["activity"]) if "activity" in written else branches["activity"]
            return _hierarchy(base, hier, hier_flag)
        return merge(side("activity"), side("hierarchy"), null_safe=(mode == "merge_null_safe"), unique=unique,
                     same_keys=_same_keys(branches))

    final: list[DataFrame] = []
    if paths.get("merged"):
        written["merged"] = put("merged", lambda: final.append(made()) or final[0])
    if not final and want_frame:
        final.append(made())
    return written, "merged", final[0] if final else None


def _spec(cfg: Mapping[str, Any], name: str):
    schemas = cfg.get("schemas") or {}
    spec = schemas.get(name)
    return schema_from_spec(spec) if spec is not None else None


def _restartable(spark: SparkSession, cfg: Mapping[str, Any], paths: Mapping[str, str | None], as_of, inputs: str | None):
    """Writes outputs as versions, unless the current one is finished from the same."""
    config = config_digest({**cfg, "as_of": str(as_of)})
    made_from: list[str] = []

    def put(name: str, made: Callable[[], DataFrame]) -> str:
        # what continues from other outputs depends on their versions too
        mine = None if inputs is None else ":".join([inputs, *(made_from if name == "merged" else [])])
        place = (paths[name], domain.OUTPUT_NAMES[name], as_of)
        done = finished(spark, *place, mine, config)
        if done:
            log.info("%s is finished: %s", name, done.data)
        else:
            done = write_version(made(), *place, mine, config)
        made_from.append(done.version)
        return done.data

    return put


def run_enrichment(spark: SparkSession, cfg: Mapping[str, Any]) -> dict[str, str]:
    """Run the config-driven job and return ``{output: path}`` of what was written.

    Config keys (names of the original job's config, plus a few of ours):
    ``primary_data_source`` (path or frame), ``schemas.primary_data_schema``,
    ``include_activity_data_enrichment``, ``activity_list_data_source``,
    ``schemas.activity_data_schema``, ``include_employee_hierarchy_enrichment``,
    ``employee_hierarchy_table`` (catalog name) or ``employee_hierarchy_source``
    (frame or path of the raw snapshots), ``employee_info_json_column``,
    ``activity_data_output_path``, ``employee_hierarchy_output_path``,
    ``output_path``; ours: ``as_of`` (date of the file names, default today),
    ``mode`` (``merge`` / ``merge_null_safe`` / ``chain``), ``strategy``,
    ``hierarchy_latest_only`` (one snapshot row per employee id, its latest
    name, instead of one per id and name), ``activity_take`` (output label →
    activity column, default ``Center`` ← ``New_Center`` and
    ``Capacity_Planning_Group``), ``merge_unique`` / ``activity_unique`` /
    ``hierarchy_unique`` (fail instead of multiplying rows when a merge key,
    an activity key or a snapshot key repeats), ``restart`` (see below).

    With ``restart`` the outputs are versions (``sources.versions``; the paths returned are
    those of their data, ``read_version`` finds them too). Started again after a lost driver
    with the same settings and unchanged input files, the job takes the outputs that are
    finished and makes the others. A changed file, setting or row count makes an output
    again, and those that continue from it; so does an input that is a frame of rows in
    memory, which nothing can be told of.

    An output is written only where its path is set. In merge modes the merge
    reads the two enrichments back from their written Parquet (or from a
    reliable checkpoint under ``spark.checkpoint.dir`` when a path is unset), so
    the primary is not recomputed and a lost executor only reruns the merge's
    own tasks.
    """
    primary = scan(spark, cfg["primary_data_source"], _spec(cfg, "primary_data_schema"))
    do_act = bool(cfg.get("include_activity_data_enrichment", False))
    do_hier = bool(cfg.get("include_employee_hierarchy_enrichment", False))
    as_of = cfg.get("as_of") or dt.date.today()
    mode = cfg.get("mode", "merge")
    strategy = cfg.get("strategy", "catalyst")

    act = hier = None
    if do_act:
        lookup = scan(spark, cfg["activity_list_data_source"], _spec(cfg, "activity_data_schema"))
        act = ActivityStep(lookup=lookup, strategy=strategy,
                           take=dict(cfg.get("activity_take") or domain.ACTIVITY_TAKE),
                           unique=bool(cfg.get("activity_unique", False)))
    if do_hier:
        raw = cfg.get("employee_hierarchy_source")
        raw = scan(spark, raw) if raw is not None else scan_table(spark, cfg["employee_hierarchy_table"])
        snap = latest_snapshot(raw, domain.HIERARCHY_GROUP, domain.HIERARCHY_TS, domain.HIERARCHY_OUT,
                               latest_only=bool(cfg.get("hierarchy_latest_only", False)))
        hier = HierarchyStep(snapshot=snap, json_col=cfg["employee_info_json_column"], strategy=strategy,
                             unique=bool(cfg.get("hierarchy_unique", False)))

    branches = enrichment_branches(primary, domain.work_item_key, act, hier)
    paths = {
        "activity": cfg.get("activity_data_output_path"),
        "hierarchy": cfg.get("employee_hierarchy_output_path"),
        "merged": cfg.get("output_path"),
    }
    put = None
    if cfg.get("restart", False):
        sources = [primary, *([act.lookup] if act else []), *([hier.snapshot] if hier else [])]
        put = _restartable(spark, cfg, paths, as_of, input_fingerprint(*sources))
    written, final, _frame = _write_outputs(spark, branches, hier, None, mode, paths, as_of,
                                            unique=bool(cfg.get("merge_unique", False)), want_frame=False, put=put)
    if final in ("activity", "hierarchy"):
        log.info("one enrichment only: no merged output")
    return written
