"""Registered queries on the driver's test tables, each with the DuckDB SQL that
computes the same result.

The test tables do not hold the work-item domain, so every operator runs on an
analogous table (orders as primary, customers as the label list, events with
their JSON ``props`` as the JSON-carrying primary, ...). Every query reads whole
tables; none is capped or sampled.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    SnapshotState,
    advise_join,
    enrich,
    enrich_hierarchy,
    enrich_sql,
    expand_days,
    frequent_keys,
    inner_sql,
    join_profile,
    json_get,
    json_put,
    key_sketches,
    latest_snapshot,
    match_stats,
    merge,
    profiles_frame,
    span_bounds,
    union_profile,
    with_indicator,
    with_join_key,
    with_profile,
    write_sketches,
)
from ..functions.keys import apart, normalise
from ..session import shared_path
from ..sources import (
    MULTI_LINE,
    conform,
    read_version,
    scan,
    scan_mixed,
    scan_table,
    scan_with_quarantine,
    versions,
    write_bucketed,
    write_csv,
    write_dated,
    write_version,
)
from .jobs import span_expansion_job, tag_json_with_indicator
from ..streaming import enrich_stream
from . import domain
from .workflow import ActivityStep, HierarchyStep, enrich_frame, run_enrichment

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# shared pieces
# --------------------------------------------------------------------------

def _part_keyed(spark, d):
    part = table(spark, d, "part")
    return with_join_key(
        part,
        ["p_type", "p_name", "p_size"],
        variants=[(F.col("p_type") == "ECONOMY", ["p_type", "p_name"])],
    )


# a third of the events come from users that are no supplier, so misses occur by themselves
_SUPPLIER = (("user_id", "s_suppkey"), {"supplier_name": "s_name", "nation": "s_nationkey"})


def _enrich_events(spark, d, strategy="catalyst"):
    return enrich(table(spark, d, "events"), table(spark, d, "supplier"), *_SUPPLIER, strategy=strategy)


def _brands(spark, d):
    """A brand for every full key; the short keys of the variant find none."""
    full = with_join_key(table(spark, d, "part"), ["p_type", "p_name", "p_size"])
    return full.groupBy("JoinKey").agg(F.max("p_brand").alias("brand"))


def _latest_order_date(spark, d):
    return latest_snapshot(table(spark, d, "orders"), ["o_custkey"], "o_orderdate")


def _events_no_error(spark, d):
    ev = table(spark, d, "events")
    return ev.withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))


def _merge_sides(spark, d):
    base = _events_no_error(spark, d)
    a = enrich(base, table(spark, d, "nation"), ("user_id", "n_nationkey"), {"nation_name": "n_name"})
    b = enrich(base, table(spark, d, "supplier"), ("user_id", "s_suppkey"), {"supplier_name": "s_name"})
    return a, b


def _order_spans(spark, d):
    o = table(spark, d, "orders")
    start = F.col("o_orderdate").cast("date")
    span = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 0).otherwise(-2)
    return o.select("o_orderkey", "o_orderstatus", start.alias("start_date"), F.date_add(start, span).alias("end_date"))


def _event_steps(spark, d):
    cust = table(spark, d, "customer")
    activity = with_join_key(cust, [F.lit("purchase"), "c_custkey"])
    act = ActivityStep(lookup=activity, take={"Center": "c_mktsegment", "Capacity_Planning_Group": "c_name"})
    hier = HierarchyStep(snapshot=_latest_order_date(spark, d), json_col="props", field="k",
                         right_key="o_custkey", out="employee_number")
    return act, hier


def _event_key(df):
    return with_join_key(df, ["event_type", "user_id"], variants=[(F.col("event_type") == "signup", ["event_type"])])


# Inline option profiles for the per-source query (config, not data).
EVENT_PROFILES = {
    "default": {"include_activity": True, "include_hierarchy": True, "output": "output"},
    "click": {"include_activity": True, "include_hierarchy": False, "output": "click_output"},
    "view": {"include_activity": False, "include_hierarchy": True, "output": None},
}


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------

def q_flagship(spark, d):
    keyed = _part_keyed(spark, d)
    brands = _brands(spark, d)
    return enrich(keyed, brands, "JoinKey", {"brand_label": "brand"})


def q_flagship_unique(spark, d):
    keyed = _part_keyed(spark, d)
    brands = _brands(spark, d)
    return enrich(keyed, brands, "JoinKey", {"brand_label": "brand"}, unique=True)


ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


def q_typed_scan(spark, d):
    orders = scan(spark, f"{d.rstrip('/')}/orders.parquet", schema=ORDERS_DDL)
    return conform(
        orders,
        "o_orderkey BIGINT, o_custkey INT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate DATE, o_orderpriority INT",
    )


CUSTOMER_SPEC = [
    {"name": "c_custkey", "type": "LongType", "nullable": True},
    {"name": "c_name", "type": "StringType", "nullable": True},
    {"name": "c_nationkey", "type": "IntegerType", "nullable": True},
    {"name": "c_acctbal", "type": "DoubleType", "nullable": True},
    {"name": "c_mktsegment", "type": "StringType", "nullable": True},
]


# A NULL marker of its own, so an empty string and NULL stay apart through CSV.
CSV_NULL = {"nullValue": "\\N"}


def q_csv_round_trip(spark, d):
    path = write_csv(table(spark, d, "customer"), shared_path(spark, "customer_csv"), options=CSV_NULL)
    return scan(spark, path, schema=CUSTOMER_SPEC, format="csv", options=CSV_NULL)


def q_dated_round_trip(spark, d):
    base = shared_path(spark, "dated")
    path = write_dated(table(spark, d, "orders"), base, "orders", dt.date(2024, 1, 1))
    return scan(spark, path)


def q_normalise_text(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", normalise("text").alias("norm_text"))


def q_join_key(spark, d):
    return _part_keyed(spark, d).select("p_partkey", "JoinKey")


def q_enrich_default(spark, d):
    return _enrich_events(spark, d)


def q_enrich_shuffle(spark, d):
    return _enrich_events(spark, d, strategy="shuffle")


def q_enrich_sql(spark, d):
    return enrich_sql(
        spark,
        table(spark, d, "events"),
        table(spark, d, "supplier"),
        *_SUPPLIER,
    )


def q_enrich_hint(spark, d):
    return _enrich_events(spark, d, strategy="auto")


def q_enrich_sql_hint(spark, d):
    return enrich_sql(
        spark,
        table(spark, d, "events"),
        table(spark, d, "supplier"),
        *_SUPPLIER,
        strategy="auto",
    )


def q_inner_sql(spark, d):
    return inner_sql(
        spark, table(spark, d, "events"), table(spark, d, "supplier"), ("user_id", "s_suppkey"), ["event_id"], ["s_name"],
    )


def q_json_get(spark, d):
    return json_get(table(spark, d, "events"), "props", "k", out="k")


def q_hierarchy_enrich(spark, d):
    return enrich_hierarchy(
        table(spark, d, "events"), _latest_order_date(spark, d), "props",
        field="k", right_key="o_custkey", out="employee_number",
    )


def q_hierarchy_enrich_hint(spark, d):
    return enrich_hierarchy(
        table(spark, d, "events"), _latest_order_date(spark, d), "props",
        field="k", right_key="o_custkey", out="employee_number", strategy="auto",
    )


def q_latest_snapshot(spark, d):
    return latest_snapshot(table(spark, d, "events"), ["user_id", "event_type"], "ts")


def q_latest_snapshot_by_id(spark, d):
    return latest_snapshot(table(spark, d, "events"), ["user_id", "event_type"], "ts", latest_only=True)


def q_indicator(spark, d):
    return with_indicator(table(spark, d, "events"), table(spark, d, "supplier"),
                          ("user_id", "s_suppkey"), code="s_name")


def q_json_put(spark, d):
    flagged = with_indicator(table(spark, d, "events"), table(spark, d, "supplier"),
                             ("user_id", "s_suppkey"), code="s_name")
    return json_put(flagged, "props", "indicator", "indicator")


def q_json_put_bad_payload(spark, d):
    return json_put(table(spark, d, "pages"), "html", "url", "url", flag="_corrupt")


def q_indicator_job(spark, d):
    return tag_json_with_indicator(table(spark, d, "events"), table(spark, d, "supplier"),
                                   ("user_id", "s_suppkey"), "s_name", "props", "indicator")


def q_merge_outer(spark, d):
    a, b = _merge_sides(spark, d)
    return merge(a, b)


def q_merge_null_safe(spark, d):
    a, b = _merge_sides(spark, d)
    return merge(a, b, null_safe=True)


def q_merge_outer_plain(spark, d):
    a, b = _merge_sides(spark, d)
    return merge(a, b, skew_split=False)


def q_merge_null_safe_plain(spark, d):
    a, b = _merge_sides(spark, d)
    return merge(a, b, null_safe=True, skew_split=False)


def q_expand_days(spark, d):
    return expand_days(_order_spans(spark, d), "start_date", "end_date")


def q_expand_days_drop(spark, d):
    return expand_days(_order_spans(spark, d), "start_date", "end_date", on_reversed="drop")


SPAN_DDL = "o_orderkey BIGINT, o_orderstatus STRING, start_date DATE, end_date DATE"


def q_expand_days_keep_null(spark, d):
    return expand_days(_order_spans(spark, d), "start_date", "end_date", on_reversed="drop", keep_null=True)


def q_span_job(spark, d):
    src = write_csv(_order_spans(spark, d), shared_path(spark, "spans_csv"))
    _bounds, expanded = span_expansion_job(spark, src, SPAN_DDL, "start_date", "end_date",
                                           output_path=shared_path(spark, "spans_out"))
    return expanded


def q_span_bounds(spark, d):
    return span_bounds(_order_spans(spark, d), "start_date", "end_date")


def q_span_bounds_shipdate(spark, d):
    return span_bounds(table(spark, d, "lineitem"), "l_shipdate", "l_shipdate")


def q_join_profile(spark, d):
    return join_profile(table(spark, d, "orders"), "o_custkey", exact=True)


def q_join_profile_approx(spark, d):
    """The sketch against the exact count: rows and NULL keys are exact, the distinct keys
    within 5 %."""
    events = table(spark, d, "events")
    close = F.abs(F.col("keys") - F.col("exact")) <= 0.05 * F.col("exact")
    exact = events.agg(F.countDistinct("user_id").alias("exact"))
    return join_profile(events, "user_id", hash_keys=True).crossJoin(F.broadcast(exact)).select("rows", "null_keys", close.alias("keys_close"))


def q_advise_join(spark, d):
    """The advice for events and suppliers, as a row."""
    events, supplier = table(spark, d, "events"), table(spark, d, "supplier")
    side, left, right = advise_join(events, supplier, "user_id", "s_suppkey", threshold=10 * 1024 * 1024, max_keys=5000)
    rows = events.agg(F.count(F.lit(1)).alias("left_rows"))
    return rows.select(F.lit(side).alias("side"), "left_rows", F.lit(left["rows"]).alias("profiled_left"), F.lit(right["rows"]).alias("profiled_right"))


def q_table_scan(spark, d):
    """The supplier table saved in the session's catalog and read by name."""
    name = f"joinery_supplier_{uuid.uuid4().hex}"
    supplier = table(spark, d, "supplier")
    supplier.write.option("path", shared_path(spark, "table_scan")).saveAsTable(name)
    return scan_table(spark, name, schema=supplier.schema)


def q_enrich_bucketed(spark, d):
    """Line items and their orders (but for those of status P) as bucketed tables, enriched
    without a shuffle of either."""
    run = uuid.uuid4().hex
    orders = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    tables = ((table(spark, d, "lineitem"), f"joinery_items_{run}", "l_orderkey"), (orders, f"joinery_orders_{run}", "o_orderkey"))
    for df, name, key in tables:
        write_bucketed(df, name, [key], 16, shared_path(spark, "bucketed"))
    items, known = (scan_table(spark, name) for _, name, _ in tables)
    return enrich(items, known, ("l_orderkey", "o_orderkey"), {"order_status": "o_orderstatus", "customer": "o_custkey"}, defaults={"order_status": "Not Defined"}, strategy="shuffle")


def q_frequent_keys(spark, d):
    """Keys with a hundredth of the rows or more: languages and sources of documents, event
    types, and order keys of line items, of which none is frequent."""
    found = None
    for name, column in (("documents", "lang"), ("documents", "source"), ("events", "event_type"), ("lineitem", "l_orderkey")):
        keys = frequent_keys(table(spark, d, name), column).select(F.lit(f"{name}.{column}").alias("column"), F.col("key").cast("string").alias("key"), "rows", "total")
        found = keys if found is None else found.unionByName(keys)
    return found


def q_enrich_split(spark, d):
    """Events whose errors and views all fall to user 1, the rest of a type without a user:
    the hot key and the rows without one stay where they are."""
    user = F.when(F.col("event_type").isin("error", "view"), 1).when(F.col("event_type") != "signup", F.col("user_id"))
    events = table(spark, d, "events").withColumn("user_id", user.cast("long"))
    return enrich(events, table(spark, d, "supplier"), *_SUPPLIER, strategy="split")


def q_csv_text_round_trip(spark, d):
    """Whole texts with their line ends through CSV."""
    docs = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    path = write_csv(docs, shared_path(spark, "documents_csv"), options=CSV_NULL, multi_line=True)
    return scan(spark, path, schema=docs.schema, format="csv", options={**MULTI_LINE, **CSV_NULL})


def q_enrich_sql_typed(spark, d):
    """A text key with junk against a BIGINT key, and a numeric label with the text default."""
    events = table(spark, d, "events")
    key = F.when(F.col("event_type") == "error", F.lit("no number")).otherwise(F.col("user_id").cast("string"))
    return enrich_sql(spark, events.withColumn("user_text", key), table(spark, d, "supplier"), ("user_text", "s_suppkey"), {"nation": "s_nationkey"})


def q_json_put_mixed(spark, d):
    """Payloads of every kind, derived from the events: object, NULL, bad text, text behind
    the object, repeated field, the field already there, a nested value."""
    n = F.col("event_id") % 7
    k = F.col("user_id").cast("string")
    payload = (F.when(n == 0, F.col("props")).when(n == 1, F.lit(None).cast("string")).when(n == 2, F.concat(F.lit("<p>"), k))
               .when(n == 3, F.concat(F.col("props"), F.lit(" tail"))).when(n == 4, F.concat(F.lit('{"a":"1","a":"'), k, F.lit('"}')))
               .when(n == 5, F.concat(F.lit('{"kind":"old","a":"'), k, F.lit('"}'))).otherwise(F.concat(F.lit('{"a":{"b":'), k, F.lit("}}"))))
    events = table(spark, d, "events").select("event_id", "event_type", payload.alias("payload"))
    return json_put(events, "payload", "kind", "event_type", flag="_corrupt")


WIDE = 70
#: Rows of so many keys that a task groups in memory; a row takes about 0.6 KB.
WIDE_ROWS = 200_000


def q_merge_wide(spark, d):
    """A null-safe merge on 70 derived key columns, NULL in one of two of the last ones."""
    # dealt by the first key while rows have two columns: grouping by all keys needs no shuffle of 71 then.
    # The number of partitions is set, as the wide rows need more of them than these do
    base = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // WIDE_ROWS))
    base = base.repartition(parts, "l_orderkey")
    number = F.col("l_linenumber")

    def side(gap: int, label: str):
        cols = [F.when(F.lit(i) != F.lit(60) + (number + gap) % 8, F.col("l_orderkey") % (i + 2)) for i in range(WIDE)]
        # the keys are grouped as one array: the code of 71 grouping columns is too long to be compiled, as their projection is
        packed = F.array(apart(cols[0], F.lit(None).cast("long")), *cols[1:])
        rows = base.select("l_orderkey", packed.alias("keys")).groupBy("l_orderkey", "keys").agg(F.count(F.lit(1)).alias(label))
        return rows.select("l_orderkey", *[F.get("keys", F.lit(i)).alias(f"k{i}") for i in range(WIDE)], label)

    return merge(side(0, "left_rows"), side(3, "right_rows"), null_safe=True).select("l_orderkey", "k62", "k63", "k64", "left_rows", "right_rows")


def q_merge_repeats(spark, d):
    """A faithful merge on a key that repeats on both sides and is missing on either."""
    events, supplier = table(spark, d, "events"), table(spark, d, "supplier")
    a = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    b = supplier.select((F.col("s_suppkey") + 60).alias("user_id"), F.col("s_nationkey").alias("nation"))
    b = b.union(b.select("user_id", F.lit(-1).cast(b.schema["nation"].dataType))).union(b.select(F.lit(None).cast("long"), "nation"))
    return merge(a, b)


def q_latest_snapshot_three(spark, d):
    """One row per user, with keys that come from one and the same latest row."""
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return latest_snapshot(events, ["user_id", "event_type", "event_id"], "day", latest_only=True)



def q_match_stats(spark, d):
    return match_stats(_enrich_events(spark, d), ["supplier_name", "nation"], unmatched="Not Defined")


def q_source_profile(spark, d):
    return with_profile(table(spark, d, "events"), profiles_frame(spark, EVENT_PROFILES), "event_type")


def q_enrich_frame_merge(spark, d):
    act, hier = _event_steps(spark, d)
    return enrich_frame(table(spark, d, "events"), key=_event_key, activity=act, hierarchy=hier, mode="merge")


def q_enrich_frame_chain(spark, d):
    act, hier = _event_steps(spark, d)
    return enrich_frame(table(spark, d, "events"), key=_event_key, activity=act, hierarchy=hier, mode="chain")


def q_enrich_stream_chain(spark, d):
    """The chain enrichment as a Structured Streaming job: a file stream over
    the events table, static lookups, a Parquet file sink and its checkpoint in
    the shared folder, run once over all available input; the written output
    is read back as a batch frame."""
    events = table(spark, d, "events")
    stream = (spark.readStream.schema(events.schema)
              .option("pathGlobFilter", "events.parquet")
              .parquet(d.rstrip("/")))
    act, hier = _event_steps(spark, d)
    out = enrich_stream(stream, key=_event_key, activity=act, hierarchy=hier)
    path = shared_path(spark, "events_stream_out")
    query = (out.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", shared_path(spark, "events_stream_ckpt"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def q_enrich_frame_by_source(spark, d):
    act, hier = _event_steps(spark, d)
    events = with_profile(table(spark, d, "events"), profiles_frame(spark, EVENT_PROFILES), "event_type")
    return enrich_frame(events, key=_event_key, activity=act, hierarchy=hier, mode="chain",
                        activity_flag="include_activity", hierarchy_flag="include_hierarchy")


def _parts(number):
    """The work item's eight parts for a number; every third one is a CART item."""
    text = {p: F.concat(F.lit("s"), number % (i + 2)) for i, p in enumerate(domain.WORK_ITEM_PARTS)}
    text["data_source"] = F.when(number % 3 == 0, domain.SHORT_KEY_SOURCE).otherwise("web")
    text["process"] = F.concat(F.lit("item "), number)
    return [c.alias(p) for p, c in text.items()]


def _run_enrichment(spark, d, mode):
    """The config-driven job; its merged output is read back from its files."""
    return scan(spark, run_enrichment(spark, _run_config(spark, d, mode))["merged"])


def _run_config(spark, d, mode):
    """Work items made from events, labels from suppliers, snapshots from orders."""
    events, supplier, orders = (table(spark, d, t) for t in ("events", "supplier", "orders"))
    info = F.concat(F.lit('{"employee_number": "'), F.col("user_id"), F.lit('"}')).alias("employee_info")
    labels = domain.work_item_key(supplier.select("s_name", "s_nationkey", *_parts(F.col("s_suppkey")))).select(
        "JoinKey", F.col("s_name").alias("New_Center"), F.col("s_nationkey").cast("string").alias("Capacity_Planning_Group"))
    snapshots = orders.select(F.col("o_custkey").alias("employeeid"), F.concat(F.lit("n"), F.col("o_custkey")).alias("employeename"),
                              F.col("o_orderdate").alias("snap_date"))
    return {
        "primary_data_source": events.select("event_id", *_parts(F.col("user_id")), info),
        "include_activity_data_enrichment": True, "activity_list_data_source": labels,
        "include_employee_hierarchy_enrichment": True, "employee_hierarchy_source": snapshots,
        "employee_info_json_column": "employee_info", "output_path": shared_path(spark, "run_enrichment"),
        "as_of": "2024-01-01", "mode": mode,
    }


def q_run_enrichment_restart(spark, d):
    """The job over Parquet sources, started again: the second run finds all it needs."""
    cfg = _run_config(spark, d, "merge")
    for name in ("primary_data_source", "activity_list_data_source", "employee_hierarchy_source"):
        path = f"{shared_path(spark, name)}.parquet"
        cfg[name].write.parquet(path)
        cfg[name] = path
    cfg.update(restart=True, activity_data_output_path=shared_path(spark, "restart_a"), employee_hierarchy_output_path=shared_path(spark, "restart_h"))
    first, second = run_enrichment(spark, cfg), run_enrichment(spark, cfg)
    if first != second:
        raise RuntimeError(f"the second run made outputs again: {first} {second}")
    return scan(spark, second["merged"])


def q_versioned_overwrite(spark, d):
    """What readers see of an output: its first version, the same after an overwrite that
    fails half-way, and the second version."""
    orders, base = table(spark, d, "orders"), shared_path(spark, "versions")
    seen = None

    def look(step: str) -> None:
        nonlocal seen
        now = versions(spark, base, "orders", "2024-01-01")[0]
        part = read_version(spark, base, "orders", "2024-01-01", now.version).withColumn("step", F.lit(step)).withColumn("written", F.lit(now.rows))
        seen = part if seen is None else seen.unionByName(part)

    write_version(orders.filter("o_orderstatus = 'F'"), base, "orders", "2024-01-01")
    look("first")
    price = F.when(F.col("o_orderkey") % 1000 == 999, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("o_totalprice"))
    try:
        write_version(orders.withColumn("o_totalprice", price), base, "orders", "2024-01-01")
        raise RuntimeError("the write should have failed")
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "lost" not in str(e):
            raise
    look("after a failure")
    write_version(orders, base, "orders", "2024-01-01")
    look("second")
    return seen


def q_union_profile(spark, d):
    """The profile of the events' users from daily sketches: those of all days but the last
    five are stored first, the others added, one of them twice."""
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    path = shared_path(spark, "sketches")
    last = events.agg(F.date_sub(F.max("day"), 5).alias("day"))
    old = events.join(F.broadcast(last.withColumnRenamed("day", "until")), F.col("day") <= F.col("until")).drop("until")
    new = events.join(F.broadcast(last.withColumnRenamed("day", "until")), F.col("day") > F.col("until")).drop("until")
    for part in (old, new, new.filter("day IS NOT NULL")):
        write_sketches(key_sketches(part, "user_id", ["day"]), path, ["day"])
    exact = events.agg(F.countDistinct("user_id").alias("exact"))
    close = F.abs(F.col("keys") - F.col("exact")) <= 0.05 * F.col("exact")
    return union_profile(spark.read.parquet(path)).join(F.broadcast(exact)).select("rows", "null_keys", close.alias("keys_close"))


def q_snapshot_state(spark, d):
    """The latest date of each user and type, merged batch by batch: the events by the
    remainder of their id, so that every batch brings late rows."""
    events = table(spark, d, "events")
    state = SnapshotState(spark, shared_path(spark, "snapshot_state"), ["user_id", "event_type"], "ts")
    for k in range(3):
        state.update(events.filter(F.col("event_id") % 3 == k), f"batch {k}")
    return state.read()


def q_snapshot_stream(spark, d):
    """The same with one type per user, as a stream of files."""
    events, path = table(spark, d, "events"), shared_path(spark, "snapshot_files")
    events.withColumn("ts", F.col("ts").cast("date")).repartition(4, "event_id").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 2).parquet(path)
    state = SnapshotState(spark, shared_path(spark, "snapshot_stream"), ["user_id", "event_type", "event_id"], "ts", latest_only=True)
    state.follow(stream, shared_path(spark, "snapshot_ckpt")).awaitTermination()
    return state.read()


def q_expand_days_chunks(spark, d):
    """The spans of the orders in pieces of two days, and one of 20,000 days."""
    spans = _order_spans(spark, d)
    spans = spans.withColumn("end_date", F.when(F.col("o_orderkey") == 1, F.date_add("start_date", 19_999)).otherwise(F.col("end_date")))
    return expand_days(spans, "start_date", "end_date", "snap_date", chunk_days=2)


def q_json_put_lossless(spark, d):
    """Payloads with exact numbers, nested values and blanks; one in two has the field."""
    events = table(spark, d, "events")
    rest = F.concat(F.lit('"n": 1.10, "big":12345678901234567890123 ,"in":{"k":[1, 2.50,"}"],"kind":"x"}'), F.lit(',"user": "'), F.col("user_id"), F.lit('"'))
    old = F.when(F.col("event_id") % 2 == 0, '"kind":["old",1],').otherwise("")
    payload = F.when(F.col("event_id") % 5 != 4, F.concat(F.lit("{"), old, rest, F.lit("}"))).when(F.col("event_id") % 10 == 9, " { } ")
    out = events.select("event_id", "event_type", payload.alias("payload"))
    return json_put(out, "payload", "kind", "event_type", lossless=True)


def q_mixed_folder(spark, d):
    """Orders in three folders: one with short keys and no status, one with a date for the
    timestamp, one as they are."""
    orders, path = table(spark, d, "orders"), shared_path(spark, "mixed")
    part = lambda k: orders.filter(F.col("o_orderkey") % 3 == k)
    part(0).withColumn("o_custkey", F.col("o_custkey").cast("int")).drop("o_orderstatus").write.parquet(f"{path}/a")
    part(1).withColumn("o_orderdate", F.col("o_orderdate").cast("date")).write.parquet(f"{path}/b")
    part(2).write.parquet(f"{path}/c")
    return scan_mixed(spark, path)[0]


def q_csv_quarantine(spark, d):
    """Events as CSV whose errors have a text for a user and whose signups one value too
    many: good rows and bad lines."""
    events = table(spark, d, "events")
    user = F.when(F.col("event_type") == "error", F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    kind = F.when(F.col("event_type") == "signup", "signup,twice").otherwise(F.col("event_type"))
    raw = events.select(F.concat_ws(",", "event_id", user, kind).alias("event_id,user_id,event_type"))
    path = write_csv(raw, shared_path(spark, "csv_quarantine"), options={"sep": "\t"})  # no quotes around the commas
    place = shared_path(spark, "quarantine")
    good, found = scan_with_quarantine(spark, path, "event_id bigint, user_id bigint, event_type string", place)
    good = good.select(F.lit("good").alias("kind"), F.concat_ws(",", "event_id", "user_id", "event_type").alias("line"))
    bad = spark.read.parquet(f"{place}/bad").select(F.lit("bad").alias("kind"), "line")
    return good.unionByName(bad).withColumn("lines", F.lit(found["good"] + found["bad"]).cast("long"))


def q_run_enrichment_merge(spark, d):
    return _run_enrichment(spark, d, "merge")


def q_run_enrichment_chain(spark, d):
    return _run_enrichment(spark, d, "chain")


QUERIES: dict[str, Query] = {
    "flagship": q_flagship,
    "flagship_unique": q_flagship_unique,
    "typed_scan": q_typed_scan,
    "csv_round_trip": q_csv_round_trip,
    "dated_round_trip": q_dated_round_trip,
    "normalise_text": q_normalise_text,
    "join_key": q_join_key,
    "enrich_default": q_enrich_default,
    "enrich_shuffle": q_enrich_shuffle,
    "enrich_sql": q_enrich_sql,
    "enrich_hint": q_enrich_hint,
    "enrich_sql_hint": q_enrich_sql_hint,
    "inner_sql": q_inner_sql,
    "json_get": q_json_get,
    "hierarchy_enrich": q_hierarchy_enrich,
    "hierarchy_enrich_hint": q_hierarchy_enrich_hint,
    "latest_snapshot": q_latest_snapshot,
    "latest_snapshot_by_id": q_latest_snapshot_by_id,
    "indicator": q_indicator,
    "json_put": q_json_put,
    "json_put_bad_payload": q_json_put_bad_payload,
    "indicator_job": q_indicator_job,
    "merge_outer": q_merge_outer,
    "merge_null_safe": q_merge_null_safe,
    "merge_outer_plain": q_merge_outer_plain,
    "merge_null_safe_plain": q_merge_null_safe_plain,
    "expand_days": q_expand_days,
    "expand_days_drop": q_expand_days_drop,
    "expand_days_keep_null": q_expand_days_keep_null,
    "span_job": q_span_job,
    "span_bounds": q_span_bounds,
    "span_bounds_shipdate": q_span_bounds_shipdate,
    "join_profile": q_join_profile,
    "join_profile_approx": q_join_profile_approx,
    "match_stats": q_match_stats,
    "source_profile": q_source_profile,
    "enrich_frame_merge": q_enrich_frame_merge,
    "enrich_frame_chain": q_enrich_frame_chain,
    "enrich_stream_chain": q_enrich_stream_chain,
    "enrich_frame_by_source": q_enrich_frame_by_source,
    "run_enrichment_merge": q_run_enrichment_merge,
    "run_enrichment_chain": q_run_enrichment_chain,
    "advise_join": q_advise_join,
    "table_scan": q_table_scan,
    "csv_text_round_trip": q_csv_text_round_trip,
    "enrich_sql_typed": q_enrich_sql_typed,
    "json_put_mixed": q_json_put_mixed,
    "merge_wide": q_merge_wide,
    "merge_repeats": q_merge_repeats,
    "latest_snapshot_three": q_latest_snapshot_three,
    "enrich_bucketed": q_enrich_bucketed,
    "frequent_keys": q_frequent_keys,
    "enrich_split": q_enrich_split,
    "run_enrichment_restart": q_run_enrichment_restart,
    "versioned_overwrite": q_versioned_overwrite,
    "csv_quarantine": q_csv_quarantine,
    "mixed_folder": q_mixed_folder,
    "json_put_lossless": q_json_put_lossless,
    "union_profile": q_union_profile,
    "snapshot_state": q_snapshot_state,
    "snapshot_stream": q_snapshot_stream,
    "expand_days_chunks": q_expand_days_chunks,
}


# --------------------------------------------------------------------------
# DuckDB oracle SQL
# --------------------------------------------------------------------------

def _n(x: str) -> str:
    """The key-part normaliser in DuckDB SQL."""
    return rf"upper(regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '\W', '', 'g'))"


_PART_KEYED = f"""
part_keyed AS (
  SELECT *, CASE WHEN p_type = 'ECONOMY'
                 THEN concat_ws('|', {_n('p_type')}, {_n('p_name')})
                 ELSE concat_ws('|', {_n('p_type')}, {_n('p_name')}, {_n('p_size')}) END AS JoinKey
  FROM part)"""

_ENRICH_EVENTS = """
SELECT e.*, coalesce(s.s_name, 'Not Defined') AS supplier_name,
       coalesce(CAST(s.s_nationkey AS VARCHAR), 'Not Defined') AS nation
FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey"""

_HIERARCHY = """
WITH s AS (SELECT o_custkey, max(o_orderdate) AS latest_snap_date FROM orders GROUP BY o_custkey),
     e AS (SELECT *, json_extract_string(props, '$.k') AS employee_number FROM events)
SELECT e.*, s.o_custkey, s.latest_snap_date
FROM e LEFT JOIN s ON TRY_CAST(e.employee_number AS BIGINT) = s.o_custkey"""

_JSON_PUT = """
WITH f AS (SELECT e.*, coalesce(s.s_name, 'N') AS indicator
           FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey)
SELECT event_id, ts, user_id, event_type, value,
       '{"k":"' || json_extract_string(props, '$.k') || '","indicator":"' || indicator || '"}' AS props,
       indicator
FROM f"""

_MERGE_SIDES = """
base AS (SELECT event_id, ts, user_id,
                CASE WHEN event_type <> 'error' THEN event_type END AS event_type, value, props
         FROM events),
a AS (SELECT b.*, coalesce(n.n_name, 'Not Defined') AS nation_name
      FROM base b LEFT JOIN nation n ON b.user_id = n.n_nationkey),
s AS (SELECT b.*, coalesce(x.s_name, 'Not Defined') AS supplier_name
      FROM base b LEFT JOIN supplier x ON b.user_id = x.s_suppkey)"""

_MERGE_KEYS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

_SPANS = """
spans AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS start_date,
         CAST(CAST(o_orderdate AS DATE) + CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 0 ELSE -2 END AS DATE) AS end_date
  FROM orders)"""

_EXPANDED = _SPANS + """,
steps AS (
  SELECT *, unnest(generate_series(0, abs(end_date - start_date))) AS i FROM spans)"""

_EVENT_FRAME = f"""
WITH k AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN concat_ws('|', {_n('event_type')})
                 ELSE concat_ws('|', {_n('event_type')}, {_n('user_id')}) END AS JoinKey
  FROM events),
act AS (
  SELECT concat_ws('|', 'PURCHASE', {_n('c_custkey')}) AS JoinKey, c_mktsegment, c_name
  FROM customer),
s AS (SELECT o_custkey, max(o_orderdate) AS latest_snap_date FROM orders GROUP BY o_custkey)
SELECT k.*, coalesce(act.c_mktsegment, 'Not Defined') AS Center,
       coalesce(act.c_name, 'Not Defined') AS Capacity_Planning_Group,
       json_extract_string(k.props, '$.k') AS employee_number, s.o_custkey, s.latest_snap_date
FROM k
LEFT JOIN act ON k.JoinKey = act.JoinKey
LEFT JOIN s ON TRY_CAST(json_extract_string(k.props, '$.k') AS BIGINT) = s.o_custkey"""

_PROFILES = """
p(source, include_activity, include_hierarchy, output) AS (
  VALUES ('default', true, true, 'output'),
         ('click', true, false, 'click_output'),
         ('view', false, true, NULL))"""

_WITH_PROFILE = f"""
WITH {_PROFILES},
ep AS (
  SELECT e.*,
         CASE WHEN p.source IS NOT NULL THEN p.include_activity ELSE true END AS include_activity,
         CASE WHEN p.source IS NOT NULL THEN p.include_hierarchy ELSE true END AS include_hierarchy,
         CASE WHEN p.source IS NOT NULL THEN p.output ELSE 'output' END AS output
  FROM events e LEFT JOIN p ON e.event_type = p.source)"""

_FLAGSHIP = f"""
WITH {_PART_KEYED},
brands AS (
  SELECT concat_ws('|', {_n('p_type')}, {_n('p_name')}, {_n('p_size')}) AS JoinKey, max(p_brand) AS brand FROM part GROUP BY ALL)
SELECT k.*, coalesce(b.brand, 'Not Defined') AS brand_label
FROM part_keyed k LEFT JOIN brands b ON k.JoinKey = b.JoinKey"""

_MERGE_OUTER = f"""
WITH {_MERGE_SIDES}
SELECT * FROM a FULL JOIN s USING ({', '.join(_MERGE_KEYS)})"""

_MERGE_NULL_SAFE = f"""
WITH {_MERGE_SIDES}
SELECT {', '.join(f'coalesce(a.{k}, s.{k}) AS {k}' for k in _MERGE_KEYS)},
       a.nation_name, s.supplier_name
FROM a FULL JOIN s ON {' AND '.join(f'a.{k} IS NOT DISTINCT FROM s.{k}' for k in _MERGE_KEYS)}"""

def _sql_parts(x: str) -> str:
    rest = ", ".join(f"'s' || ({x} % {i + 2}) AS subprocess_{i - 1}" for i in range(2, 8))
    return f"CASE WHEN {x} % 3 = 0 THEN 'CART' ELSE 'web' END AS data_source, 'item ' || {x} AS process, {rest}"


_SQL_KEY = ("concat_ws('|', upper(data_source), replace(upper(process), ' ', ''), upper(subprocess_1), upper(subprocess_2), upper(subprocess_3), "
            "CASE WHEN data_source <> 'CART' THEN upper(subprocess_4) END, upper(subprocess_5), upper(subprocess_6)) AS JoinKey")

_RUN = f"""
WITH p AS (SELECT *, {_SQL_KEY} FROM (
  SELECT event_id, {_sql_parts('user_id')}, '{{"employee_number": "' || user_id || '"}}' AS employee_info, CAST(user_id AS VARCHAR) AS employee_number FROM events)),
l AS (SELECT *, {_SQL_KEY} FROM (SELECT s_name, s_nationkey, {_sql_parts('s_suppkey')} FROM supplier)),
h AS (SELECT o_custkey AS employeeid, 'n' || o_custkey AS employeename, max(o_orderdate) AS latest_snap_date FROM orders GROUP BY ALL)
SELECT p.*, coalesce(l.s_name, 'Not Defined') AS Center, coalesce(CAST(l.s_nationkey AS VARCHAR), 'Not Defined') AS Capacity_Planning_Group,
       h.employeeid, h.employeename, h.latest_snap_date
FROM p LEFT JOIN l ON p.JoinKey = l.JoinKey LEFT JOIN h ON CAST(p.employee_number AS BIGINT) = h.employeeid"""


def _wide(gap: int) -> str:
    keys = ", ".join(f"CASE WHEN {i} <> 60 + (l_linenumber + {gap}) % 8 THEN l_orderkey % {i + 2} END AS k{i}" for i in range(WIDE))
    return f"(SELECT l_orderkey, {keys}, count(*) AS n FROM lineitem GROUP BY ALL)"


_MERGE_WIDE = f"""
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, {", ".join(f"CASE WHEN a.l_orderkey IS NULL THEN b.k{i} ELSE a.k{i} END AS k{i}" for i in (62, 63, 64))},
       a.n AS left_rows, b.n AS right_rows
FROM {_wide(0)} a FULL JOIN {_wide(3)} b
  ON a.l_orderkey = b.l_orderkey AND {" AND ".join(f"a.k{i} IS NOT DISTINCT FROM b.k{i}" for i in range(WIDE))}"""

ORACLE_SQL: dict[str, str] = {
    "flagship": _FLAGSHIP,
    "flagship_unique": _FLAGSHIP,
    "typed_scan": """
SELECT o_orderkey, TRY_CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority
FROM orders""",
    "csv_round_trip": "SELECT * FROM customer",
    "dated_round_trip": "SELECT * FROM orders",
    "normalise_text": f"SELECT doc_id, {_n('text')} AS norm_text FROM documents",
    "join_key": f"WITH {_PART_KEYED} SELECT p_partkey, JoinKey FROM part_keyed",
    "enrich_default": _ENRICH_EVENTS,
    "enrich_shuffle": _ENRICH_EVENTS,
    "enrich_sql": _ENRICH_EVENTS,
    "enrich_hint": _ENRICH_EVENTS,
    "enrich_sql_hint": _ENRICH_EVENTS,
    "inner_sql": """
SELECT t1.event_id, t2.s_name, t1.user_id
FROM events t1 INNER JOIN supplier t2 ON t1.user_id = t2.s_suppkey""",
    "json_get": "SELECT *, json_extract_string(props, '$.k') AS k FROM events",
    "hierarchy_enrich": _HIERARCHY,
    "hierarchy_enrich_hint": _HIERARCHY,
    "latest_snapshot": """
SELECT user_id, event_type, max(ts) AS latest_snap_date FROM events GROUP BY user_id, event_type""",
    "latest_snapshot_by_id": """
SELECT user_id, arg_max(event_type, ts) AS event_type, max(ts) AS latest_snap_date
FROM events GROUP BY user_id""",
    "indicator": """
SELECT e.*, coalesce(s.s_name, 'N') AS indicator
FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey""",
    "json_put": _JSON_PUT,
    "indicator_job": _JSON_PUT,
    # A NULL payload becomes a one-field object; anything that is not a JSON
    # object is kept and flagged. (Every page is HTML, so the object-upsert
    # branch, covered by "json_put", does not occur in this table.)
    "json_put_bad_payload": """
SELECT page_id, url,
       CASE WHEN html IS NULL THEN '{"url":' || to_json(url) || '}' ELSE html END AS html,
       (html IS NOT NULL AND NOT CASE WHEN json_valid(html) THEN json_type(html) = 'OBJECT' ELSE false END) AS _corrupt
FROM pages""",
    "merge_outer": _MERGE_OUTER,
    "merge_null_safe": _MERGE_NULL_SAFE,
    "merge_outer_plain": _MERGE_OUTER,
    "merge_null_safe_plain": _MERGE_NULL_SAFE,
    "expand_days": f"""
WITH {_EXPANDED}
SELECT o_orderkey, o_orderstatus, start_date, end_date,
       CAST(start_date + CAST(CASE WHEN end_date >= start_date THEN i ELSE -i END AS INTEGER) AS DATE) AS snap_date
FROM steps""",
    "span_job": f"""
WITH {_EXPANDED}
SELECT o_orderkey, o_orderstatus, start_date, end_date,
       CAST(start_date + CAST(CASE WHEN end_date >= start_date THEN i ELSE -i END AS INTEGER) AS DATE) AS snap_date
FROM steps""",
    "expand_days_keep_null": f"""
WITH {_EXPANDED}
SELECT o_orderkey, o_orderstatus, start_date, end_date,
       CAST(start_date + CAST(i AS INTEGER) AS DATE) AS snap_date
FROM steps WHERE end_date >= start_date
UNION ALL
SELECT o_orderkey, o_orderstatus, start_date, end_date, CAST(NULL AS DATE) AS snap_date
FROM spans WHERE NOT (end_date >= start_date) OR start_date IS NULL OR end_date IS NULL""",
    "expand_days_drop": f"""
WITH {_EXPANDED}
SELECT o_orderkey, o_orderstatus, start_date, end_date,
       CAST(start_date + CAST(i AS INTEGER) AS DATE) AS snap_date
FROM steps WHERE end_date >= start_date""",
    "span_bounds": f"""
WITH {_SPANS}
SELECT min(start_date) AS min_start_date, max(end_date) AS max_end_date FROM spans""",
    "span_bounds_shipdate": """
SELECT min(l_shipdate) AS min_start_date, max(l_shipdate) AS max_end_date FROM lineitem""",
    "join_profile": """
WITH per_key AS (
  SELECT o_custkey AS k, count(*) AS n,
         sum(8 + 8 * 6 + coalesce(strlen(o_orderstatus), 0) + coalesce(strlen(o_orderpriority), 0)) AS b
  FROM orders GROUP BY o_custkey)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
       count(k) AS keys,
       CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       CAST(max(n) FILTER (WHERE k IS NOT NULL) AS BIGINT) AS max_key_rows,
       72 AS row_width,
       CAST(coalesce(sum(n), 0) * 72 AS BIGINT) AS est_bytes,
       CAST(coalesce(sum(b), 0) AS BIGINT) AS data_bytes
FROM per_key""",
    "match_stats": f"""
WITH e AS ({_ENRICH_EVENTS})
SELECT 'supplier_name' AS "column", count(*) AS total_rows,
       count(*) FILTER (WHERE supplier_name IS NOT NULL AND supplier_name <> 'Not Defined') AS matched_rows
FROM e
UNION ALL
SELECT 'nation', count(*), count(*) FILTER (WHERE nation IS NOT NULL AND nation <> 'Not Defined')
FROM e""",
    "join_profile_approx": """
SELECT count(*) AS rows, count(*) FILTER (WHERE user_id IS NULL) AS null_keys, true AS keys_close FROM events""",
    "run_enrichment_merge": _RUN,
    "run_enrichment_chain": _RUN,
    "run_enrichment_restart": _RUN,
    "json_put_lossless": """
SELECT event_id, event_type,
       '{' || CASE WHEN event_id % 5 <> 4
              THEN '"n": 1.10, "big":12345678901234567890123 ,"in":{"k":[1, 2.50,"}"],"kind":"x"},"user": "' || user_id || '",' ELSE '' END
       || '"kind":"' || event_type || '"}' AS payload
FROM events""",
    "mixed_folder": """
SELECT * REPLACE (CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus,
                  CASE WHEN o_orderkey % 3 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate) FROM orders""",
    "union_profile": "SELECT count(*) AS rows, count(*) FILTER (WHERE user_id IS NULL) AS null_keys, true AS keys_close FROM events",
    "snapshot_state": "SELECT user_id, event_type, max(ts) AS latest_snap_date FROM events GROUP BY ALL",
    "snapshot_stream": """
SELECT user_id, r.t AS event_type, r.e AS event_id, latest_snap_date FROM (
  SELECT user_id, max({'d': CAST(ts AS DATE), 't': event_type, 'e': event_id}) AS r, max(CAST(ts AS DATE)) AS latest_snap_date
  FROM events GROUP BY user_id)""",
    "expand_days_chunks": """
WITH s AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey = 1 THEN 19999 WHEN o_orderstatus = 'F' THEN 3 WHEN o_orderstatus = 'O' THEN 0 ELSE -2 END AS INTEGER) AS end_date
  FROM orders)
SELECT s.*, CAST(d AS DATE) AS snap_date FROM s, unnest(generate_series(least(start_date, end_date), greatest(start_date, end_date), INTERVAL 1 DAY)) t(d)""",
    "versioned_overwrite": """
WITH s AS (SELECT * FROM (VALUES ('first'), ('after a failure'), ('second')) t(step))
SELECT o.*, step, CAST(count(*) OVER (PARTITION BY step) AS BIGINT) AS written FROM orders o, s WHERE step = 'second' OR o_orderstatus = 'F'""",
    "csv_quarantine": """
SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'bad' ELSE 'good' END AS kind,
       event_id || ',' || CASE event_type WHEN 'error' THEN 'u' ELSE '' END || user_id || ',' || CASE event_type WHEN 'signup' THEN 'signup,twice' ELSE event_type END AS line,
       count(*) OVER () AS lines
FROM events""",
    "advise_join": """
SELECT 'right' AS side, count(*) AS left_rows, count(*) AS profiled_left, (SELECT count(*) FROM supplier) AS profiled_right FROM events""",
    "table_scan": "SELECT * FROM supplier",
    "enrich_bucketed": """
SELECT l.*, coalesce(o.o_orderstatus, 'Not Defined') AS order_status, o.o_custkey AS customer
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus <> 'P'""",
    "frequent_keys": """
WITH k AS (
  SELECT 'documents.lang' AS "column", lang AS key FROM documents UNION ALL SELECT 'documents.source', source FROM documents
  UNION ALL SELECT 'events.event_type', event_type FROM events UNION ALL SELECT 'lineitem.l_orderkey', CAST(l_orderkey AS VARCHAR) FROM lineitem),
n AS (SELECT "column", count(*) AS total FROM k GROUP BY ALL)
SELECT "column", key, count(*) AS rows, total FROM k JOIN n USING ("column") WHERE key IS NOT NULL
GROUP BY ALL HAVING count(*) >= 0.01 * total""",
    "enrich_split": """
WITH e AS (
  SELECT * REPLACE (CASE WHEN event_type IN ('error', 'view') THEN 1 WHEN event_type <> 'signup' THEN user_id END AS user_id) FROM events)
SELECT e.*, coalesce(s.s_name, 'Not Defined') AS supplier_name, coalesce(CAST(s.s_nationkey AS VARCHAR), 'Not Defined') AS nation
FROM e LEFT JOIN supplier s ON e.user_id = s.s_suppkey""",
    "csv_text_round_trip": "SELECT doc_id, text, n_chars FROM documents",
    "enrich_sql_typed": """
WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN 'no number' ELSE CAST(user_id AS VARCHAR) END AS user_text FROM events)
SELECT e.*, coalesce(CAST(s.s_nationkey AS VARCHAR), 'Not Defined') AS nation
FROM e LEFT JOIN supplier s ON TRY_CAST(e.user_text AS BIGINT) = s.s_suppkey""",
    "json_put_mixed": """
SELECT event_id, event_type,
       CASE event_id % 7
         WHEN 0 THEN '{"k":"' || json_extract_string(props, '$.k') || '","kind":"' || event_type || '"}'
         WHEN 1 THEN '{"kind":"' || event_type || '"}'
         WHEN 2 THEN '<p>' || user_id
         WHEN 3 THEN props || ' tail'
         WHEN 6 THEN '{"a":"{\\"b\\":' || user_id || '}","kind":"' || event_type || '"}'
         ELSE '{"a":"' || user_id || '","kind":"' || event_type || '"}' END AS payload,
       event_id % 7 IN (2, 3) AS _corrupt
FROM events""",
    "merge_wide": _MERGE_WIDE,
    "merge_repeats": """
WITH a AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT s_suppkey + 60 AS user_id, s_nationkey AS nation FROM supplier),
b AS (SELECT * FROM s UNION ALL SELECT user_id, -1 FROM s UNION ALL SELECT NULL, nation FROM s)
SELECT coalesce(a.user_id, b.user_id) AS user_id, event_type, n, nation FROM a FULL JOIN b ON a.user_id = b.user_id""",
    "latest_snapshot_three": """
SELECT user_id, r.t AS event_type, r.e AS event_id, latest_snap_date FROM (
  SELECT user_id, max({'d': CAST(ts AS DATE), 't': event_type, 'e': event_id}) AS r, max(CAST(ts AS DATE)) AS latest_snap_date
  FROM events GROUP BY user_id)""",
    "source_profile": f"{_WITH_PROFILE}\nSELECT * FROM ep",
    "enrich_frame_merge": _EVENT_FRAME,
    "enrich_frame_chain": _EVENT_FRAME,
    "enrich_stream_chain": _EVENT_FRAME,
    "enrich_frame_by_source": f"""
{_WITH_PROFILE},
k AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN concat_ws('|', {_n('event_type')})
                 ELSE concat_ws('|', {_n('event_type')}, {_n('user_id')}) END AS JoinKey
  FROM ep),
act AS (
  SELECT concat_ws('|', 'PURCHASE', {_n('c_custkey')}) AS JoinKey, c_mktsegment, c_name
  FROM customer),
s AS (SELECT o_custkey, max(o_orderdate) AS latest_snap_date FROM orders GROUP BY o_custkey)
SELECT k.*, coalesce(act.c_mktsegment, 'Not Defined') AS Center,
       coalesce(act.c_name, 'Not Defined') AS Capacity_Planning_Group,
       json_extract_string(k.props, '$.k') AS employee_number, s.o_custkey, s.latest_snap_date
FROM k
LEFT JOIN act ON k.include_activity AND k.JoinKey = act.JoinKey
LEFT JOIN s ON k.include_hierarchy AND TRY_CAST(json_extract_string(k.props, '$.k') AS BIGINT) = s.o_custkey""",
}

# Queries without an oracle: none.
NO_ORACLE: set[str] = set()
