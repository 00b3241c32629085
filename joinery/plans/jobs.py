"""Small composite jobs: the indicator tagging job (W4) and the span-expansion
job (W5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import expand_days, json_put, span_bounds, with_indicator
from ..sources import SchemaLike, scan, write_csv


def tag_json_with_indicator(
    df: DataFrame,
    lookup: DataFrame,
    on: str | tuple[str, str],
    code: str,
    json_col: str,
    field: str,
    missing: str = "N",
    on_bad: str = "keep",
    strategy: str = "catalyst",
) -> DataFrame:
    """Indicator column ``field`` from a left join on ``on`` (the lookup's
    ``code``, else ``missing``), then the same value upserted into the JSON text
    column ``json_col``. One left join and one projection."""
    flagged = with_indicator(df, lookup, on, code, out=field, missing=missing, strategy=strategy)
    return json_put(flagged, json_col, field, field, on_bad=on_bad)


def span_expansion_job(
    spark: SparkSession,
    source: str | DataFrame,
    schema: SchemaLike,
    start: str = "StartDate",
    end: str = "EndDate",
    out: str = "snap_date",
    output_path: str | None = None,
    on_reversed: str = "keep",
) -> tuple[Row, DataFrame]:
    """Read spans (CSV needs ``schema``, e.g. a DDL string), compute the overall
    bounds, expand every row to one row per day and, when ``output_path`` is set,
    write the expansion as CSV with a header.

    Returns the bounds row (``min_start_date``, ``max_end_date``) and the expanded
    frame: lazy, or read back from the written file. With an output the bounds are
    observed while it is written, so the source is read once."""
    spans = scan(spark, source, schema)
    if not output_path:
        return span_bounds(spans, start, end).first(), expand_days(spans, start, end, out=out, on_reversed=on_reversed)
    seen = Observation()
    spans = spans.observe(seen, F.min(start).alias("min_start_date"), F.max(end).alias("max_end_date"))
    expanded = expand_days(spans, start, end, out=out, on_reversed=on_reversed)
    write_csv(expanded, output_path)
    return Row(**seen.get), scan(spark, output_path, expanded.schema, format="csv")
