"""Trace and span operators.

Spans are rows ``(trace_id, span_id, parent_span_id, name, kind,
status_code, start_ns, end_ns, start_ts, scope ids, ...)``.  Trace
roll-ups are one aggregation keyed by ``trace_id`` with a map-side partial
step (so a trace with millions of spans costs one buffer per task, then one
row in the shuffle); the root is a struct minimum, so Spark runs it
sort-based, which spills instead of failing on large groups.  Pages are a
top-k that never sorts the full result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylight.functions.scope import Scope
from skylight.functions.timeutil import epoch_micros, long_lit, ts_lit

DEFAULT_TRACE_LIMIT = 20
DEFAULT_SPAN_LIMIT = 100
MAX_SPAN_LIMIT = 1000
MAX_TRACE_TOTAL = 10000


def normalize_status(col: str | Column = "status_code") -> Column:
    """``ok`` / ``error`` in any case, anything else ``unset``."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    return F.when(c.isin("ok", "error"), c).otherwise(F.lit("unset"))


def span_duration(start: str = "start_ns", end: str = "end_ns") -> Column:
    """End - start in ns, 0 when either is missing."""
    return F.coalesce(F.col(end) - F.col(start), F.lit(0).cast("bigint"))


def is_error(col: str = "status_code") -> Column:
    """T4: a span is an error when its status is ``error`` in any case."""
    return F.coalesce(F.lower(F.col(col)) == F.lit("error"), F.lit(False))


def _ns(ts) -> Column:
    return long_lit(epoch_micros(ts) * 1000)


def time_contained(start, end) -> Column:
    """Spans that start at/after ``start`` and end at/before ``end``.

    The start bound is stated on the raw timestamp so it reaches the parquet
    reader; the day column (the start's UTC day) gives partition pruning.
    """
    s, e = ts_lit(start), ts_lit(end)
    return ((F.col("start_ts") >= s) & (F.col("end_ns") <= _ns(end))
            & (F.col("span_date") >= s.cast("date")) & (F.col("span_date") <= e.cast("date")))


def scoped_spans(spans: DataFrame, scope: Scope | None, start=None, end=None) -> DataFrame:
    """Scope filter (component ids OR-ed, equality on the rest) + time."""
    out = spans
    if scope is not None:
        out = out.filter(scope.predicate())
    if start is not None and end is not None:
        out = out.filter(time_contained(start, end))
    return out


def rollup_traces(spans: DataFrame) -> DataFrame:
    """T1/T2/T4 roll-up of any span set: one row per trace.

    Root (T2) = earliest span whose parent is ``""`` (ties by span id), else
    the earliest span.  Both are ``min`` over a struct ordered by
    ``(start_ns, span_id)``: decomposable, so partial aggregation applies.
    """
    ordered = F.struct(F.col("start_ns"), F.col("span_id"), F.col("name"), F.col("kind"))
    root_cand = F.when(F.col("parent_span_id") == F.lit(""), ordered)
    agg = spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("span_count"),
        F.min("start_ns").alias("start_ns"),
        F.max("end_ns").alias("end_ns"),
        F.min(root_cand).alias("_root"),
        F.min(ordered).alias("_first"),
        F.max(is_error().cast("int")).alias("_err"),
    )
    root = F.coalesce(F.col("_root"), F.col("_first"))
    return agg.select(
        "trace_id",
        root.getField("name").alias("trace_name"),
        "span_count",
        root.getField("span_id").alias("root_span_id"),
        root.getField("name").alias("root_span_name"),
        root.getField("kind").alias("root_span_kind"),
        "start_ns", "end_ns",
        (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"),
        (F.col("_err") > 0).alias("has_errors"),
    )


def list_traces(spans: DataFrame, scope: Scope, start, end, limit: int = DEFAULT_TRACE_LIMIT,
                order: str = "desc") -> DataFrame:
    """Traces in scope and time, ordered by earliest start, top ``limit``."""
    if limit is None or limit <= 0:
        limit = DEFAULT_TRACE_LIMIT
    traces = rollup_traces(scoped_spans(spans, scope, start, end))
    key = F.col("start_ns").asc() if order == "asc" else F.col("start_ns").desc()
    return traces.orderBy(key, F.col("trace_id").asc()).limit(limit)


def trace_total(spans: DataFrame, scope: Scope, start, end, exact: bool = False,
                cap: int | None = MAX_TRACE_TOTAL) -> DataFrame:
    """T5: distinct traces, reported up to ``cap`` (None: no cap); ``exact=False`` uses HLL++ like the
    search store's cardinality aggregation."""
    s = scoped_spans(spans, scope, start, end)
    n = F.count_distinct("trace_id") if exact else F.approx_count_distinct("trace_id")
    n = n.cast("bigint")
    return s.agg((n if cap is None else F.least(n, long_lit(cap))).alias("total"))


def trace_total_exact(spans: DataFrame, scope: Scope, start, end) -> DataFrame:
    """Exact ``count(distinct trace_id)`` in scope (store bounds [start, end))."""
    s = spans.filter(scope.predicate()).filter(
        (F.col("start_ts") >= ts_lit(start)) & (F.col("start_ts") < ts_lit(end)))
    return s.agg(F.count_distinct("trace_id").alias("total"))


def list_traces_span_page(spans: DataFrame, scope: Scope, start, end,
                          limit: int = DEFAULT_SPAN_LIMIT, cap: int | None = MAX_SPAN_LIMIT) -> DataFrame:
    """Take a page of spans first (newest first), then group that page.

    Counts cover the page only; a span whose parent is empty or NULL is a
    root and the last one seen in page order wins; traces come out in
    first-seen order; blank trace ids are skipped.  The page is the feature:
    ``limit`` spans, at most ``cap`` (None: no cap), so everything after the
    top-k is as small as the page.
    """
    if limit is None or limit <= 0:
        limit = DEFAULT_SPAN_LIMIT
    limit = limit if cap is None else min(limit, cap)
    s = spans.filter(scope.predicate(with_namespace=True)).filter(
        (F.col("start_ts") >= ts_lit(start)) & (F.col("start_ts") < ts_lit(end)))
    page = s.orderBy(F.col("start_ns").desc(), F.col("span_id").asc()).limit(limit)
    w = Window.orderBy(F.col("start_ns").desc(), F.col("span_id").asc())
    # the page holds at most `limit` rows, so this global window is bounded
    ranked = page.withColumn("rn", F.row_number().over(w).cast("bigint")).filter(
        F.col("trace_id").isNotNull() & (F.trim(F.col("trace_id")) != ""))
    is_root = F.col("parent_span_id").isNull() | (F.col("parent_span_id") == "")
    root = F.when(is_root, F.struct(F.col("rn"), F.col("span_id"), F.col("name"), F.col("kind")))
    g = ranked.groupBy("trace_id").agg(
        F.min("rn").alias("first_seen"),
        F.count(F.lit(1)).alias("span_count"),
        F.min("start_ns").alias("start_ns"),
        F.max("end_ns").alias("end_ns"),
        F.max(root).alias("_root"),
        F.max(is_error().cast("int")).alias("_err"),
    )
    return g.select(
        "trace_id", "first_seen", "span_count",
        F.col("_root.span_id").alias("root_span_id"),
        F.col("_root.name").alias("root_span_name"),
        F.col("_root.kind").alias("root_span_kind"),
        "start_ns", "end_ns", (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"),
        (F.col("_err") > 0).alias("has_errors"),
    )


def trace_spans(spans: DataFrame, trace_id: str, scope: Scope | None = None, start=None, end=None,
                limit: int = DEFAULT_TRACE_LIMIT, with_attributes: bool = False) -> DataFrame:
    """T7 (search variant) / T13: spans of a trace by start time; the trace id
    is a literal match; attribute maps only when asked."""
    s = spans.filter(F.col("trace_id") == F.lit(trace_id))
    s = scoped_spans(s, scope, start, end)
    cols = ["span_id", "trace_id", "parent_span_id", "name", "kind", "start_ns", "end_ns",
            span_duration().alias("duration_ns"), normalize_status().alias("status")]
    if with_attributes:
        cols.append(span_attribute_map(s.columns).alias("attributes"))
    if limit is None or limit <= 0:
        limit = DEFAULT_TRACE_LIMIT
    return s.select(*cols).orderBy("start_ns", "span_id").limit(limit)


def trace_spans_page(spans: DataFrame, trace_id: str, start, end,
                     limit: int = DEFAULT_SPAN_LIMIT, cap: int | None = MAX_SPAN_LIMIT) -> DataFrame:
    """T7 (SQL-store variant): trace id and store time bounds only, one page of
    ``limit`` spans, at most ``cap`` (None: no cap)."""
    if limit is None or limit <= 0:
        limit = DEFAULT_SPAN_LIMIT
    limit = limit if cap is None else min(limit, cap)
    s = spans.filter((F.col("trace_id") == F.lit(trace_id))
                     & (F.col("start_ts") >= ts_lit(start)) & (F.col("start_ts") < ts_lit(end)))
    return (s.select("span_id", "trace_id", "parent_span_id", "name", "kind", "start_ns", "end_ns",
                     span_duration().alias("duration_ns"), normalize_status().alias("status"))
            .orderBy("start_ns", "span_id").limit(limit))


def span_total(spans: DataFrame, trace_id: str, scope: Scope | None = None, start=None, end=None) -> DataFrame:
    """Number of spans in a trace, within the scope and time of the page
    it belongs to."""
    s = scoped_spans(spans.filter(F.col("trace_id") == F.lit(trace_id)), scope, start, end)
    return s.agg(F.count(F.lit(1)).alias("span_count"))


def span_detail(spans: DataFrame, trace_id: str, span_id: str) -> DataFrame:
    """One span by (trace, span), no time bound.  Empty result = not found."""
    s = spans.filter((F.col("trace_id") == F.lit(trace_id)) & (F.col("span_id") == F.lit(span_id)))
    return (s.select("trace_id", "span_id", "parent_span_id", "name", "kind", "start_ns", "end_ns",
                     span_duration().alias("duration_ns"), normalize_status().alias("status"))
            .orderBy("span_id").limit(1))


# Span fields that are not attributes in the flat span store.
INTERNAL_SPAN_FIELDS = (
    "_timestamp", "span_id", "operation_name", "span_kind", "start_time", "end_time", "duration",
    "parent_span_id", "reference_parent_span_id", "trace_id", "span_status",
)

RESOURCE_PREFIXES = ("service", "resource")


ATTRIBUTE_FIELDS = ("namespace", "project_uid", "environment_uid", "component_uid", "props",
                    "service_name", "resource_host")


def span_attribute_map(columns, exclude: tuple = ()) -> Column:
    """The span's attribute columns that are present, as a string map."""
    fields = [f for f in ATTRIBUTE_FIELDS if f in columns and f not in exclude]
    return F.map_from_entries(F.array(*[
        F.struct(F.lit(f).alias("key"), F.col(f).cast("string").alias("value")) for f in fields]))


def unpivot_attributes(df: DataFrame, id_cols: list[str], attr_cols: list[str]) -> DataFrame:
    """One row per (span, key, value-as-string); NULL values dropped;
    keys starting ``service`` or ``resource`` are resource attributes."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                      for c in attr_cols if c not in INTERNAL_SPAN_FIELDS])
    out = df.select(*id_cols, F.explode(pairs).alias("kv")).select(
        *id_cols, F.col("kv.key").alias("attr_key"), F.col("kv.value").alias("attr_value"))
    out = out.filter(F.col("attr_value").isNotNull())
    is_res = F.lit(False)
    for p in RESOURCE_PREFIXES:
        is_res = is_res | F.col("attr_key").startswith(p)
    return out.withColumn("is_resource", is_res)
