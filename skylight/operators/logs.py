"""Log search operators.

A search is one lazy plan: scan -> conjunctive filter (pushed into the
parquet reader, day partitions pruned) -> TakeOrderedAndProject.  The total
count (L14) is a second aggregate over the same filter; it reads only the
filter columns.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylight.functions.labels import COMPONENT_UID, ENVIRONMENT_UID, NAMESPACE, PROJECT_UID, log_label_key
from skylight.functions.levels import effective_level, level_from_text
from skylight.functions.scope import Scope
from skylight.functions.timeutil import rfc3339, ts_lit

DEFAULT_LIMIT = 100
WORKFLOW_NS_PREFIX = "workflows-"
# Workflow side-car containers that are never shown.
WORKFLOW_EXCLUDED_CONTAINERS = ("init", "wait")


def time_range_exclusive(start, end, col: str = "ts") -> Column:
    """L2: ``start < ts < end``; no bound when either end is empty."""
    if not start or not end:
        return F.lit(True)
    return (F.col(col) > ts_lit(start)) & (F.col(col) < ts_lit(end))


def time_range_half_open(start, end, col: str = "ts") -> Column:
    """SQL-store bounds: ``start <= ts < end``."""
    return (F.col(col) >= ts_lit(start)) & (F.col(col) < ts_lit(end))


def day_prune(start, end, day_col: str = "log_date") -> Column:
    """The day partitions touched by [start, end].  Catalyst cannot
    derive this from the ``ts`` bounds, so it is stated next to them."""
    return (F.col(day_col) >= ts_lit(start).cast("date")) & (F.col(day_col) <= ts_lit(end).cast("date"))


def phrase_literal(phrase: str | None, col: str = "log") -> Column:
    """L4: case-sensitive substring; wildcard characters are literal."""
    if not phrase:
        return F.lit(True)
    return F.coalesce(F.col(col).contains(F.lit(phrase)), F.lit(False))


def phrase_like(phrase: str | None, col: str = "log") -> Column:
    """``LIKE '%phrase%'``; ``%`` and ``_`` inside the phrase stay wildcards,
    only the backslash is taken literally."""
    if not phrase:
        return F.lit(True)
    pattern = "%" + phrase.replace("\\", "\\\\") + "%"
    return F.coalesce(F.col(col).like(pattern), F.lit(False))


def levels_in_text(levels: Sequence[str] | None, col: str = "log") -> Column:
    """Any requested level appears anywhere in the text, any case."""
    if not levels:
        return F.lit(True)
    up = F.upper(F.col(col))
    cond = F.lit(False)
    for lvl in levels:
        cond = cond | F.coalesce(up.contains(lvl.upper()), F.lit(False))
    return cond


def levels_in_column(levels: Sequence[str] | None, col: str = "log_level") -> Column:
    """The stored level equals one of the requested levels."""
    if not levels:
        return F.lit(True)
    return F.coalesce(F.col(col).isin(list(levels)), F.lit(False))


def _order(df: DataFrame, order: str, limit: int | None, ts_col: str = "ts",
           tie: str = "event_id") -> DataFrame:
    """Ascending only when asked; a limit <= 0 becomes 100."""
    if limit is None or limit <= 0:
        limit = DEFAULT_LIMIT
    key = F.col(ts_col).asc() if order == "asc" else F.col(ts_col).desc()
    return df.orderBy(key, F.col(tie).asc()).limit(limit)


ENTRY_COLUMNS = ("event_id", "ts", "log", "log_level", "namespace", "project_uid", "environment_uid",
                 "component_uid", "pod_name", "pod_namespace", "container_name")


def component_filter(scope: Scope, start, end, phrase: str | None = None,
                     levels: Sequence[str] | None = None, store: str = "search",
                     prune_days: bool = True) -> Column:
    """L1/L3 filter.  ``store="search"``: exclusive time bounds, literal
    phrase, levels found in the text.  ``store="sql"``: [start, end),
    LIKE phrase, levels compared with the stored column."""
    cond = scope.predicate()
    if store == "search":
        cond = cond & time_range_exclusive(start, end) & phrase_literal(phrase) & levels_in_text(levels)
    else:
        cond = cond & time_range_half_open(start, end) & phrase_like(phrase) & levels_in_column(levels)
    if prune_days and start and end:
        cond = cond & day_prune(start, end)
    return cond


def search_logs(logs: DataFrame, scope: Scope, start, end, phrase: str | None = None,
                levels: Sequence[str] | None = None, limit: int = DEFAULT_LIMIT, order: str = "desc",
                store: str = "search") -> DataFrame:
    """L1: component log search, newest first by default, with the level
    each variant reports."""
    f = logs.filter(component_filter(scope, start, end, phrase, levels, store))
    lvl = level_from_text("log", "search") if store == "search" else effective_level("log", "log_level")
    out = f.select(*[c for c in ENTRY_COLUMNS if c != "log_level"], lvl.alias("level"))
    return _order(out, order, limit)


def count_logs(logs: DataFrame, cond: Column) -> DataFrame:
    """Exact total of matches as a one-row aggregate."""
    return logs.filter(cond).agg(F.count(F.lit(1)).alias("total"))


def workflow_prefix_filter(run_id: str, namespace: str | None, start=None, end=None,
                           step: str | None = None) -> Column:
    """Pod name starts with the run id, optional step substring,
    namespace ``workflows-<ns>``, side-car containers excluded."""
    cond = F.col("pod_name").startswith(run_id)
    if step:
        cond = cond & F.coalesce(F.col("step_name").contains(step), F.lit(False))
    if start and end:
        cond = cond & time_range_exclusive(start, end) & day_prune(start, end)
    if namespace:
        cond = cond & (F.col("pod_namespace") == F.lit(WORKFLOW_NS_PREFIX + namespace))
    cond = cond & ~F.col("container_name").isin(*WORKFLOW_EXCLUDED_CONTAINERS)
    return cond


def workflow_logs_by_prefix(logs: DataFrame, run_id: str, namespace: str, start, end,
                            step: str | None = None, limit: int = DEFAULT_LIMIT,
                            order: str = "desc") -> DataFrame:
    """L11 search-store workflow logs; phrase and levels are not applied."""
    f = logs.filter(workflow_prefix_filter(run_id, namespace, start, end, step))
    out = f.select("event_id", "ts", "log", "pod_name", "container_name",
                   level_from_text("log", "search").alias("level"))
    return _order(out, order, limit)


def workflow_label_filter(run_id: str, namespace: str, start, end, phrase: str | None = None,
                          levels: Sequence[str] | None = None) -> Column:
    return ((F.col("workflow_run") == F.lit(run_id))
            & (F.col("pod_namespace") == F.lit(WORKFLOW_NS_PREFIX + namespace))
            & time_range_half_open(start, end) & day_prune(start, end)
            & phrase_like(phrase) & levels_in_column(levels))


def workflow_logs_by_label(logs: DataFrame, run_id: str, namespace: str, start, end,
                           phrase: str | None = None, levels: Sequence[str] | None = None,
                           limit: int = DEFAULT_LIMIT, order: str = "desc") -> DataFrame:
    """L12 SQL-store workflow logs: run label equality, phrase and levels honoured."""
    f = logs.filter(workflow_label_filter(run_id, namespace, start, end, phrase, levels))
    out = f.select("event_id", "ts", "log", "pod_name", "container_name",
                   effective_level("log", "log_level").alias("level"))
    return _order(out, order, limit)


def workflow_metadata(logs: DataFrame, keep: Sequence[str] = ("ts", "log")) -> DataFrame:
    """Every column besides ``keep`` goes into a string metadata map
    (NULL values left out)."""
    others = [c for c in logs.columns if c not in keep]
    entries = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in others])
    kept = F.filter(entries, lambda e: e["v"].isNotNull())
    return logs.select(*keep, F.map_from_entries(
        F.transform(kept, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))).alias("metadata"))


def to_log_documents(logs: DataFrame) -> DataFrame:
    """Nested log documents (D1) as a shipper would index them: RFC 3339 time
    string, ``kubernetes`` struct with a normalised label map."""
    labels = F.create_map(
        F.lit(log_label_key(COMPONENT_UID)), F.col("component_uid"),
        F.lit(log_label_key(ENVIRONMENT_UID)), F.col("environment_uid"),
        F.lit(log_label_key(PROJECT_UID)), F.col("project_uid"),
        F.lit(log_label_key(NAMESPACE)), F.col("namespace"))
    return logs.select(
        "event_id",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("@timestamp"),
        "log",
        F.struct(F.col("pod_namespace").alias("namespace_name"), F.col("pod_name").alias("pod_name"),
                 F.col("container_name").alias("container_name"), labels.alias("labels")).alias("kubernetes"),
    )


def project_entries(docs: DataFrame) -> DataFrame:
    """Nested hit -> flat typed entry; a missing field becomes empty, the
    time is parsed strictly (unparseable -> NULL), the level extracted."""
    lab = F.col("kubernetes.labels")

    def s(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    ts = rfc3339(F.col("`@timestamp`"))
    return docs.select(
        "event_id",
        ts.alias("ts"),
        s(F.col("log")).alias("log"),
        level_from_text(s(F.col("log")), "search").alias("level"),
        s(lab[log_label_key(COMPONENT_UID)]).alias("component_uid"),
        s(lab[log_label_key(ENVIRONMENT_UID)]).alias("environment_uid"),
        s(lab[log_label_key(PROJECT_UID)]).alias("project_uid"),
        s(lab[log_label_key(NAMESPACE)]).alias("namespace"),
        s(F.col("kubernetes.namespace_name")).alias("pod_namespace"),
        s(F.col("kubernetes.pod_name")).alias("pod_name"),
        s(F.col("kubernetes.container_name")).alias("container_name"),
    )
