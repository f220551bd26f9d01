"""Request-shaped entry points.

The reference answers four kinds of request (logs, traces, metrics, alert
webhooks) with a JSON body.  These functions take the same fields as a
Python mapping and return lazy DataFrames built from the operators; the
defaults and validation follow the reference's handlers (page of 100 logs,
20 traces, step 5 minutes, namespace mandatory, end not before start).
Nothing here parses query text: a request is only a set of parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Mapping

from pyspark.sql import DataFrame

from skylight.functions.scope import Scope
from skylight.functions.timeutil import parse_ts
from skylight.operators import alerts as A
from skylight.operators import logs as L
from skylight.operators import metrics as M
from skylight.operators import resources as R
from skylight.operators import traces as T


class BadRequest(ValueError):
    """The request is rejected before any Spark work (HTTP 400 in the reference)."""


class NotFound(LookupError):
    """The requested object does not exist (HTTP 404 in the reference)."""


@dataclass
class Result:
    rows: DataFrame
    total: DataFrame | None = None


def _scope(req: Mapping[str, Any]) -> Scope:
    sc = req.get("searchScope") or {}
    ns = sc.get("namespace")
    if not ns:
        raise BadRequest("searchScope.namespace is required")
    return Scope(ns, project=sc.get("project") or None, component=sc.get("component") or None,
                 environment=sc.get("environment") or None)


def _range(req: Mapping[str, Any]):
    s, e = req.get("startTime"), req.get("endTime")
    if not s or not e:
        raise BadRequest("startTime and endTime are required")
    if parse_ts(e) < parse_ts(s):
        raise BadRequest("endTime must not be before startTime")
    return s, e


def _order(req: Mapping[str, Any]) -> str:
    o = (req.get("sortOrder") or "desc").lower()
    if o not in ("asc", "desc"):
        raise BadRequest("sortOrder must be asc or desc")
    return o


def query_logs(logs: DataFrame, req: Mapping[str, Any], store: str = "search") -> Result:
    """Component logs (``searchScope`` with namespace / project /
    component / environment) or workflow-run logs (``searchScope`` with
    ``workflowRunName``).  Returns the page and, as a second plan, the total."""
    s, e = _range(req)
    sc = req.get("searchScope") or {}
    limit = int(req.get("limit") or 0)
    order = _order(req)
    if sc.get("workflowRunName"):
        ns = sc.get("namespace")
        if not ns:
            raise BadRequest("searchScope.namespace is required")
        run = sc["workflowRunName"]
        if store == "search":
            rows = L.workflow_logs_by_prefix(logs, run, ns, s, e, step=sc.get("stepName"), limit=limit, order=order)
            total = L.count_logs(logs, L.workflow_prefix_filter(run, ns, s, e, sc.get("stepName")))
        else:
            rows = L.workflow_logs_by_label(logs, run, ns, s, e, req.get("searchPhrase"), req.get("logLevels"),
                                            limit=limit, order=order)
            total = L.count_logs(logs, L.workflow_label_filter(run, ns, s, e, req.get("searchPhrase"),
                                                               req.get("logLevels")))
        return Result(rows, total)
    scope = _scope(req)
    rows = L.search_logs(logs, scope, s, e, req.get("searchPhrase"), req.get("logLevels"), limit=limit,
                         order=order, store=store)
    total = L.count_logs(logs, L.component_filter(scope, s, e, req.get("searchPhrase"), req.get("logLevels"), store))
    return Result(rows, total)


def query_traces(spans: DataFrame, req: Mapping[str, Any], store: str = "search") -> Result:
    """Trace list with total (search store: trace-limited aggregation,
    approximate capped total; SQL store: span page then grouping, exact total)."""
    s, e = _range(req)
    scope = _scope(req)
    limit = int(req.get("limit") or 0)
    if store == "search":
        rows = T.list_traces(spans, scope, s, e, limit=limit, order=_order(req))
        total = T.trace_total(spans, scope, s, e, exact=False)
    else:
        rows = T.list_traces_span_page(spans, scope, s, e, limit=limit)
        total = T.trace_total_exact(spans, scope, s, e)
    return Result(rows, total)


def query_trace_spans(spans: DataFrame, trace_id: str, req: Mapping[str, Any]) -> Result:
    """Spans of one trace (search-store variant), attributes only when asked."""
    s, e = _range(req)
    rows = T.trace_spans(spans, trace_id, _scope(req), s, e, limit=int(req.get("limit") or 0),
                         with_attributes=bool(req.get("includeAttributes")))
    return Result(rows, T.span_total(spans, trace_id, _scope(req), s, e))


def get_span(spans: DataFrame, trace_id: str, span_id: str):
    """One span by (trace, span), no time bound; a missing span is an
    error.  Reads at most one row."""
    rows = T.span_detail(spans, trace_id, span_id).take(1)
    if not rows:
        raise NotFound(f"span {span_id} of trace {trace_id} not found")
    return rows[0]


def query_metrics(tables: Mapping[str, DataFrame], req: Mapping[str, Any]) -> Result:
    """``metric`` is ``resource`` (six series) or ``http`` (seven series),
    evaluated on the grid start..end by ``step`` (default 5 minutes)."""
    s, e = _range(req)
    scope = _scope(req)
    step = req.get("step") or "5m"
    from skylight.functions.timeutil import go_duration_seconds
    step_s = go_duration_seconds(step) if isinstance(step, str) else float(step)
    if not step_s or step_s <= 0:
        raise BadRequest("step must be a positive duration")
    grid = M.Grid.of(s, e, step_s)
    kind = req.get("metric")
    if kind == "resource":
        rows = R.resource_metrics(tables["cpu"], tables["gauges"], tables["pods"], scope, grid)
    elif kind == "http":
        rows = R.http_metrics(tables["http"], tables["latency_sum"], tables["buckets"], tables["pods"], scope, grid)
    else:
        raise BadRequest("metric must be resource or http")
    return Result(rows)


def receive_alert_webhooks(hooks: DataFrame, rules: DataFrame | None = None) -> Result:
    """Normalise webhook payloads of the three shapes; events without a
    namespace take their rule's.  ``total`` holds the rejected payloads."""
    ok, bad = A.normalize_webhooks(hooks)
    if rules is not None:
        ok = A.namespace_lookup(ok, rules)
    return Result(ok, bad)
