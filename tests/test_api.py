import pytest

from skylight import api
from skylight.sources.fixtures import Views

from conftest import SF_SMALL


def test_logs_request_defaults_and_total(spark):
    v = Views(spark, SF_SMALL)
    req = {"startTime": "2024-01-01T00:00:00Z", "endTime": "2024-01-31T00:00:00Z", "searchScope": {"namespace": "ns-1"}}
    res = api.query_logs(v.logs(), req)
    rows = res.rows.collect()
    total = res.total.collect()[0].total
    assert len(rows) == min(100, total)
    assert [r.ts for r in rows] == sorted([r.ts for r in rows], reverse=True)


def test_workflow_request(spark):
    v = Views(spark, SF_SMALL)
    req = {"startTime": "2024-01-01", "endTime": "2024-01-31", "sortOrder": "asc",
           "searchScope": {"namespace": "ns-0", "workflowRunName": "run-3"}}
    res = api.query_logs(v.logs(), req)
    rows = res.rows.collect()
    assert all(r.pod_name.startswith("run-3") and r.container_name not in ("init", "wait") for r in rows)


def test_traces_request_and_validation(spark):
    v = Views(spark, SF_SMALL)
    req = {"startTime": "2024-01-01", "endTime": "2024-01-31", "limit": 5, "searchScope": {"namespace": "ns-1"}}
    assert api.query_traces(v.spans(), req).rows.count() <= 5
    with pytest.raises(api.BadRequest):
        api.query_traces(v.spans(), {"startTime": "2024-01-02", "endTime": "2024-01-01",
                                     "searchScope": {"namespace": "ns-1"}})
    with pytest.raises(api.BadRequest):
        api.query_traces(v.spans(), {"startTime": "2024-01-01", "endTime": "2024-01-02", "searchScope": {}})


def test_metrics_request(spark):
    v = Views(spark, SF_SMALL)
    tables = {"cpu": v.cpu_samples(), "gauges": v.gauge_samples(), "pods": v.pods()}
    req = {"metric": "resource", "startTime": "2024-01-03", "endTime": "2024-01-10", "step": "6h",
           "searchScope": {"namespace": "ns-1"}}
    out = api.query_metrics(tables, req).rows
    assert set(r.series for r in out.select("series").distinct().collect()) <= {
        "cpu_usage", "cpu_requests", "cpu_limits", "memory_usage", "memory_requests", "memory_limits"}
    with pytest.raises(api.BadRequest):
        api.query_metrics(tables, dict(req, metric="disk"))


def test_span_lookup_not_found(spark):
    v = Views(spark, SF_SMALL)
    first = v.spans().select("trace_id", "span_id").orderBy("span_id").first()
    assert api.get_span(v.spans(), first.trace_id, first.span_id).span_id == first.span_id
    with pytest.raises(api.NotFound):
        api.get_span(v.spans(), first.trace_id, "span-missing")


def test_trace_spans_request_and_webhooks(spark):
    v = Views(spark, SF_SMALL)
    tid = v.spans().select("trace_id").orderBy("trace_id").first().trace_id
    ns = v.spans().filter(f"trace_id = '{tid}'").select("namespace").first().namespace
    req = {"startTime": "2024-01-01", "endTime": "2024-02-01", "includeAttributes": True,
           "searchScope": {"namespace": ns}}
    res = api.query_trace_spans(v.spans(), tid, req)
    rows = res.rows.collect()
    assert rows and all(r.trace_id == tid for r in rows) and "attributes" in res.rows.columns
    assert res.total.collect()[0].span_count >= len(rows)
    hooks = api.receive_alert_webhooks(v.webhooks(), v.rules())
    got = hooks.rows.collect()
    assert got and all(r.rule_namespace for r in got)
    # resolved alerts in the metrics shape are skipped, not rejected
    assert hooks.total.count() == 0
