import datetime as dt

from skylight.functions.scope import Scope
from skylight.operators import traces as T

SCHEMA = ("trace_id string, span_id string, parent_span_id string, name string, kind string, status_code string, "
          "start_ns long, end_ns long, start_ts timestamp_ntz, span_date date, namespace string, project_uid string, "
          "environment_uid string, component_uid string")


def _span(trace, span, parent, name, start_s, end_s, status=None, ns="ns", comp="c1"):
    ts = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=start_s)
    return (trace, span, parent, name, "SERVER", status, int(start_s * 1e9) + 1704067200 * 10**9,
            int(end_s * 1e9) + 1704067200 * 10**9, ts, ts.date(), ns, "p", "e", comp)


def test_two_span_trace_grouping(spark):
    rows = [_span("t1", "s1", "", "root-op", 0, 5), _span("t1", "s2", "s1", "child", 1, 3, "Error"),
            _span("t2", "s3", "", "other", 10, 11, "OK")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.trace_id: r for r in T.list_traces(df, Scope("ns"), "2024-01-01", "2024-01-02").collect()}
    assert out["t1"].span_count == 2 and out["t1"].root_span_id == "s1" and out["t1"].trace_name == "root-op"
    assert out["t1"].has_errors is True and out["t2"].has_errors is False
    assert out["t1"].duration_ns == 5 * 10**9
    # newest first
    assert [r.trace_id for r in T.list_traces(df, Scope("ns"), "2024-01-01", "2024-01-02").collect()] == ["t2", "t1"]


def test_root_falls_back_to_earliest_span(spark):
    rows = [_span("t1", "s2", "lost", "late", 2, 3), _span("t1", "s1", None, "early", 1, 4)]
    out = T.rollup_traces(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    # NULL parent is not a root in the search-store form: fall back to the earliest span
    assert out.root_span_id == "s1" and out.trace_name == "early"


def test_span_page_skips_blank_trace_ids_and_null_parent_is_root(spark):
    rows = [_span("", "s0", "", "blank", 0, 1), _span("t1", "s1", None, "r", 1, 2), _span("t1", "s2", "s1", "c", 2, 3)]
    out = T.list_traces_span_page(spark.createDataFrame(rows, SCHEMA), Scope("ns"), "2024-01-01", "2024-01-02").collect()
    assert [r.trace_id for r in out] == ["t1"]
    assert out[0].root_span_id == "s1" and out[0].span_count == 2


def test_status_and_duration(spark):
    df = spark.createDataFrame([("Error", 1, 5), ("OK", None, 5), ("weird", 2, None), (None, 3, 4)],
                               "status_code string, start_ns long, end_ns long")
    got = df.select(T.normalize_status().alias("s"), T.span_duration().alias("d")).collect()
    assert [r.s for r in got] == ["error", "ok", "unset", "unset"]
    assert [r.d for r in got] == [4, 0, 0, 1]


def test_trace_total_is_capped(spark):
    rows = [_span(f"t{i}", f"s{i}", "", "x", i, i + 1) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert T.trace_total(df, Scope("ns"), "2024-01-01", "2024-01-02", exact=True, cap=10).collect()[0][0] == 10
    approx = T.trace_total(df, Scope("ns"), "2024-01-01", "2024-01-02", exact=False).collect()[0][0]
    assert abs(approx - 30) <= 2  # HLL++ estimate, relative error about 5%
