"""OTLP payload decoding."""

import json

from skylight.sources.otlp import decode_otlp, otlp_rejects

T, S = "5b8efff798038103d269b633813fc60c", "eee19b7ec3c1b174"


def attr(key, **value):
    return {"key": key, "value": value}


def span(**kw):
    return {"traceId": T, "spanId": S, "name": "op", "kind": 2, "startTimeUnixNano": "1544712660000000000",
            "endTimeUnixNano": 1544712661000000500, **kw}


def payload(*spans, resource=(), scope=None):
    return json.dumps({"resourceSpans": [{"resource": {"attributes": list(resource)}, "scopeSpans": [{"scope": scope or {}, "spans": list(spans)}]}]})


def run(spark, *payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "src int, payload string")
    return decode_otlp(df).orderBy("src", "span_id").collect(), otlp_rejects(df).orderBy("src", "raw").collect()


def test_typed_values_and_inherited_resource(spark):
    got, bad = run(spark, payload(
        span(attributes=[attr("s", stringValue="x"), attr("i", intValue="42"), attr("n", intValue=7), attr("d", doubleValue=1.5), attr("b", boolValue=True),
                         attr("a", arrayValue={"values": [{"stringValue": "p"}, {"intValue": "1"}]}), attr("k", kvlistValue={"values": [attr("z", intValue=3)]}),
                         attr("none"), attr("s", stringValue="last"), {"value": {"stringValue": "no key"}}],
             status={"code": 2, "message": "boom"}, parentSpanId="EEE19B7EC3C1B173",
             events=[{"timeUnixNano": "5", "name": "e", "attributes": [attr("q", boolValue=False)]}]),
        span(spanId="ffe19b7ec3c1b174", kind="SPAN_KIND_CLIENT", status={"code": "STATUS_CODE_OK"}),
        resource=[attr("service.name", stringValue="shop")], scope={"name": "lib", "version": "1.0", "attributes": [attr("x", intValue=1)]}))
    assert bad == [] and len(got) == 2
    a, b = got
    assert a["attributes"] | {"a": None, "k": None} == {"s": "last", "i": "42", "n": "7", "d": "1.5", "b": "true", "a": None, "k": None}
    assert json.loads(a["attributes"]["a"])["values"][0] == {"stringValue": "p"} and json.loads(a["attributes"]["k"])["values"][0]["key"] == "z"
    assert a["attribute_types"] == {"s": "string", "i": "int", "n": "int", "d": "double", "b": "bool", "a": "array", "k": "kvlist"}
    assert a["resource_attributes"] == b["resource_attributes"] == {"service.name": "shop"}
    assert a["scope_name"] == "lib" and a["scope_attributes"] == {"x": "1"}
    assert (a["kind"], a["status_code"], a["status_message"], a["parent_span_id"]) == ("SERVER", "Error", "boom", "eee19b7ec3c1b173")
    assert (b["kind"], b["status_code"], b["parent_span_id"]) == ("CLIENT", "OK", "")
    assert a["duration_ns"] == 1_000_000_500 and a["start_ts"].isoformat() == "2018-12-13T14:51:00"
    assert [e["name"] for e in a["events"]] == ["e"] and a["events"][0]["attributes"] == {"q": "false"} and b["events"] == []


def test_rejects_are_whole_and_nothing_is_lost(spark):
    bad_spans = [span(traceId="0" * 32), span(traceId=None), span(spanId="xyz"), span(parentSpanId="12"), span(startTimeUnixNano="soon"),
                 span(endTimeUnixNano="1"), span(startTimeUnixNano=None)]
    got, bad = run(spark, None, "not json", "{}", '{"resourceSpans": []}', payload(), payload(span(), *bad_spans))
    assert len(got) == 1 and got[0]["src"] == 5
    assert [r["reason"] for r in bad if r["src"] < 5] == ["no payload", "not a trace export", "not a trace export", "no spans", "no spans"]
    assert sorted(r["reason"] for r in bad if r["src"] == 5) == sorted(
        ["bad trace id", "bad trace id", "bad span id", "bad parent span id", "bad time", "ends before it starts", "bad time"])
    assert bad[1]["raw"] == "not json" and all(json.loads(r["raw"])["name"] == "op" for r in bad if r["src"] == 5)
