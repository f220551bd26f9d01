"""OTLP trace payloads to span rows.

A payload is the JSON form of an export request: resourceSpans -> scopeSpans
-> spans, with attributes as key / typed value lists. ``decode_otlp`` unnests
them with ``from_json`` and ``explode_outer`` (no Python), turns attribute
lists to maps of text, keeps each value's type beside it, and gives every span
its resource's and its scope's attributes. What cannot be decoded is in
``otlp_rejects``, whole, with a reason: the two split the spans between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# nested lists stay JSON text
_VALUE = ("struct<stringValue:string,intValue:string,doubleValue:string,boolValue:string,bytesValue:string,"
          "arrayValue:string,kvlistValue:string>")
_ATTRIBUTES = f"array<struct<key:string,value:{_VALUE}>>"
_SPAN = (f"struct<traceId:string,spanId:string,parentSpanId:string,name:string,kind:string,startTimeUnixNano:string,"
         f"endTimeUnixNano:string,attributes:{_ATTRIBUTES},status:struct<code:string,message:string>,"
         f"events:array<struct<timeUnixNano:string,name:string,attributes:{_ATTRIBUTES}>>>")
_SCOPE = f"struct<scope:struct<name:string,version:string,attributes:{_ATTRIBUTES}>,spans:array<{_SPAN}>>"
_PAYLOAD = f"resourceSpans array<struct<resource:struct<attributes:{_ATTRIBUTES}>,scopeSpans:array<{_SCOPE}>>>"
TYPES = ["stringValue", "intValue", "doubleValue", "boolValue", "bytesValue", "arrayValue", "kvlistValue"]

# The protocol's enumerations, by number and by name.
KINDS = ["INTERNAL", "SERVER", "CLIENT", "PRODUCER", "CONSUMER"]
STATUS = {"0": None, "1": "OK", "2": "Error", "STATUS_CODE_UNSET": None, "STATUS_CODE_OK": "OK", "STATUS_CODE_ERROR": "Error"}

TRACE_ID, SPAN_ID = "^(?!0+$)[0-9a-fA-F]{32}$", "^(?!0+$)[0-9a-fA-F]{16}$"


def _map(attributes: Column, of) -> Column:
    """key -> ``of(value)``; the last of equal keys wins, keys without name or value go."""
    named = F.filter(F.coalesce(attributes, F.array()), lambda a: a["key"].isNotNull() & (_text(a["value"]).isNotNull()))
    last = F.filter(named, lambda a, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda b: b["key"] == a["key"]))
    return F.map_from_entries(F.transform(last, lambda a: F.struct(a["key"].alias("key"), of(a["value"]).alias("value"))))


def _text(v: Column) -> Column:
    return F.coalesce(*[v[t] for t in TYPES])


def _type(v: Column) -> Column:
    return F.coalesce(*[F.when(v[t].isNotNull(), t.removesuffix("Value")) for t in TYPES])


def _kind(k: Column) -> Column:
    out = F.when(k.startswith("SPAN_KIND_"), F.nullif(F.substring(k, 11, 100), F.lit("UNSPECIFIED")))
    for i, name in enumerate(KINDS):
        out = out.when(k == str(i + 1), name)
    return out


def _status(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, name in STATUS.items():
        out = F.when(c == code, F.lit(name)).otherwise(out)
    return out


def _ns(c: Column) -> Column:
    return c.try_cast("bigint")


def _spans(payloads: DataFrame, column: str) -> DataFrame:
    """One row per span, and one for each payload without any; ``reason`` says
    why a row is no span."""
    keep = [F.col(c).alias(f"in_{c}") for c in payloads.columns if c != column]
    p = payloads.select(*keep, F.col(column).alias("payload"), F.from_json(F.col(column), _PAYLOAD).alias("j"))
    s = p.select("*", F.explode_outer("j.resourceSpans").alias("rs")).select("*", F.explode_outer("rs.scopeSpans").alias("ss"))
    s = s.select("*", F.explode_outer("ss.spans").alias("s"))
    sp = F.col("s")
    start, end = _ns(sp["startTimeUnixNano"]), _ns(sp["endTimeUnixNano"])
    reason = (F.when(F.col("payload").isNull(), "no payload")
              .when(F.col("j.resourceSpans").isNull(), "not a trace export")
              .when(sp.isNull(), "no spans")
              .when(~F.coalesce(sp["traceId"].rlike(TRACE_ID), F.lit(False)), "bad trace id")
              .when(~F.coalesce(sp["spanId"].rlike(SPAN_ID), F.lit(False)), "bad span id")
              .when(F.coalesce(sp["parentSpanId"], F.lit("")).rlike("^(?!$|[0-9a-fA-F]{16}$)"), "bad parent span id")
              .when(start.isNull() | end.isNull() | (start <= 0), "bad time")
              .when(end < start, "ends before it starts"))
    return s.select("*", start.alias("start_ns"), end.alias("end_ns"), reason.alias("reason"))


def decode_otlp(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Span rows of OTLP/JSON payloads. Attributes are maps of text;
    ``attribute_types`` names the type each value had. Resource attributes are
    on every span of the resource. The other columns of ``payloads`` are kept."""
    s, sp = _spans(payloads, column).filter("reason IS NULL"), F.col("s")
    others = [F.col(f"in_{c}").alias(c) for c in payloads.columns if c != column]
    event = lambda e: F.struct(_ns(e["timeUnixNano"]).alias("time_ns"), e["name"].alias("name"),
                               _map(e["attributes"], _text).alias("attributes"))
    return s.select(
        *others, F.lower(sp["traceId"]).alias("trace_id"), F.lower(sp["spanId"]).alias("span_id"),
        F.lower(F.coalesce(sp["parentSpanId"], F.lit(""))).alias("parent_span_id"), sp["name"].alias("name"), _kind(sp["kind"]).alias("kind"),
        F.timestamp_micros(F.expr("start_ns div 1000")).cast("timestamp_ntz").alias("start_ts"),
        "start_ns", "end_ns", (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"),
        _status(sp["status"]["code"]).alias("status_code"), sp["status"]["message"].alias("status_message"),
        F.col("ss.scope.name").alias("scope_name"), F.col("ss.scope.version").alias("scope_version"),
        _map(F.col("rs.resource.attributes"), _text).alias("resource_attributes"),
        _map(F.col("ss.scope.attributes"), _text).alias("scope_attributes"),
        _map(sp["attributes"], _text).alias("attributes"), _map(sp["attributes"], _type).alias("attribute_types"),
        F.transform(F.coalesce(sp["events"], F.array()), event).alias("events"))


def otlp_rejects(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads and spans that ``decode_otlp`` leaves out, with the reason; a
    bad span is given alone, as JSON."""
    s = _spans(payloads, column).filter("reason IS NOT NULL")
    others = [F.col(f"in_{c}").alias(c) for c in payloads.columns if c != column]
    return s.select(*others, "reason", F.when(F.col("s").isNull(), F.col("payload")).otherwise(F.to_json("s")).alias("raw"))
