"""Observability tables derived from the ``events`` test table.

The reference works on log documents, spans, metric samples, rules and
webhook payloads.  The test data has none of these, so each is derived
from ``events`` by a fixed rule (FIXTURES.md section 3).  The builders
below are plain DataFrame projections / aggregations / windows, so the
work grows with ``events`` and Catalyst prunes what a query does not use.

Additions to FIXTURES.md, used by operators the views there do not cover:
``spans`` carries ``start_ns``/``end_ns``; ``gauge_samples`` carries
``cpu_request`` (half the limit) and ``memory_request`` (250 MB);
``http_duration_sum`` is the latency-sum counter for mean latency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylight.functions.scan import running_total, running_totals
from skylight.sources.tables import events as read_events


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _mod(col: str, n: int) -> Column:
    return F.col(col) % F.lit(n).cast("bigint")


def _day(col: str = "ts") -> Column:
    return F.col(col).cast("date")


def _scope_cols() -> list[Column]:
    return [
        F.concat(F.lit("ns-"), _s(_mod("user_id", 3))).alias("namespace"),
        F.concat(F.lit("proj-"), _s(_mod("user_id", 5))).alias("project_uid"),
        F.concat(F.lit("env-"), _s(_mod("user_id", 2))).alias("environment_uid"),
        F.concat(F.lit("comp-"), _s(_mod("user_id", 10))).alias("component_uid"),
    ]


def _pod_cols(pod="pod", ns="pod_namespace") -> list[Column]:
    return [
        F.concat(F.lit("pod-"), _s("user_id")).alias(pod),
        F.concat(F.lit("k8s-"), _s(_mod("user_id", 4))).alias(ns),
    ]


def log_message() -> Column:
    et = F.col("event_type")
    prefix = (F.when(et == "error", "ERROR upstream call failed ")
              .when(et == "signup", "WARNING slow signup ")
              .when(et == "view", "debug page rendered ")
              .when(et == "purchase", "order placed 100% ok ")
              .otherwise("click_handled "))
    return F.concat(prefix, F.col("props"))


def logs(ev: DataFrame) -> DataFrame:
    et = F.col("event_type")
    level = (F.when(et == "error", "ERROR").when(et == "signup", " WARN ")
             .when(et == "view", ""))
    c20 = _mod("event_id", 20)
    return ev.select(
        "event_id", "ts", _day().alias("log_date"),
        log_message().alias("log"),
        level.alias("log_level"),
        *_scope_cols(),
        F.concat(F.lit("run-"), _s(_mod("user_id", 7)), F.lit("-step-"), _s(_mod("event_id", 4))).alias("pod_name"),
        F.concat(F.lit("workflows-ns-"), _s(_mod("user_id", 3))).alias("pod_namespace"),
        F.when(c20 == 0, "init").when(c20 == 1, "wait").otherwise("main").alias("container_name"),
        F.concat(F.lit("run-"), _s(_mod("user_id", 7))).alias("workflow_run"),
        F.concat(F.lit("step-"), _s(_mod("event_id", 4))).alias("step_name"),
    )


def spans(ev: DataFrame) -> DataFrame:
    """One trace per user and day; the first event of the trace is its root.

    The first event id per trace is a grouped aggregate joined back (partial
    aggregation, then an equi-join that AQE can split when a trace is hot),
    not a window, so a hot trace never lands in one task whole.
    """
    keyed = ev.withColumn("span_date", _day())
    first = (keyed.groupBy("user_id", "span_date")
             .agg(F.min("event_id").alias("first_event_id")))
    j = keyed.join(first, ["user_id", "span_date"], "inner")
    c10 = _mod("event_id", 10)
    parent = (F.when(F.col("event_id") > F.col("first_event_id"),
                     F.concat(F.lit("span-"), _s("first_event_id")))
              .when(c10 == 0, "span-lost").when(c10 == 1, F.lit(None).cast("string"))
              .otherwise(""))
    et = F.col("event_type")
    duration = F.round(F.col("value") * 1000).cast("bigint") * F.lit(1000).cast("bigint")
    start_ns = F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000).cast("bigint")
    return j.select(
        "event_id", F.col("ts").alias("start_ts"), "span_date",
        F.concat(F.lit("trace-"), _s("user_id"), F.lit("-"), _s("span_date")).alias("trace_id"),
        F.concat(F.lit("span-"), _s("event_id")).alias("span_id"),
        parent.alias("parent_span_id"),
        et.alias("name"),
        F.when(et.isin("click", "view"), "SERVER").otherwise("CLIENT").alias("kind"),
        F.when(et == "error", "Error").when(et == "purchase", "OK").alias("status_code"),
        duration.alias("duration_ns"),
        *_scope_cols(), "props",
        start_ns.alias("start_ns"),
        (start_ns + duration).alias("end_ns"),
        *_pod_cols(),
    )


def pods(ev: DataFrame) -> DataFrame:
    """The pod-label dimension: one row per pod.  Every label is a function
    of the user id, so the distinct runs on that one column (a narrow
    shuffle) and the labels are projected afterwards."""
    return ev.select("user_id").distinct().select(*_pod_cols(), *_scope_cols())


def _container() -> Column:
    """Two containers a pod, and the pod-level series without a container."""
    return F.when(_mod("event_id", 7) == 0, "").when(_mod("event_id", 2) == 0, "main").otherwise("side")


def _reporter() -> Column:
    return F.when(_mod("event_id", 3) == 0, "server").otherwise("client")


def cpu_samples(ev: DataFrame) -> DataFrame:
    """Cumulative CPU counter per pod and container that resets each day."""
    base = ev.select(*_pod_cols(), _container().alias("container"), "ts", "user_id", "event_id", _day().alias("d"),
                     F.round(F.col("value") * 100).cast("bigint").alias("centi"))
    out = running_total(base, ["user_id", "d", "container"], "event_id", "centi", "cum")
    return out.select("pod", "pod_namespace", "container", "ts",
                      (F.col("cum").cast("double") / F.lit(100.0)).alias("value"))


def gauge_samples(ev: DataFrame) -> DataFrame:
    cpu_limit = (F.lit(1).cast("bigint") + _mod("user_id", 4)).cast("double")
    return ev.select(
        *_pod_cols(), _container().alias("container"), "ts",
        F.round(F.col("value") * 1000000).alias("memory_bytes"),
        cpu_limit.alias("cpu_limit"),
        F.lit(500000000.0).alias("memory_limit"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("phase_running"),
        (cpu_limit / F.lit(2.0)).alias("cpu_request"),
        F.lit(250000000.0).alias("memory_request"),
    )


def _status() -> Column:
    et = F.col("event_type")
    return (F.when(et == "error", "500").when(et == "signup", "404").when(et == "purchase", "201")
            .when(et == "click", "302").otherwise("200"))


def http_samples(ev: DataFrame) -> DataFrame:
    base = ev.select(*_pod_cols("destination_pod", "destination_namespace"),
                     _reporter().alias("reporter"), _status().alias("status"), "ts",
                     "user_id", "event_id", F.lit(1).cast("bigint").alias("one"))
    out = running_total(base, ["user_id", "status", "reporter"], "event_id", "one", "n")
    return out.select("destination_pod", "destination_namespace", "reporter", "status", "ts",
                      F.col("n").cast("double").alias("value"))


# The histogram bucket bounds of the latency fixture.
BUCKET_BOUNDS = (10.0, 50.0, 100.0, 500.0, float("inf"))


def http_buckets(ev: DataFrame) -> DataFrame:
    """One cumulative counter per (pod, reporter, bucket bound): the bounds
    stay columns through the running totals and become rows at the end."""
    hits = {f"hit{i}": f"n{i}" for i in range(len(BUCKET_BOUNDS))}
    base = ev.select(*_pod_cols("destination_pod", "destination_namespace"), _reporter().alias("reporter"), "ts", "user_id",
                     "event_id", *[F.when(F.col("value") <= F.lit(b), 1).otherwise(0).cast("bigint").alias(h)
                                   for b, h in zip(BUCKET_BOUNDS, hits)])
    out = running_totals(base, ["user_id", "reporter"], "event_id", hits)
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("le"), F.col(n).alias("n")) for b, n in zip(BUCKET_BOUNDS, hits.values())]))
    return (out.select("destination_pod", "destination_namespace", "reporter", "ts", rows.alias("b"))
            .select("destination_pod", "destination_namespace", "reporter", "ts", "b.le",
                    F.col("b.n").cast("double").alias("value")))


def http_duration_sum(ev: DataFrame) -> DataFrame:
    """Latency-sum counter (seconds) per destination pod and reporter."""
    base = ev.select(*_pod_cols("destination_pod", "destination_namespace"),
                     _reporter().alias("reporter"), "ts", "user_id", "event_id",
                     F.round(F.col("value") * 100).cast("bigint").alias("centi"))
    out = running_total(base, ["user_id", "reporter"], "event_id", "centi", "cum")
    return out.select("destination_pod", "destination_namespace", "reporter", "ts",
                      (F.col("cum").cast("double") / F.lit(100000.0)).alias("value"))


RULES_SCHEMA = ("rule_name string, namespace string, component_uid string, project_uid string, "
                "environment_uid string, phrase string, op string, threshold double, "
                "window_min bigint, interval_min bigint, enabled boolean")

# The three log-alert rules of the fixture.
RULE_ROWS = [
    ("r-errors", "ns-0", "comp-0", "proj-0", "env-0", "ERROR", "gt", 0.0, 1440, 360, True),
    ("r-quiet", "ns-0", "comp-0", "proj-0", "env-0", "order", "lte", 0.0, 720, 360, True),
    ("r-off", "ns-1", "comp-1", "proj-1", "env-1", "WARNING", "gte", 1.0, 360, 60, False),
]


def rules(spark: SparkSession) -> DataFrame:
    """Alert rules are configuration: a handful of rows.  An inline VALUES
    table is a local relation, so the optimizer knows its exact size and a
    size-checked broadcast applies."""
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    values = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in RULE_ROWS)
    names = [c.split()[0] for c in RULES_SCHEMA.split(", ")]
    typed = ", ".join(f"CAST({n} AS {t.split()[1].upper()}) AS {n}"
                      for n, t in zip(names, RULES_SCHEMA.split(", ")))
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({', '.join(names)})")


def webhooks(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    m3 = _mod("event_id", 3)
    search = F.concat(F.lit('{"ruleName":"r-errors","ruleNamespace":"ns-0","alertValue":'), _s(eid),
                      F.lit(',"alertTimestamp":"2024-01-02T03:04:05Z"}'))
    sql = F.concat(F.lit('{"alertName":"r-quiet","alertCount":"'), _s(eid),
                   F.lit('","alertTriggerTimeMicroSeconds":"1704164645000000"}'))
    status = F.when(_mod("event_id", 2) == 0, " Firing").otherwise("resolved")
    metrics = F.concat(F.lit('{"alerts":[{"status":"'), status,
                       F.lit('","startsAt":"2024-01-02T03:04:05Z","annotations":{"rule_name":"r-cpu",'
                             '"rule_namespace":"ns-1","alert_value":"91.50"}}]}'))
    return ev.select(
        "event_id", F.col("ts").alias("received_at"),
        F.when(m3 == 0, "search").when(m3 == 1, "sql").otherwise("metrics").alias("shape"),
        F.when(m3 == 0, search).when(m3 == 1, sql).otherwise(metrics).alias("body"),
    )


# Payloads that are odd or must be rejected, by event_id % 9.
ODD_WEBHOOKS = (
    ("search", '{"ruleName":"r","alertValue":3,"alertTimestamp":"2024-01-02T05:04:05.250+02:00"}'),
    ("search", "not json"),
    ("search", '{"ruleName":"r","alertValue":"x"}'),
    ("sql", '{"alertName":"a","alertCount":"x"}'),
    ("metrics", '{"alerts":[]}'),
    ("mail", "{}"),
    ("search", '{"alertValue":1}'),
    ("sql", '{"alertName":"a","alertCount":"3"}'),
    ("metrics", '{"alerts":[{"status":"firing","annotations":{"rule_name":"r","rule_namespace":"n"}}]}'),
)


def odd_webhooks(ev: DataFrame) -> DataFrame:
    case = _mod("event_id", len(ODD_WEBHOOKS)).cast("int")
    pick = F.array(*[F.struct(F.lit(s).alias("shape"), F.lit(b).alias("body")) for s, b in ODD_WEBHOOKS])[case]
    return ev.select("event_id", F.col("ts").alias("received_at"), pick["shape"].alias("shape"), pick["body"].alias("body"))


class Views:
    """Lazy accessors for the derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @property
    def events(self) -> DataFrame:
        return read_events(self.spark, self.sf_dir)

    def logs(self) -> DataFrame:
        return logs(self.events)

    def spans(self) -> DataFrame:
        return spans(self.events)

    def pods(self) -> DataFrame:
        return pods(self.events)

    def cpu_samples(self) -> DataFrame:
        return cpu_samples(self.events)

    def gauge_samples(self) -> DataFrame:
        return gauge_samples(self.events)

    def http_samples(self) -> DataFrame:
        return http_samples(self.events)

    def http_buckets(self) -> DataFrame:
        return http_buckets(self.events)

    def http_duration_sum(self) -> DataFrame:
        return http_duration_sum(self.events)

    def rules(self) -> DataFrame:
        return rules(self.spark)

    def webhooks(self) -> DataFrame:
        return webhooks(self.events)

    def odd_webhooks(self) -> DataFrame:
        return odd_webhooks(self.events)

    def table(self, name: str) -> DataFrame:
        from skylight.sources.tables import read_table
        return read_table(self.spark, self.sf_dir, name)
