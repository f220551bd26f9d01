"""skylight: observability analytics as Spark jobs.

Log search, trace roll-ups, PromQL-style metric series, threshold alerting,
ingestion transforms and governance reports, built from DataFrame / Spark SQL
expressions and Structured Streaming.  See README.md for the layout and
COVERAGE.md for the operator map.
"""

__version__ = "0.1.0"
