"""Fixed parameters of the registered queries (the "requests" we replay).

The fixture data spans 2024-01-01 .. 2024-01-31 with about one event every
4 minutes overall, so metric queries use a wide grid (FIXTURES.md section 3).
"""

from __future__ import annotations

# Log search
LOG_START = "2024-01-05 00:00:00"
LOG_END = "2024-01-12 00:00:00"
LOG_NAMESPACE = "ns-1"

# Trace search
TRACE_START = "2024-01-03 00:00:00"
TRACE_END = "2024-01-20 00:00:00"
TRACE_NAMESPACE = "ns-1"

# Metric grid
GRID_START = "2024-01-03 00:00:00"
GRID_END = "2024-01-29 00:00:00"
GRID_STEP_S = 6 * 3600
RATE_RANGE_S = 2 * 86400
LOOKBACK_S = 2 * 86400
METRIC_NAMESPACE = "ns-1"

# Alert evaluation window for log rules
ALERT_START = "2024-01-02 00:00:00"
ALERT_END = "2024-01-30 00:00:00"
