"""Time literals, epoch conversions and duration strings.

Literals are built as constant expressions so Catalyst folds them and the
comparisons reach the parquet reader as pushed filters.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = _dt.datetime(1970, 1, 1)


def parse_ts(value) -> _dt.datetime:
    """RFC 3339 / ISO text or datetime -> naive UTC datetime."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value
    text = str(value).strip().replace("T", " ")
    if text.endswith("Z"):
        text = text[:-1]
    parsed = _dt.datetime.fromisoformat(text)
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return parsed


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (the test parquet's ``ts`` type)."""
    return F.lit(parse_ts(value).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(value) -> int:
    delta = parse_ts(value) - _EPOCH
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def epoch_seconds(value) -> int:
    return epoch_micros(value) // 1_000_000


def micros_col(col: str | Column) -> Column:
    """Epoch microseconds of a timestamp / timestamp_ntz column (UTC session)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"


def rfc3339(col: str | Column) -> Column:
    """RFC 3339 text -> UTC TIMESTAMP_NTZ: any fraction or none (cut to
    micros), ``Z`` or a numeric offset; other text is NULL."""
    c = F.col(col) if isinstance(col, str) else col
    # digits beyond micros are cut: the cast reads at most nine
    short = F.regexp_replace(F.upper(c), r"(\.[0-9]{6})[0-9]+", "$1")
    return F.when(c.rlike(_RFC3339), short.try_cast("timestamp")).cast("timestamp_ntz")


def long_lit(v: int) -> Column:
    return F.lit(int(v)).cast("bigint")


_DUR = re.compile(r"^(\d+)(ms|s|m|h|d)$")
_UNIT_S = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400}
_GO_DUR = re.compile(r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)")


def duration_seconds(text: str) -> float:
    """``5m`` / ``2h`` / ``30s`` / ``1d`` -> seconds, parsed once on the driver."""
    m = _DUR.match(text.strip())
    if not m:
        raise ValueError(f"invalid duration: {text!r}")
    return int(m.group(1)) * _UNIT_S[m.group(2)]


def go_duration_seconds(text: str) -> float | None:
    """Sequence-of-units duration (``1h30m``); None when not parseable."""
    text = text.strip()
    if not text:
        return None
    pos, total, sign = 0, 0.0, 1.0
    if text[0] in "+-":
        sign = -1.0 if text[0] == "-" else 1.0
        pos = 1
    if text[pos:] == "0":
        return 0.0
    scale = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
    while pos < len(text):
        m = _GO_DUR.match(text, pos)
        if not m:
            return None
        total += float(m.group(1)) * scale[m.group(2)]
        pos = m.end()
    return sign * total
