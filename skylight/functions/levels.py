"""Log level extraction (L8) as one CASE expression on the upper-cased text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Levels probed in order; the first one found in the
# upper-cased text wins, WARNING reports as WARN, nothing found gives INFO.
# The search-store variant also probes UNDEFINED, last.
LEVELS_SQL_STORE = ("ERROR", "FATAL", "SEVERE", "WARN", "WARNING", "INFO", "DEBUG")
LEVELS_SEARCH_STORE = LEVELS_SQL_STORE + ("UNDEFINED",)
LEVEL_ALIASES = {"WARNING": "WARN"}
DEFAULT_LEVEL = "INFO"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def level_from_text(log="log", variant: str = "search") -> Column:
    probes = LEVELS_SEARCH_STORE if variant == "search" else LEVELS_SQL_STORE
    up = F.upper(_c(log))
    expr = None
    for lvl in probes:
        hit = F.coalesce(up.contains(lvl), F.lit(False))
        out = F.lit(LEVEL_ALIASES.get(lvl, lvl))
        expr = F.when(hit, out) if expr is None else expr.when(hit, out)
    return expr.otherwise(F.lit(DEFAULT_LEVEL))


def effective_level(log="log", stored="log_level") -> Column:
    """SQL-store rule: a stored non-blank level (trimmed) wins, else the text."""
    trimmed = F.trim(_c(stored))
    return F.when(trimmed.isNotNull() & (trimmed != ""), trimmed).otherwise(
        level_from_text(log, variant="sql"))
