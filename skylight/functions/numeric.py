"""Result rounding shared by the Spark plans and their SQL oracles.

Fixture values often sit exactly on a half-way point at the sixth decimal
(counter steps of 0.01 divided by whole-second ranges); two engines then
break the tie differently depending on the last float bit.  Adding 1e-9
first (far below the 1e-6 resolution, far above float noise of such
values) moves every such tie the same way in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE_NUDGE = 1e-9


def round6(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c + F.lit(TIE_NUDGE), 6)


def round6_sql(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 6)"
