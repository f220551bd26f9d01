"""Search scope: namespace is mandatory, the other ids narrow it.

An empty id means "not filtered".  Several component ids are OR-ed.  The
scope becomes one conjunctive Column predicate that Catalyst pushes into
the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scope:
    namespace: str
    project: str | None = None
    component: str | Sequence[str] | None = None
    environment: str | None = None
    columns: dict = field(default_factory=lambda: {
        "namespace": "namespace", "project": "project_uid",
        "component": "component_uid", "environment": "environment_uid"})

    def __post_init__(self):
        if not self.namespace:
            raise ValueError("namespace is required")

    @property
    def components(self) -> list[str]:
        if self.component is None or self.component == "":
            return []
        if isinstance(self.component, str):
            return [self.component]
        return [c for c in self.component if c]

    def predicate(self, with_namespace: bool = True) -> Column:
        cols = self.columns
        cond = F.lit(True)
        if with_namespace:
            cond = F.col(cols["namespace"]) == F.lit(self.namespace)
        comps = self.components
        if len(comps) == 1:
            cond = cond & (F.col(cols["component"]) == F.lit(comps[0]))
        elif comps:
            cond = cond & F.col(cols["component"]).isin(comps)
        if self.project:
            cond = cond & (F.col(cols["project"]) == F.lit(self.project))
        if self.environment:
            cond = cond & (F.col(cols["environment"]) == F.lit(self.environment))
        return cond

    def label_columns(self) -> list[str]:
        """Scope labels that are set, in component, project, environment order
        (the order used for ``sum by``)."""
        out = []
        if self.components:
            out.append(self.columns["component"])
        if self.project:
            out.append(self.columns["project"])
        if self.environment:
            out.append(self.columns["environment"])
        return out
