"""Kubernetes label keys that scope logs, spans and pod metrics.

Pods carry their component, environment, project and namespace ids as
labels under one label domain.  The domain is configuration: set
``LABEL_DOMAIN`` to the one the platform's pods use.  The key names after
the slash and the normalisation rules (log shipper: dots to ``_``; metric
exporter: ``-``, ``.`` and ``/`` to ``_`` plus a ``label_`` prefix) are
fixed.
"""

from __future__ import annotations

LABEL_DOMAIN = "skylight.dev"

# The scope label names under the label domain.
COMPONENT_UID = "component-uid"
ENVIRONMENT_UID = "environment-uid"
PROJECT_UID = "project-uid"
NAMESPACE = "namespace"


def label_key(name: str, domain: str | None = None) -> str:
    return f"{domain or LABEL_DOMAIN}/{name}"


def log_label_key(name: str, domain: str | None = None) -> str:
    """The key as the log shipper stores it: dots replaced by ``_``."""
    return label_key(name, domain).replace(".", "_")


def metric_label_name(name: str, domain: str | None = None) -> str:
    """The label name as the metrics exporter writes it."""
    k = label_key(name, domain)
    for ch in "-./":
        k = k.replace(ch, "_")
    return "label_" + k


SCOPE_LABELS = (COMPONENT_UID, PROJECT_UID, ENVIRONMENT_UID, NAMESPACE)
