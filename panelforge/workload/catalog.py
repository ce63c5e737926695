"""All registered queries."""

from panelforge.workload import bonds, econometrics, panels, relational, sorting  # noqa: F401
from panelforge.workload.registry import REGISTRY

__all__ = ["REGISTRY"]
