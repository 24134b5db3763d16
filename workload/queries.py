"""All registered queries."""

from workload import checks, conforming, facts, ingest, reporting  # noqa: F401
from workload.registry import REGISTRY

__all__ = ["REGISTRY"]
