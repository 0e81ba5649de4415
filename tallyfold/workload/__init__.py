"""The registered queries: every operator over the driver's tables, with its SQL check."""

from tallyfold.workload import cleaning, features, joins, reports, sources  # noqa: F401
from tallyfold.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
