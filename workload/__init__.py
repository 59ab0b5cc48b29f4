"""The registered queries: the library run over the driver's tables, each with its SQL."""

from workload import features, landing, models, rollups, streams, wide  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
