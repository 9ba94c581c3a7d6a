"""The registered queries over the driver's test tables and their SQL equivalents."""

from snapstrata.workload import loading, modelling, monitoring, profiling, refining, testing, upkeep
from snapstrata.workload.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "loading", "modelling", "monitoring", "profiling", "refining", "testing", "upkeep"]
