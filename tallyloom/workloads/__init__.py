"""Queries over the driver's tables, each with the SQL that must give the same rows."""

from tallyloom.workloads import catalog  # noqa: F401
from tallyloom.workloads.registry import ORACLES, QUERIES  # noqa: F401
