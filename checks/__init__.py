"""Registered queries over the benchmark tables, each with the SQL that checks it."""

from checks import audit, cleaning, files, layouts, multi, outcome, payloads, rollups, runs  # noqa: F401
from checks.registry import ORACLE, QUERIES  # noqa: F401
