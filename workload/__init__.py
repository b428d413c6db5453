"""Queries over the supplied tables, each with the SQL that must give the same rows."""

from workload import cleaning, facts, incremental, models, records, streams, tables  # noqa: F401
from workload.registry import QUERIES  # noqa: F401
