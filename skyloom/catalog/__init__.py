"""Every operator as a named query over the given tables, with the SQL that
states the expected result."""

from skyloom.catalog import (  # noqa: F401
    aggregates, dimensions, facts, filters, joins, lineage, profiles, quality, scalars, scans, shaping, stored,
    streams, writes,
)
from skyloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
