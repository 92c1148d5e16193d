"""All queries and their SQL."""

from __future__ import annotations

from ledgerspark.testbed import deliveries, delivery_oracles, oracles, queries

QUERIES = queries.QUERIES | deliveries.QUERIES
ORACLES = oracles.ORACLES | delivery_oracles.ORACLES
