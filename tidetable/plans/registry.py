"""All registered queries and their SQL equivalents."""

from __future__ import annotations

from tidetable.plans import batch, oracles, streams

QUERIES = {**batch.QUERIES, **streams.QUERIES}
ORACLES = dict(oracles.ORACLES)
