"""All queries by name, and the SQL that each must agree with."""

from __future__ import annotations

from .queries import city, cleaning, series, streams

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (series, cleaning, city, streams):
    QUERIES.update(_module.registry.queries)
    ORACLES.update(_module.registry.oracles)
