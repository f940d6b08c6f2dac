"""All queries of the core, and the SQL that must give the same rows."""

from __future__ import annotations

from vaglio.plans import flow_oracles, flow_queries, oracles, pipeline_queries, reference_queries

QUERIES = {**pipeline_queries.QUERIES, **reference_queries.QUERIES, **flow_queries.QUERIES}
ORACLES = {**pipeline_queries.ORACLES, **oracles.ORACLES, **flow_oracles.ORACLES}
