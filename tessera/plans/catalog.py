"""All registered queries: importing this module imports every query family
(each registers itself into ``queries.QUERIES`` / ``queries.ORACLE``)."""

from . import alert_queries, ingest_queries, model_queries, queries, rollup_queries, stream_queries  # noqa: F401

QUERIES = queries.QUERIES
ORACLE = queries.ORACLE
