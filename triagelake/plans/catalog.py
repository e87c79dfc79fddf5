"""All registered queries and their SQL."""

from triagelake.plans import (
    audit_queries,
    cohort_queries,
    graph_queries,
    link_queries,
    model_queries,
    session_queries,
    source_queries,
)

_PARTS = (session_queries, cohort_queries, graph_queries, link_queries, audit_queries, source_queries, model_queries)

QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
