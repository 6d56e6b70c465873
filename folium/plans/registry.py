"""All queries of the core, and the SQL that must give the same rows."""

from __future__ import annotations

from folium.plans import graph_queries, layout_queries, page_queries, queries as record_queries, stream_queries, text_queries

MODULES = (record_queries, text_queries, layout_queries, graph_queries, page_queries, stream_queries)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
