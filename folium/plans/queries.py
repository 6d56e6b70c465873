"""Queries of the core by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators import nested, orphans
from folium.session import table

Query = Callable[[SparkSession, str], DataFrame]

LAYOUT = ["paragraphs", "tables", "pages"]
#: Where the replay of the reference feed ends a step.
STEPS = [datetime(2023, 1, 1), datetime(2024, 1, 1)]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every object within the layout arrays, with its holder's path."""
    return nested.object_links(table(spark, d, "layout_docs"), "layout_id", LAYOUT, "analyzeResult")


def p2_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each related table, by the table that holds them."""
    rows = nested.object_rows(table(spark, d, "layout_docs"), "layout_id", LAYOUT, "analyzeResult", payload=False)
    return rows.groupBy("table", "parent_table").agg(F.count("*").alias("n"))


def _flat(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    t = nested.flat_tables(table(spark, d, "layout_docs"), "layout_id", LAYOUT, "analyzeResult")[name]
    return t.select("layout_id", "path", "parent_path", "pos", *columns)


def p2_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The table of paragraphs, with key and foreign key."""
    return _flat(spark, d, "paragraphs", "content", "role", "kind", "heading")


def p2_layout_tables(spark: SparkSession, d: str) -> DataFrame:
    """The table of tables."""
    return _flat(spark, d, "tables", "caption")


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    """The table of pages."""
    return _flat(spark, d, "pages", "pageNumber")


def p2_cells(spark: SparkSession, d: str) -> DataFrame:
    """The table of cells."""
    return _flat(spark, d, "cells", "rowIndex", "columnIndex", "content")


def p2_lines(spark: SparkSession, d: str) -> DataFrame:
    """The table of lines."""
    return _flat(spark, d, "lines", "content", "text")


def p2_spans(spark: SparkSession, d: str) -> DataFrame:
    """The table of spans, which paragraphs, tables, cells and lines share."""
    return _flat(spark, d, "spans", "parent_table", "offset", "length")


def p2_regions(spark: SparkSession, d: str) -> DataFrame:
    """The table of bounding regions, which paragraphs and tables share; their corners as text."""
    return _flat(spark, d, "boundingRegions", "parent_table", "pageNumber", "polygon").withColumn("polygon", F.array_join(F.transform("polygon", lambda x: F.round(x * 1000).cast("long").cast("string")), " ", "-"))


def _orphans(spark: SparkSession, d: str) -> orphans.OrphanState:
    return orphans.replay(orphans.references(table(spark, d, "relations")), orphans.parent_events(table(spark, d, "graph_nodes")), STEPS)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """References without a node at the time they were seen."""
    return _orphans(spark, d).pending().select(F.col("ref_id").alias("rel_id"), "side", "reason")


def p4_periods(spark: SparkSession, d: str) -> DataFrame:
    """Such references per side, month and reason."""
    return _orphans(spark, d).snapshot()


_ORPHANS = r"""
WITH r AS (
  SELECT rel_id, 'parent_node' AS side, regexp_replace(parent_node, '^\s+|\s+$', '', 'g') AS k, seen_at FROM relations
  UNION ALL
  SELECT rel_id, 'child_node', regexp_replace(child_node, '^\s+|\s+$', '', 'g'), seen_at FROM relations
), o AS (
  SELECT rel_id, side, seen_at, CASE WHEN count(id) = 0 THEN 'missing' WHEN bool_or(loaded_at <= seen_at) THEN 'deleted' ELSE 'late' END AS reason
  FROM r LEFT JOIN graph_nodes ON id = k WHERE k <> '' GROUP BY rel_id, side, seen_at
  HAVING NOT coalesce(bool_or(loaded_at <= seen_at AND (deleted_at IS NULL OR deleted_at > seen_at)), false)
)
"""

_OBJECTS = """
WITH d AS (
  SELECT layout_id, coalesce(analyzeResult.paragraphs, paragraphs) AS p, coalesce(analyzeResult.tables, tables) AS t, coalesce(analyzeResult.pages, pages) AS g FROM layout_docs
), p AS (SELECT layout_id, '' AS parent_path, 'paragraphs[' || i || ']' AS child_path, p[i + 1] AS o, i, '' AS pt, 'paragraphs' AS ct FROM (SELECT *, unnest(range(len(p))) AS i FROM d) WHERE p[i + 1] IS NOT NULL),
t AS (SELECT layout_id, '' AS parent_path, 'tables[' || i || ']' AS child_path, t[i + 1] AS o, i, '' AS pt, 'tables' AS ct FROM (SELECT *, unnest(range(len(t))) AS i FROM d) WHERE t[i + 1] IS NOT NULL),
g AS (SELECT layout_id, '' AS parent_path, 'pages[' || i || ']' AS child_path, g[i + 1] AS o, i, '' AS pt, 'pages' AS ct FROM (SELECT *, unnest(range(len(g))) AS i FROM d) WHERE g[i + 1] IS NOT NULL),
c AS (SELECT layout_id, child_path AS parent_path, child_path || '.cells[' || i || ']' AS child_path, o.cells[i + 1] AS o, ct AS pt, 'cells' AS ct, i FROM (SELECT * EXCLUDE (i), unnest(range(len(o.cells))) AS i FROM t) WHERE o.cells[i + 1] IS NOT NULL),
l AS (SELECT layout_id, child_path AS parent_path, child_path || '.lines[' || i || ']' AS child_path, o.lines[i + 1] AS o, ct AS pt, 'lines' AS ct, i FROM (SELECT * EXCLUDE (i), unnest(range(len(o.lines))) AS i FROM g) WHERE o.lines[i + 1] IS NOT NULL),
hs AS (SELECT layout_id, child_path, o.spans AS s, ct FROM p UNION ALL SELECT layout_id, child_path, o.spans, ct FROM t UNION ALL SELECT layout_id, child_path, o.spans, ct FROM c UNION ALL SELECT layout_id, child_path, o.spans, ct FROM l),
hb AS (SELECT layout_id, child_path, o.boundingRegions AS s, ct FROM p UNION ALL SELECT layout_id, child_path, o.boundingRegions, ct FROM t),
s AS (SELECT layout_id, child_path AS parent_path, child_path || '.spans[' || i || ']' AS child_path, ct AS pt, 'spans' AS ct, s[i + 1] AS o, i FROM (SELECT *, unnest(range(len(s))) AS i FROM hs) WHERE s[i + 1] IS NOT NULL),
b AS (SELECT layout_id, child_path AS parent_path, child_path || '.boundingRegions[' || i || ']' AS child_path, ct AS pt, 'boundingRegions' AS ct, s[i + 1] AS o, i FROM (SELECT *, unnest(range(len(s))) AS i FROM hb) WHERE s[i + 1] IS NOT NULL),
alls AS (
  SELECT layout_id, parent_path, child_path, pt, ct FROM p UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM t UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM g
  UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM c UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM l UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM s UNION ALL SELECT layout_id, parent_path, child_path, pt, ct FROM b
)
"""

_FLAT = _OBJECTS + "SELECT layout_id, child_path AS path, parent_path, CAST(i AS INTEGER) AS pos, "

SQL = {
    "p2_found": _OBJECTS + "SELECT layout_id, parent_path, child_path FROM alls",
    "p2_tables": _OBJECTS + 'SELECT ct AS "table", pt AS parent_table, count(*) AS n FROM alls GROUP BY ALL',
    "p2_paragraphs": _FLAT + "o.content AS content, o.role AS role, o.kind AS kind, o.heading AS heading FROM p",
    "p2_layout_tables": _FLAT + "o.caption AS caption FROM t",
    "p2_pages": _FLAT + 'o.pageNumber AS "pageNumber" FROM g',
    "p2_cells": _FLAT + 'o.rowIndex AS "rowIndex", o.columnIndex AS "columnIndex", o.content AS content FROM c',
    "p2_lines": _FLAT + "o.content AS content, o.text AS text FROM l",
    "p2_spans": _FLAT + 'pt AS parent_table, o."offset" AS "offset", o.length AS length FROM s',
    "p2_regions": _FLAT + """pt AS parent_table, o.pageNumber AS "pageNumber", CASE WHEN o.polygon IS NOT NULL THEN coalesce(array_to_string(list_transform(o.polygon, lambda x: coalesce(CAST(CAST(round(x * 1000) AS BIGINT) AS VARCHAR), '-')), ' '), '') END AS polygon FROM b""",
    "p4_found": _ORPHANS + "SELECT rel_id, side, reason FROM o",
    "p4_periods": _ORPHANS + "SELECT side, strftime(seen_at, '%Y-%m') AS period, reason, count(*) AS n FROM o GROUP BY ALL",
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p2_found, p2_tables, p2_paragraphs, p2_layout_tables, p2_pages, p2_cells, p2_lines, p2_spans, p2_regions, p4_found, p4_periods)}
