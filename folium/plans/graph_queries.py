"""Queries of the tree, graph, resolution and quality operators, with their SQL.

Documents for the trees are built from orders: one JSON text an order, with its customer and lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import lexicon as lx
from folium.operators import graph, jsontree, quality, resolve
from folium.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]

ORDER = ["loaded_at", "id"]
#: Rows of one load may differ, so the order of loads goes on to the other columns.
LOADS = ["loaded_at", "name", "source", "label", "type", "path"]


def order_documents(spark: SparkSession, d: str) -> DataFrame:
    """(source, json): a nested JSON document for each order that has lines."""
    line = F.struct("l_linenumber", "l_returnflag", "l_quantity")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))  # a few lines an order
    o = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    doc = F.struct("o_orderkey", "o_orderstatus", F.struct("c_name", "c_mktsegment").alias("customer"), F.array("o_orderpriority", "o_orderstatus").alias("tags"), "lines")
    return o.select(F.concat(F.lit("order-"), F.col("o_orderkey")).alias("source"), F.to_json(doc).alias("json"))


def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of all order documents."""
    n = graph.nodes(jsontree.tree_rows(order_documents(spark, d)))
    return n.select(*graph.BASE, "length", F.col("props")["prop_c_name"].alias("prop_c_name"), F.col("props")["prop_l_returnflag"].alias("prop_l_returnflag"))


def tree_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of all order documents."""
    return graph.edges(jsontree.tree_rows(order_documents(spark, d)))


def tree_root_properties(spark: SparkSession, d: str) -> DataFrame:
    """The top-level objects with their own values, traversed without a seeded root."""
    n = graph.nodes(jsontree.tree_rows(order_documents(spark, d), seed_root=False)).where("path = ''")
    return n.select("id", "label", F.col("props")["prop_o_orderstatus"].alias("status"), F.col("props")["prop_tags"].alias("tags"))


def tree_edges_per_source(spark: SparkSession, d: str) -> DataFrame:
    """Valid edges by source, most first."""
    tree = cut(jsontree.tree_rows(order_documents(spark, d)))
    return quality.edges_per_source(graph.edges(tree), graph.nodes(tree))


def tree_labels(spark: SparkSession, d: str) -> DataFrame:
    """Nodes by label, with their part of all."""
    return quality.shares(graph.nodes(jsontree.tree_rows(order_documents(spark, d))), "label")


def tree_relations(spark: SparkSession, d: str) -> DataFrame:
    """Keys that hold lists of objects, with their holders, by number."""
    return jsontree.relations(order_documents(spark, d)).groupBy("parent_node", "child_node", "json_path").agg(F.count("*").alias("n"))


def tree_schema(spark: SparkSession, d: str) -> DataFrame:
    """Types at each path of the documents, and whether they are required."""
    return jsontree.key_types(order_documents(spark, d))


def tree_events(spark: SparkSession, d: str) -> DataFrame:
    """Properties of the events' JSON."""
    ev = table(spark, d, "events").select(F.col("event_id").cast("string").alias("source"), F.col("props").alias("json"))
    n = graph.nodes(jsontree.tree_rows(ev, seed_root=False))
    return n.select("source", F.explode("props").alias("name", "value"))


def json_clean_report(spark: SparkSession, d: str) -> DataFrame:
    """Strings cleaned inside layout records read as JSON documents, in figures for each record."""
    docs = table(spark, d, "layout_docs").select(F.col("layout_id").cast("string").alias("source"), F.to_json(F.struct("file", "content", "paragraphs", "tables", "pages", "analyzeResult")).alias("json"))
    return jsontree.clean_json(docs).drop("json")


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_nodes")


def graph_consolidated(spark: SparkSession, d: str) -> DataFrame:
    """Every node once, at its first load."""
    n = _nodes(spark, d).select("id", "label", "name", "source", "type", "path", "loaded_at")
    return graph.consolidate([n], LOADS).drop("loaded_at")


def graph_upserted(spark: SparkSession, d: str) -> DataFrame:
    """The store after loading by id: the last load wins, depth and length as numbers."""
    n = _nodes(spark, d).select("id", "label", "name", "source", "type", "path", "depth", "length", "loaded_at")
    return graph.upsert_nodes(None, n, LOADS).drop("loaded_at")


def _resolved(spark: SparkSession, d: str, **how: object) -> DataFrame:
    rels = table(spark, d, "relations").withColumnRenamed("rel_id", "ord").select("ord", "parent_node", "child_node", "type")
    return resolve.resolve(rels, _nodes(spark, d), node_order=ORDER, **how)


def graph_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose ends both resolve, each once."""
    return resolve.resolved_edges(_resolved(spark, d))


def graph_resolved_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Edges with nodes made up for what doesn't resolve."""
    return resolve.resolved_edges(_resolved(spark, d, allow_orphans=True))


def graph_made_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The nodes made up."""
    return resolve.made_nodes(_resolved(spark, d, allow_orphans=True))


def graph_missing_pairs(spark: SparkSession, d: str) -> DataFrame:
    """How many relations have an end that doesn't resolve."""
    return resolve.unresolved_count(_resolved(spark, d))


def graph_captured(spark: SparkSession, d: str) -> DataFrame:
    """Edges as a single pass would resolve them that adds made-up base nodes to its index as it goes."""
    rels = table(spark, d, "relations").withColumnRenamed("rel_id", "ord").select("ord", "parent_node", "child_node", "type")
    nodes = _nodes(spark, d)
    return resolve.resolved_edges(resolve.resolve(rels, nodes, node_order=ORDER, allow_orphans=True, captures=resolve.capture_bare_types(rels, nodes, ORDER)))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "relations").select(F.col("parent_node").alias("start_id"), F.col("child_node").alias("end_id"), F.coalesce(F.nullif(F.trim("type"), F.lit("")), F.lit(lx.EDGE_TYPE)).alias("type"))


def graph_loaded_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges as loaded: both ends there, one for each pair."""
    return graph.load_edges(_edges(spark, d), _nodes(spark, d))


def graph_edges_per_source(spark: SparkSession, d: str) -> DataFrame:
    """Valid edges by the start node's source (of several rows of a node the smallest), most first."""
    n = _nodes(spark, d).groupBy("id").agg(F.min("source").alias("source"))
    return quality.edges_per_source(_edges(spark, d), n)


def graph_connectivity(spark: SparkSession, d: str) -> DataFrame:
    """Nodes with and without an outgoing edge."""
    return quality.connectivity(_edges(spark, d), _nodes(spark, d))


def graph_isolated(spark: SparkSession, d: str) -> DataFrame:
    """Nodes at no end of an edge."""
    return quality.isolated(_edges(spark, d), _nodes(spark, d))


def graph_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Rows of nodes without an outgoing edge, and their number of properties."""
    return quality.leaves(_edges(spark, d), _nodes(spark, d), ["id", "label", "name", "source", "type", "path", "depth", "length", "prop_role", "prop_content"])


def graph_invalid_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges with an end that isn't there, by which end."""
    return quality.invalid_edges(_edges(spark, d), _nodes(spark, d)).groupBy("no_start", "no_end").agg(F.count("*").alias("n"))


def graph_counts(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges in all."""
    n = _nodes(spark, d).agg(F.count("*").alias("nodes"))
    return n.crossJoin(_edges(spark, d).agg(F.count("*").alias("edges")))  # one row each


def graph_label_shares(spark: SparkSession, d: str) -> DataFrame:
    """Node rows by label, with their part of all."""
    return quality.shares(_nodes(spark, d), "label")


def graph_edge_types(spark: SparkSession, d: str) -> DataFrame:
    """Edges by type."""
    return graph.edge_histogram(_edges(spark, d))


def graph_deviation(spark: SparkSession, d: str) -> DataFrame:
    """Node rows by source against distinct nodes: how far the load is from one row a node."""
    n = _nodes(spark, d)
    want = n.groupBy("source").agg(F.count_distinct("id").alias("expected"))
    return quality.deviation(want, n.groupBy("source").agg(F.count("*").alias("actual")), ["source"])


def graph_repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids that more than one row has."""
    return quality.repeated_keys(_nodes(spark, d), ["id"])


def graph_metadata(spark: SparkSession, d: str) -> DataFrame:
    """What goes beside the tables: nodes in all and their columns (of the orders' trees), edges in all and by type, as text."""
    n, e = graph.metadata(graph.nodes(jsontree.tree_rows(order_documents(spark, d))), _edges(spark, d))
    types = F.array_join(F.transform(F.map_entries("relationship_types"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ", ")
    return n.crossJoin(e).select("total_nodes", F.array_join("columns", ", ").alias("columns"), "total_relationships", types.alias("relationship_types"))  # one row each


_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{_WS}|{_WS}$', '', 'g')"


_LINES = "l AS (SELECT l_orderkey AS k, l_returnflag AS rf, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_quantity) - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"
_TREE = f"""
WITH {_LINES}, o AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr, c_name, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
n AS (
  SELECT 'order-' || k || '_root' AS id, NULL AS parent, 'DocumentRoot' AS label, 'order-' || k AS name, k, 'root' AS type, '' AS path, 0 AS depth, NULL AS length, NULL AS pc, NULL AS pl FROM o
  UNION ALL SELECT 'order-' || k || '_customer', 'order-' || k || '_root', 'ObjectNode', 'customer', k, 'dict', 'customer', 1, NULL, c_name, NULL FROM o
  UNION ALL SELECT 'order-' || k || '_lines', 'order-' || k || '_root', 'ArrayNode', 'lines', k, 'list', 'lines', 1, n, NULL, NULL FROM o
  UNION ALL SELECT 'order-' || l.k || '_lines_' || i, 'order-' || l.k || '_lines', 'ObjectNode', 'lines[' || i || ']', l.k, 'dict', 'lines[' || i || ']', 2, NULL, NULL, rf FROM l WHERE l.k IN (SELECT k FROM o)
)
"""
_E = "WITH e AS (SELECT parent_node AS start_id, child_node AS end_id, CASE WHEN trim(type) <> '' THEN trim(type) ELSE 'TIENE' END AS type FROM relations) "
_IX = f"""
WITH n AS (SELECT {_strip('id')} AS nid, {_strip('name')} AS name, {_strip('source')} AS s, {_strip('type')} AS t, id, source, loaded_at FROM graph_nodes),
bi AS (SELECT DISTINCT nid AS key FROM n WHERE nid <> ''),
bn AS (SELECT name AS key, nid FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY loaded_at, id) AS r FROM n WHERE name <> '') WHERE r = 1),
bc AS (SELECT s || '_' || t AS key, nid FROM (SELECT *, row_number() OVER (PARTITION BY s || '_' || t ORDER BY loaded_at, id) AS r FROM n WHERE s <> '' AND t <> '') WHERE r = 1),
so AS (SELECT id, source AS src FROM (SELECT id, source, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, id DESC) AS r FROM n) WHERE r = 1),
q AS (SELECT coalesce(parent_node, '') AS p, coalesce(child_node, '') AS c, {_strip('parent_node')} AS pk, {_strip('child_node')} AS ck, {_strip('type')} AS ty FROM relations),
r AS (SELECT q.*, nullif(CASE WHEN i1.key IS NOT NULL THEN i1.key WHEN n1.key IS NOT NULL THEN n1.nid WHEN contains(pk, '_') THEN c1.nid END, '') AS st, nullif(CASE WHEN i2.key IS NOT NULL THEN i2.key WHEN n2.key IS NOT NULL THEN n2.nid WHEN contains(ck, '_') THEN c2.nid END, '') AS en
  FROM q LEFT JOIN bi i1 ON i1.key = pk LEFT JOIN bn n1 ON n1.key = pk LEFT JOIN bc c1 ON c1.key = pk LEFT JOIN bi i2 ON i2.key = ck LEFT JOIN bn n2 ON n2.key = ck LEFT JOIN bc c2 ON c2.key = ck),
w AS (SELECT r.*, CASE WHEN {_strip('src')} <> '' THEN {_strip('src')} WHEN contains(st, '_') THEN split_part(st, '_', 1) END AS own FROM r LEFT JOIN so ON so.id = st),
x AS (SELECT *, CASE WHEN en IS NULL AND st IS NOT NULL AND own <> '' AND c IN ({', '.join(repr(b) for b in lx.BASE_TYPES)}) THEN own || '_' || c END AS cand FROM w),
y AS (SELECT x.*, coalesce(en, nullif(CASE WHEN i3.key IS NOT NULL THEN i3.key WHEN n3.key IS NOT NULL THEN n3.nid WHEN contains(cand, '_') THEN c3.nid END, '')) AS e2, CASE WHEN ty <> '' THEN ty ELSE 'TIENE' END AS type FROM x LEFT JOIN bi i3 ON i3.key = cand LEFT JOIN bn n3 ON n3.key = cand LEFT JOIN bc c3 ON c3.key = cand)
"""

SQL = {
    "tree_nodes": _TREE + "SELECT id, label, name, 'order-' || k AS source, type, path, depth, CAST(length AS INTEGER) AS length, pc AS prop_c_name, pl AS prop_l_returnflag FROM n",
    "tree_edges": _TREE + "SELECT parent AS start_id, id AS end_id, 'TIENE' AS type, '' AS properties FROM n WHERE parent IS NOT NULL",
    "tree_root_properties": _TREE + "SELECT 'order-' || k || '_root' AS id, 'ObjectNode' AS label, st AS status, pr || '; ' || st AS tags FROM o",
    "tree_edges_per_source": _TREE + "SELECT 'order-' || k AS source, count(*) AS n FROM n WHERE parent IS NOT NULL GROUP BY ALL",
    "tree_labels": _TREE + "SELECT label, count(*) AS n, round(count(*) * 100e0 / sum(count(*)) OVER (), 4) AS percent FROM n GROUP BY label",
    "tree_relations": _TREE + "SELECT 'ROOT' AS parent_node, 'lines' AS child_node, 'lines' AS json_path, count(*) AS n FROM o HAVING count(*) > 0",
    "tree_schema": _TREE + """, t AS (SELECT count(*) AS n FROM o), x(json_path, type, required) AS (VALUES ('$', 'object', false), ('$.o_orderkey', 'integer', true), ('$.o_orderstatus', 'string', true), ('$.customer', 'object', true), ('$.customer.c_name', 'string', true),
        ('$.customer.c_mktsegment', 'string', true), ('$.tags', 'array', true), ('$.tags[]', 'string', false), ('$.lines', 'array', true), ('$.lines[]', 'object', false), ('$.lines[].l_linenumber', 'integer', true), ('$.lines[].l_returnflag', 'string', true), ('$.lines[].l_quantity', 'number', true))
        SELECT json_path, type, n AS documents, required FROM x, t""",
    "graph_metadata": _TREE + """, m AS (SELECT coalesce(nullif(trim(type), ''), 'TIENE') AS type, count(*) AS n FROM relations GROUP BY ALL)
        SELECT (SELECT count(*) FROM n) AS total_nodes, 'id, label, name, source, type, path, depth, length, prop_c_mktsegment, prop_c_name, prop_l_linenumber, prop_l_quantity, prop_l_returnflag' AS columns,
        (SELECT CAST(sum(n) AS BIGINT) FROM m) AS total_relationships, (SELECT string_agg(type || '=' || n, ', ' ORDER BY type) FROM m) AS relationship_types""",
    "tree_events": "SELECT CAST(event_id AS VARCHAR) AS source, 'prop_' || key AS name, props::JSON ->> key AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)",
    "graph_consolidated": "SELECT id, label, name, source, type, path FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at NULLS FIRST, name NULLS FIRST, source NULLS FIRST, label NULLS FIRST, type NULLS FIRST, path NULLS FIRST) AS r FROM graph_nodes) WHERE r = 1",
    "graph_upserted": "SELECT id, label, name, source, type, path, try_cast(depth AS INTEGER) AS depth, try_cast(length AS INTEGER) AS length FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, name DESC NULLS LAST, source DESC NULLS LAST, label DESC NULLS LAST, type DESC NULLS LAST, path DESC NULLS LAST) AS r FROM graph_nodes) WHERE r = 1 AND id IS NOT NULL",
    "graph_resolved": _IX + "SELECT DISTINCT st AS start_id, e2 AS end_id, type FROM y WHERE st IS NOT NULL AND e2 IS NOT NULL",
    "graph_resolved_orphans": _IX + "SELECT DISTINCT coalesce(st, 'ORPHAN::' || p) AS start_id, coalesce(e2, cand, 'ORPHAN::' || c) AS end_id, type FROM y",
    "graph_made_nodes": _IX + """SELECT DISTINCT 'ORPHAN::' || p AS id, p AS name, 'orphan' AS type, 'relations' AS source FROM y WHERE st IS NULL
        UNION SELECT coalesce(cand, 'ORPHAN::' || c), c, CASE WHEN cand IS NULL THEN 'orphan' ELSE c END, CASE WHEN cand IS NULL THEN 'relations' ELSE own END FROM y WHERE e2 IS NULL""",
    "graph_missing_pairs": _IX + "SELECT count(*) AS missing_pairs FROM y WHERE st IS NULL OR e2 IS NULL",
    "graph_loaded_edges": _E + "SELECT start_id, end_id, 'TIENE' AS type, min(type) AS original_type FROM e WHERE start_id IN (SELECT id FROM graph_nodes) AND end_id IN (SELECT id FROM graph_nodes) GROUP BY start_id, end_id",
    "graph_edges_per_source": _E + ", n AS (SELECT id, min(source) AS source FROM graph_nodes GROUP BY id) SELECT source, count(*) AS n FROM e JOIN n ON n.id = start_id WHERE end_id IN (SELECT id FROM graph_nodes) GROUP BY source",
    "graph_connectivity": _E + "SELECT CASE WHEN id IN (SELECT start_id FROM e WHERE start_id IS NOT NULL) THEN 'with relations' ELSE 'without relations' END AS state, count(*) AS n FROM (SELECT DISTINCT id FROM graph_nodes) GROUP BY ALL",
    "graph_isolated": _E + "SELECT DISTINCT id FROM graph_nodes WHERE id NOT IN (SELECT start_id FROM e WHERE start_id IS NOT NULL) AND id NOT IN (SELECT end_id FROM e WHERE end_id IS NOT NULL)",
    "graph_leaves": _E + f"SELECT count(*) AS leaves, round(avg({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in ('id', 'label', 'name', 'source', 'type', 'path', 'depth', 'length', 'prop_role', 'prop_content'))}), 6) AS avg_properties FROM graph_nodes WHERE id NOT IN (SELECT start_id FROM e WHERE start_id IS NOT NULL)",
    "graph_invalid_edges": _E + ", d AS (SELECT coalesce(start_id NOT IN (SELECT id FROM graph_nodes WHERE id IS NOT NULL), true) AS no_start, coalesce(end_id NOT IN (SELECT id FROM graph_nodes WHERE id IS NOT NULL), true) AS no_end FROM e) SELECT no_start, no_end, count(*) AS n FROM d WHERE no_start OR no_end GROUP BY ALL",
    "graph_counts": "SELECT (SELECT count(*) FROM graph_nodes) AS nodes, (SELECT count(*) FROM relations) AS edges",
    "graph_label_shares": "SELECT label, count(*) AS n, round(count(*) * 100e0 / sum(count(*)) OVER (), 4) AS percent FROM graph_nodes GROUP BY label",
    "graph_edge_types": _E + "SELECT type, count(*) AS n FROM e GROUP BY type",
    "graph_deviation": "SELECT source, expected, actual, round(CASE WHEN expected > 0 THEN abs(actual - expected) / CAST(expected AS DOUBLE) * 100 ELSE 0e0 END, 4) AS deviation, CASE WHEN expected > 0 THEN round(abs(actual - expected) / CAST(expected AS DOUBLE) * 100, 4) ELSE 0 END <= 2.0 AS ok FROM (SELECT source, count(DISTINCT id) AS expected, count(*) AS actual FROM graph_nodes WHERE source IS NOT NULL GROUP BY source)",
    "graph_repeated_ids": "SELECT id, count(*) AS n FROM graph_nodes GROUP BY id HAVING count(*) > 1",
}


def queries() -> dict[str, Query]:
    every = (tree_nodes, tree_edges, tree_root_properties, tree_edges_per_source, tree_labels, tree_relations, tree_schema, tree_events, json_clean_report, graph_consolidated, graph_upserted, graph_resolved, graph_resolved_orphans, graph_made_nodes, graph_missing_pairs, graph_captured, graph_loaded_edges, graph_edges_per_source, graph_connectivity, graph_isolated, graph_leaves, graph_invalid_edges, graph_counts, graph_label_shares, graph_edge_types, graph_deviation, graph_repeated_ids, graph_metadata)
    return {f.__name__: f for f in every}
