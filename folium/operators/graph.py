"""Property graphs from tree rows: nodes, edges, consolidation, loading, and checks of what was loaded.

Nodes are (id, label, name, source, type, path, depth, length, props); edges (start_id, end_id, type, properties).
Whatever keeps the first of several rows does so by an explicit order, as an aggregate that combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.functions import lexicon as lx

BASE = ["id", "label", "name", "source", "type", "path", "depth"]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each value of keys: the first by order. Rows equal in order are interchangeable only if equal."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(first.alias("_f")).select(*keys, "_f.*").select(*df.columns)


def first_visits(tree: DataFrame) -> DataFrame:
    """Tree rows of documents that share a source, every id once: for documents delivered more than once."""
    return keep_first(tree, ["id"], ["source", "ord"])


def nodes(tree: DataFrame) -> DataFrame:
    """The nodes of tree rows; ids are already unique within a document, so nothing is shuffled."""
    return tree.select(*BASE, "length", "props")


def edges(tree: DataFrame) -> DataFrame:
    """An edge for each node, from the structure that holds it; none from a node to itself."""
    f = tree.where("parent_id IS NOT NULL AND parent_id <> id")
    return f.select(F.col("parent_id").alias("start_id"), F.col("id").alias("end_id"), F.lit(lx.EDGE_TYPE).alias("type"), F.lit("").alias("properties"))


def property_names(node_rows: DataFrame) -> list[str]:
    """All property names, sorted: the columns of a wide table. Their number is the schema's, not the data's."""
    return sorted(r[0] for r in node_rows.select(F.explode(F.map_keys("props")).alias("k")).distinct().collect())


def wide_nodes(node_rows: DataFrame) -> DataFrame:
    """Nodes with a column for each property: seven fixed ones, the rest sorted; all strings, absent ones empty."""
    names = property_names(node_rows)
    if not node_rows.columns.count("length"):
        node_rows = node_rows.withColumn("length", F.lit(None).cast("string"))
    rest = sorted(["length", *names])
    cols = {"length": F.col("length").cast("string")} | {n: F.col("props")[n] for n in names}
    return node_rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in BASE], *[F.coalesce(cols[c], F.lit("")).alias(c) for c in rest])


def metadata(node_rows: DataFrame, edge_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(total_nodes, columns) and (total_relationships, relationship_types map): what goes beside the tables."""
    names = node_rows.agg(F.count("*").alias("total_nodes"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.map_keys("props"))))).alias("p"))
    n = names.select("total_nodes", F.concat(F.array(*[F.lit(c) for c in [*BASE, "length"]]), "p").alias("columns"))
    types = edge_histogram(edge_rows)
    e = types.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_relationships"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("relationship_types"))
    return n, e


def edge_histogram(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.groupBy("type").agg(F.count("*").alias("n"))


def consolidate(parts: list[DataFrame], order: list[str]) -> DataFrame:
    """Node tables of different columns as one, every id once: the first by the part's place and order within it."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return keep_first(out, ["id"], ["_part", *order]).drop("_part")


def distinct_edges(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.dropDuplicates(["start_id", "end_id", "type"])


def merge_edges(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Edges of both, each once; old ones without the columns count as none."""
    cols = ["start_id", "end_id", "type"]
    if old is None or not set(cols) <= set(old.columns):
        return distinct_edges(new.select(*cols))
    return distinct_edges(old.select(*cols).unionByName(new.select(*cols)))


def upsert_nodes(store: DataFrame | None, new: DataFrame, order: list[str]) -> DataFrame:
    """The store after loading new nodes by id: the last by order wins. depth and length become whole numbers."""
    rows = new.withColumns({c: F.col(c).try_cast("int") for c in ("depth", "length") if c in new.columns}).where("id IS NOT NULL")
    rest = [c for c in rows.columns if c != "id"]
    last = rows.groupBy("id").agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_l")).select("id", "_l.*")
    if store is None:
        return last
    return store.join(last.select("id"), "id", "left_anti").unionByName(last, allowMissingColumns=True)


def load_edges(edge_rows: DataFrame, node_rows: DataFrame) -> DataFrame:
    """Edges whose ends are both there, one for each pair of ends, with original_type; the smallest type of several."""
    ids = node_rows.select("id").distinct()
    ok = edge_rows.join(ids.withColumnRenamed("id", "start_id"), "start_id", "left_semi").join(ids.withColumnRenamed("id", "end_id"), "end_id", "left_semi")
    return ok.groupBy("start_id", "end_id").agg(F.min("type").alias("original_type")).select("start_id", "end_id", F.lit(lx.EDGE_TYPE).alias("type"), "original_type")
