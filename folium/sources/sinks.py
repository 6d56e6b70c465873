"""Sinks. All write in parallel from the executors into a folder; none gathers rows at the driver."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from folium.operators import graph


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """With header, quotes doubled once, line breaks within quotes; empty strings stay empty."""
    df.write.csv(path, mode=mode, header=True, escape='"', emptyValue="", quoteAll=False)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, columns in order, characters as they are; null columns are left out."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).write.mode(mode).text(path)


def write_json_documents(docs: DataFrame, path: str, overwrite: bool = False) -> None:
    """(source, json): documents as texts, by source; without overwrite an existing target is left alone."""
    docs.select("source", "json").write.mode("overwrite" if overwrite else "ignore").parquet(path)


def _writer(path: str, name: str, part: str, append: bool):
    def run(rows: Iterator[Row]) -> None:
        os.makedirs(path, exist_ok=True)
        last = None
        for r in rows:
            new = r[name] != last
            with open(os.path.join(path, r[name]), "a" if append and not new else "w", encoding="utf-8", newline="") as f:
                f.write(r[part])
            last = r[name]

    return run


def write_files(df: DataFrame, path: str, name: str = "chunk_name", body: str = "body") -> None:
    """One file a row, in a folder that all executors share; writing a row again gives the same file."""
    df.select(name, body).foreachPartition(_writer(path, name, body, append=False))


def write_markdown(parts: DataFrame, path: str, order: str = "block_id") -> None:
    """One file a document from its parts, which arrive sorted, so no document is held as a whole.

    All parts of a document meet in one partition; a lost task writes its files again from the start.
    """
    sorted_parts = parts.repartition("file_name").sortWithinPartitions("file_name", "page", order)
    title = F.concat(F.lit("# "), "doc_title", F.lit("\n"))
    first = F.lag("file_name").over(Window.partitionBy("file_name").orderBy("page", order)).isNull()
    sorted_parts.select("file_name", "page", order, F.when(first, F.concat(title, "part")).otherwise(F.col("part")).alias("part")).sortWithinPartitions("file_name", "page", order).select("file_name", "part").foreachPartition(_writer(path, "file_name", "part", append=True))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Node and edge tables with their metadata as JSON beside them; False, and nothing written, without nodes."""
    if nodes.isEmpty():
        return False
    write_csv(graph.wide_nodes(nodes), f"{path}/nodes", mode)
    write_csv(edges, f"{path}/relationships", mode)
    n, e = graph.metadata(nodes, edges)
    n.withColumn("file_type", F.lit("nodes")).withColumn("generated_at", F.current_timestamp()).write.mode(mode).json(f"{path}/nodes.metadata")
    e.withColumn("file_type", F.lit("relationships")).withColumn("generated_at", F.current_timestamp()).write.mode(mode).json(f"{path}/relationships.metadata")
    return True


def write_graph_store(nodes: DataFrame, edges: DataFrame, path: str, buckets: int = 64) -> None:
    """A store to join by id: nodes and edges bucketed by the same number, so later joins on id need no shuffle."""
    nodes.write.mode("overwrite").option("path", f"{path}/nodes").bucketBy(buckets, "id").sortBy("id").saveAsTable("graph_store_nodes")
    edges.write.mode("overwrite").option("path", f"{path}/edges").bucketBy(buckets, "start_id").sortBy("start_id").saveAsTable("graph_store_edges")


def append_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Rows as they are, nothing joined and nothing made unique."""
    nodes.write.mode("append").parquet(f"{path}/nodes")
    edges.write.mode("append").parquet(f"{path}/edges")


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bulletin documents as JSON, by language; file_name tells what each would be called by itself."""
    docs.write.mode(mode).partitionBy("language").json(path)


def stage(df: DataFrame, path: str) -> None:
    """A clean import folder with this table alone."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')
