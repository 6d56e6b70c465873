"""Checks and summaries of a graph: counts, connectivity, deviations from what was expected, keys that should be unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_per_source(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(source, n): edges whose ends are both there, by the start node's source, most first."""
    n = nodes.select("id", "source").dropDuplicates(["id"])
    ok = edges.join(n.select(F.col("id").alias("end_id")), "end_id", "left_semi").join(n.withColumnRenamed("id", "start_id"), "start_id")
    return ok.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def connectivity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(state, n): nodes with and without an outgoing edge."""
    out = edges.select(F.col("start_id").alias("id")).distinct().withColumn("_o", F.lit(1))
    ids = nodes.select("id").distinct()
    return ids.join(out, "id", "left").groupBy(F.when(F.col("_o").isNotNull(), "with relations").otherwise("without relations").alias("state")).agg(F.count("*").alias("n"))


def isolated(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id) of the nodes at no end of an edge."""
    ends = edges.select(F.explode(F.array("start_id", "end_id")).alias("id")).distinct()
    return nodes.select("id").distinct().join(ends, "id", "left_anti")


def leaves(edges: DataFrame, nodes: DataFrame, property_columns: list[str]) -> DataFrame:
    """(leaves, avg_properties): nodes without an outgoing edge, and how many of the columns they have on average."""
    n = sum((F.col(c).isNotNull().cast("int") for c in property_columns[1:]), F.col(property_columns[0]).isNotNull().cast("int"))
    rows = nodes.withColumn("_n", n).join(edges.select(F.col("start_id").alias("id")).distinct(), "id", "left_anti")
    return rows.agg(F.count("*").alias("leaves"), F.round(F.avg("_n"), 6).alias("avg_properties"))


def invalid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that is null or isn't there, and which one."""
    ids = nodes.select("id").where("id IS NOT NULL").distinct()
    d = edges.join(ids.select(F.col("id").alias("_a")), F.col("start_id") == F.col("_a"), "left").join(ids.select(F.col("id").alias("_b")), F.col("end_id") == F.col("_b"), "left")
    return d.where("_a IS NULL OR _b IS NULL").withColumns({"no_start": F.col("_a").isNull(), "no_end": F.col("_b").isNull()}).drop("_a", "_b")


def deviation(expected: DataFrame, actual: DataFrame, keys: list[str], threshold: float = 2.0) -> DataFrame:
    """keys with expected, actual, deviation (percent of expected, 0 if nothing was expected) and ok."""
    j = expected.join(actual, keys, "full").select(*keys, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))
    dev = F.when(F.col("expected") > 0, F.abs(F.col("actual") - F.col("expected")) / F.col("expected") * 100).otherwise(F.lit(0.0))
    return j.withColumn("deviation", F.round(dev, 4)).withColumn("ok", F.col("deviation") <= threshold)


def shares(df: DataFrame, by: str) -> DataFrame:
    """(by, n, percent): each value's part of all rows. The total is one row, counted apart."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    whole = df.agg(F.count("*").alias("_all"))
    return n.crossJoin(F.broadcast(whole)).select(by, "n", F.round(F.col("n") * 100.0 / F.col("_all"), 4).alias("percent"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys that should be unique and aren't, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
