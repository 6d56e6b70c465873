"""Sources: JSON, CSV and HTML files, listings, rules, and the tables that other steps wrote."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.functions import lexicon as lx

CSV = {"header": True, "multiLine": True, "escape": '"', "inferSchema": False}


def list_files(spark: SparkSession, path: str, ext: str = "") -> list[str]:
    """A file itself, or the files directly within a folder whose names end with ext in any case, sorted.

    A path that doesn't exist raises FileNotFoundError. Names are metadata; no file is opened.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        return [path]
    files = (s.getPath().toString() for s in fs.listStatus(p) if s.isFile())
    return sorted(f for f in files if f.lower().endswith(ext.lower()))


def read_json_texts(spark: SparkSession, path: str, pattern: str = "*.json", strict: bool = False) -> DataFrame:
    """(source, file, json, ok): each JSON file as one text; source is its name without the ending.

    ok is false for what can't be read as JSON; with strict such a file ends the query when its row is reached.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("json"))
    ok = F.expr("try_parse_json(json)").isNotNull()
    if strict:
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not JSON: "), F.col("file"))).cast("boolean"))
    return files.select(F.regexp_replace("file", r"(?<=.)\.[^.]*$", "").alias("source"), "file", "json", ok.alias("ok"))


def usable(docs: DataFrame) -> DataFrame:
    """Documents that can be read and hold something: empty objects, lists, strings, zero, false and null are left out."""
    v = F.expr("to_json(try_parse_json(json))")
    return docs.where(F.expr("try_parse_json(json) IS NOT NULL") & ~v.isin("{}", "[]", "null", "0", "0.0", "false", '""'))


def read_layout(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json") -> DataFrame:
    """Layout records of JSON files by a given schema, with `file`; a file that can't be read ends the query."""
    d = spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST", pathGlobFilter=pattern)
    return d.select(F.col("_metadata.file_name").alias("file"), *[F.col(c) for c in schema.names])


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """A block table; page as a number, null where there is none."""
    d = spark.read.csv(path, **CSV).na.fill("")
    return d.withColumn("page", F.col("page").try_cast("int"))


def read_nodes(spark: SparkSession, path: str | list[str], skip: str | None = None) -> DataFrame:
    """Node tables as strings, nulls and what stands for them as empty ones; id, name, type and source always there.

    skip: a file name to leave out, such as that of the consolidated table. _file tells a row's file.
    """
    d = spark.read.csv(path, **CSV).withColumn("_file", F.col("_metadata.file_path"))
    if skip:
        d = d.where(~F.col("_file").endswith(skip))
    for c in ("id", "name", "type", "source"):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(""))
    blank = ("NA", "N/A", "NULL", "null", "None", "NaN", "nan", "n/a", "<NA>", "#N/A")
    return d.select(*[F.when(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").isin(*blank), "").otherwise(F.col(f"`{c}`")).alias(c) for c in d.columns])


def read_relations(spark: SparkSession, paths: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
    """(parent_node, child_node, type, source_file) of several files, and the files left out for lack of columns.

    Only headers are looked at here; the type column goes by several names, and files without one get null types.
    """
    out, left = None, []
    for p in sorted(paths):
        d = spark.read.csv(p, **CSV)
        if not {"parent_node", "child_node"} <= set(d.columns):
            left.append(p)
            continue
        t = next((c for c in lx.RELATION_TYPE_COLUMNS if c in d.columns), None)
        d = d.select(F.coalesce("parent_node", F.lit("")).alias("parent_node"), F.coalesce("child_node", F.lit("")).alias("child_node"), (F.col(t) if t else F.lit(None)).cast("string").alias("type"), F.lit(PurePosixPath(p).name).alias("source_file"))
        out = d if out is None else out.unionByName(d)
    return out, left


def count_csv_rows(spark: SparkSession, path: str, longest: int = 1_310_720) -> int:
    """Rows of a CSV file, its header among them; a malformed row or a longer field ends the count with an error."""
    return spark.read.csv(path, multiLine=True, escape='"', mode="FAILFAST", maxCharsPerColumn=longest, header=False).count()


def table_pairs(spark: SparkSession, path: str) -> list[tuple[str, str, str | None, str | None]]:
    """(nodes, relationships, metadata of each if there) of every X_nodes.csv that has an X_relationships.csv."""
    files = set(list_files(spark, path))
    out = []
    for f in sorted(files):
        if f.endswith("_nodes.csv"):
            stem = f.removesuffix("_nodes.csv")
            if (r := f"{stem}_relationships.csv") in files:
                out.append((f, r, *[m if (m := x.removesuffix(".csv") + ".metadata.json") in files else None for x in (f, r)]))
    return out


def read_pages(spark: SparkSession, path: str, pattern: str = "*.*htm*") -> DataFrame:
    """(url, html) of saved pages; the file's path stands for the address."""
    return spark.read.text(path, wholetext=True, pathGlobFilter=pattern).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def load_rules(path: str | None) -> dict:
    """Replacements and controls to keep, from a YAML or JSON file; nothing for no path or without a YAML reader."""
    if not path:
        return {}
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text) or {}
    try:
        import yaml
    except ImportError:
        return {}
    return yaml.safe_load(text) or {}


def settings(required: tuple[str, ...], env: dict[str, str] | None = None) -> dict[str, str]:
    """Required settings from the environment; KeyError names those that are missing."""
    env = dict(os.environ) if env is None else env
    if missing := [k for k in required if not env.get(k)]:
        raise KeyError(", ".join(missing))
    return {k: env[k] for k in required}
