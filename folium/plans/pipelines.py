"""From files to files: what the command line runs, each step a few operators between a source and a sink."""

from __future__ import annotations

import glob as _glob

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.functions import lexicon as lx
from folium.operators import domain, graph, html, jsontree, language, layout, resolve
from folium.session import cut
from folium.sources import pdf, readers, sinks, web

_SPANS = "array<struct<offset:int,length:int>>"
_REGIONS = "array<struct<pageNumber:int,polygon:array<double>>>"
_PARTS = f"content:string,paragraphs:array<struct<content:string,role:string,kind:string,heading:string,spans:{_SPANS},boundingRegions:{_REGIONS}>>,tables:array<struct<caption:string,spans:{_SPANS},boundingRegions:{_REGIONS},cells:array<struct<rowIndex:int,columnIndex:int,content:string,spans:{_SPANS}>>>>,pages:array<struct<pageNumber:int,lines:array<struct<content:string,text:string,spans:{_SPANS}>>>>"


def layout_schema(spark: SparkSession) -> T.StructType:
    """The fields of a layout record that anything here reads."""
    return spark.createDataFrame([], f"struct<{_PARTS},analyzeResult:struct<{_PARTS}>>").schema


def _counted(df: DataFrame) -> DataFrame:
    return df.withColumn("block_id", F.monotonically_increasing_id())


def clean(spark: SparkSession, path: str, out: str, report: str, *, ext: str = ".json", overwrite: bool = False, dry_run: bool = False, keys: tuple[str, ...] | None = None, rules: dict | None = None) -> DataFrame:
    """Cleaned documents by source and a report; a dry run writes neither. Returns the report."""
    rules = rules or {}
    docs = readers.read_json_texts(spark, path, f"*{ext}").where("ok")
    done = jsontree.clean_json(docs, keys=keys, replace=rules.get("replace"), keep_controls=tuple(rules.get("keep_controls") or ()))
    rep = done.select(F.concat("source", F.lit(ext)).alias("file_in"), F.concat("source", F.lit("_clean" + ext)).alias("file_out"), "strings_total", "strings_changed", "chars_removed", "chars_mapped", F.lit("no" if dry_run else "yes").alias("written"))
    if not dry_run:
        sinks.write_json_documents(done, out, overwrite)
        sinks.write_csv(rep, report)
    return rep


def blocks(spark: SparkSession, path: str, out: str, least_chars: int = 25) -> None:
    """Layout JSON to the block table, by file and position."""
    d = readers.read_layout(spark, path, layout_schema(spark))
    b = layout.blocks(d.withColumn("layout_id", F.col("file")), key="layout_id", least_chars=least_chars)
    sinks.write_csv(b.orderBy("layout_id", "ord").drop("layout_id", "ord"), out)


def search(spark: SparkSession, path: str, out: str) -> None:
    sinks.write_ndjson(layout.search_documents(_counted(readers.read_blocks(spark, path))), out)


def markdown(spark: SparkSession, path: str, out: str) -> None:
    sinks.write_markdown(layout.markdown_parts(_counted(readers.read_blocks(spark, path))), out)


def chunks(spark: SparkSession, path: str, out: str, prefix: str = "") -> None:
    sinks.write_files(layout.chunks(_counted(readers.read_blocks(spark, path)), prefix=prefix), out)


def pages_text(spark: SparkSession, path: str, out: str) -> None:
    """The text of each page, gaps included: all that a rendering needs."""
    d = readers.read_layout(spark, path, layout_schema(spark)).withColumn("layout_id", F.col("file"))
    layout.pages_text(d).write.mode("overwrite").json(out)


def text_pdfs(spark: SparkSession, path: str, out: str, *, size: float = 10, margin: float = 50, sheet: str = "A4") -> None:
    """A text PDF for each layout record."""
    d = readers.read_layout(spark, path, layout_schema(spark)).withColumn("layout_id", F.regexp_replace("file", r"(?<=.)\.[^.]*$", ""))
    pdf.write_pdfs(layout.pages_text(d), out, size=size, margin=margin, sheet=sheet)


def year(spark: SparkSession, index_urls: list[str], languages: list[str], out: str, max_docs: int | None = None, pause: float = web.PAUSE) -> None:
    """All bulletins that index pages link to, fetched and read, by language."""
    sinks.write_documents(web.year_documents(spark, index_urls, languages, max_docs, pause=pause), out)


def tree_graph(spark: SparkSession, path: str, out: str, max_depth: int = 50) -> bool:
    """JSON documents to node and edge tables with metadata."""
    tree = cut(jsontree.tree_rows(readers.usable(readers.read_json_texts(spark, path)), max_depth=max_depth))  # read several times below
    return sinks.write_graph(graph.nodes(tree), graph.edges(tree), out)


def consolidate(spark: SparkSession, path: str, out: str) -> None:
    """All node tables of a folder as one, every id once, the first by file name."""
    n = readers.read_nodes(spark, path, skip=out.rstrip("/").rsplit("/", 1)[-1]).withColumn("_row", F.monotonically_increasing_id())
    sinks.write_csv(graph.keep_first(n, ["id"], ["_file", "_row"]).drop("_file", "_row"), out)


def schemas(spark: SparkSession, path: str, out: str) -> None:
    """Types at each path, and relations between keys, of all documents of a folder."""
    docs = readers.read_json_texts(spark, path).where("ok")
    sinks.write_csv(jsontree.key_types(docs), f"{out}/schema")
    sinks.write_csv(jsontree.relations(docs).select("source", "parent_node", "child_node", "json_path"), f"{out}/relations")


def resolve_relations(spark: SparkSession, nodes: str, relations: str, out: str, orphans_out: str | None = None, *, default_type: str = lx.EDGE_TYPE, merge: str | None = None, allow_orphans: bool = False, capture: bool = False) -> int:
    """Relations to edges; returns how many were left out. merge: edges written before, to be kept."""
    n = readers.read_nodes(spark, nodes).withColumn("_row", F.monotonically_increasing_id())
    rels, _ = readers.read_relations(spark, _glob.glob(relations))
    if rels is None:
        return 0
    rels = rels.withColumn("ord", F.monotonically_increasing_id())
    caught = resolve.capture_bare_types(rels, n, ["_row"]) if capture and allow_orphans else None
    d = resolve.resolve(rels, n, node_order=["_row"], allow_orphans=allow_orphans, default_type=default_type, captures=caught)
    old = spark.read.csv(merge, **readers.CSV) if merge else None
    sinks.write_csv(graph.merge_edges(old, resolve.resolved_edges(d)), out)
    if allow_orphans and orphans_out:
        sinks.write_csv(resolve.made_nodes(d), orphans_out)
    return resolve.unresolved_count(d).first()[0]


def _paragraphs(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(pdoc_id, paragraphs): a field that may be a list, a text, or anything else, of each document."""
    docs = readers.read_json_texts(spark, path).where("ok")
    v = F.expr(f"try_variant_get(try_parse_json(json), '$.{field}', 'array<string>')")
    one = F.expr(f"try_variant_get(try_parse_json(json), '$.{field}', 'string')")
    return docs.select(F.col("source").alias("pdoc_id"), F.coalesce(v, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>")).alias("paragraphs"))


def annotate_language(spark: SparkSession, path: str, out: str, field: str = "paragraphs") -> None:
    """Language of each paragraph and document, as new tables beside the documents."""
    p = language.paragraph_languages(_paragraphs(spark, path, field))
    p.write.mode("overwrite").json(f"{out}/paragraphs")
    language.document_languages(p).write.mode("overwrite").json(f"{out}/documents")


def annotate_domain(spark: SparkSession, path: str, out: str, field: str = "paragraphs", threshold: float = lx.DOMAIN_THRESHOLD) -> None:
    """Domain of each paragraph and document, and the domains' shares, as new tables."""
    d = _paragraphs(spark, path, field)
    p = domain.paragraph_domains(d, threshold=threshold)
    p.write.mode("overwrite").json(f"{out}/paragraphs")
    domain.document_domains(d, threshold=threshold).write.mode("overwrite").json(f"{out}/documents")
    domain.domain_distribution(p).write.mode("overwrite").json(f"{out}/shares")


def bulletin_documents(spark: SparkSession, path: str, out: str) -> None:
    """Saved bulletin pages to documents, those with paragraphs, by language."""
    sinks.write_documents(html.documents(readers.read_pages(spark, path)).where(F.size("paragraphs") > 0), out)
