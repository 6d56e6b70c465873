"""Layout records to blocks, pages, items, search documents, Markdown and chunks.

A record's arrays become blocks by expressions within its row and one explode: no shuffle, no Python. Order within a
record is kept as `ord`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.ordering import number_rows
from folium.functions.text import dedent, file_name, layout_clean, slug, strip

ROOTS = ("content", "paragraphs", "tables", "pages")


def unwrapped(df: DataFrame) -> DataFrame:
    """df with content, paragraphs, tables and pages taken from analyzeResult where that has them."""
    inner = F.col("analyzeResult") if "analyzeResult" in df.columns else None
    return df.withColumns({f"_{c}": F.coalesce(inner.getField(c), F.col(c)) if inner is not None else F.col(c) for c in ROOTS})


def _some(c: Column) -> Column:
    """Null for null and empty strings, which count as absent."""
    return F.when(c != "", c)


def _real(array: Column) -> Column:
    return F.filter(array, lambda x: x.isNotNull())


def span_text(full: Column, spans: Column) -> Column:
    """The pieces of full that the spans name, one after another, blanks kept."""
    parts = F.transform(_real(spans), lambda s: F.substring(F.coalesce(full, F.lit("")), F.coalesce(s["offset"], F.lit(0)) + 1, F.coalesce(s["length"], F.lit(0))))
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def last_page(regions: Column) -> Column:
    """The page of the last region that has one."""
    return F.try_element_at(F.filter(F.transform(_real(regions), lambda r: r["pageNumber"]), lambda p: p.isNotNull()), F.lit(-1))


def first_page(regions: Column) -> Column:
    return F.get(F.filter(F.transform(_real(regions), lambda r: r["pageNumber"]), lambda p: p.isNotNull()), F.lit(0))


def first_polygon(regions: Column) -> Column:
    return F.get(F.filter(F.transform(_real(regions), lambda r: r["polygon"]), lambda p: F.size(p) > 0), F.lit(0))


def rectangle(polygon: Column) -> Column:
    """struct(x0, y0, x1, y1) around the points; null for fewer than four points."""
    xs, ys = F.filter(polygon, lambda x, i: i % 2 == 0), F.filter(polygon, lambda x, i: i % 2 == 1)
    return F.when(F.size(polygon) >= 8, F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")))


def table_tsv(full: Column, t: Column, trim_spans: bool = True) -> Column:
    """A table as lines of cells. Of two cells in one place the last wins; rows that have no cell are left out.

    A cell without content takes its spans' text; a table without cells its own spans' text.
    """
    whole = span_text(full, t["spans"])

    def value(c: Column) -> Column:
        s = span_text(full, c["spans"])
        return strip(F.replace(F.coalesce(_some(c["content"]), s), F.lit("\t"), F.lit(" ")))

    cells = F.transform(_real(t["cells"]), lambda c: F.struct(F.coalesce(c["rowIndex"], F.lit(0)).alias("r"), F.coalesce(c["columnIndex"], F.lit(0)).alias("k"), value(c).alias("v")))
    rows = F.array_sort(F.array_distinct(F.transform(cells, lambda c: c["r"])))
    width = F.array_max(F.transform(cells, lambda c: c["k"]))

    def line(r: Column) -> Column:
        own = F.filter(cells, lambda c: c["r"] == r)
        return F.array_join(F.transform(F.sequence(F.lit(0), width), lambda k: F.coalesce(F.try_element_at(F.filter(own, lambda c: c["k"] == k), F.lit(-1))["v"], F.lit(""))), "\t")

    empty = strip(whole) if trim_spans else whole
    return F.when(F.size(cells) > 0, F.array_join(F.transform(rows, line), "\n")).otherwise(empty)


def blocks(df: DataFrame, key: str = "layout_id", file: str = "file", least_chars: int = 25) -> DataFrame:
    """(key, ord, file, doc_title, page, block_type, role, section, content): paragraphs, then tables, of each record.

    A record that has neither gives its pages' lines. Texts are cleaned; empty ones and those shorter than least_chars
    are left out (a record's lines stand in only if all else is empty, not if it is short). page is that of the last
    region, null without one; ord is the position among the record's blocks before anything is left out.
    """
    d = unwrapped(df)
    full = F.col("_content")
    none = F.lit(None).cast("int")

    def row(page: Column, kind: str, role: Column, section: Column, text: Column) -> Column:
        return F.struct(page.cast("int").alias("page"), F.lit(kind).alias("block_type"), role.alias("role"), section.alias("section"), layout_clean(text).alias("content"))

    def text_of(x: Column) -> Column:
        return F.coalesce(_some(x["content"]), strip(span_text(full, x["spans"])))

    p = F.transform(_real(F.col("_paragraphs")), lambda x: row(last_page(x["boundingRegions"]), "paragraph", F.coalesce(_some(x["role"]), _some(x["kind"]), F.lit("")), F.coalesce(x["heading"], F.lit("")), text_of(x)))
    t = F.transform(_real(F.col("_tables")), lambda x: row(last_page(x["boundingRegions"]), "table", F.lit(""), F.coalesce(x["caption"], F.lit("")), table_tsv(full, x)))
    kind = "array<struct<page:int,block_type:string,role:string,section:string,content:string>>"
    empty = F.from_json(F.lit("[]"), kind)
    lines = F.flatten(F.transform(_real(F.col("_pages")), lambda g: F.coalesce(F.transform(_real(g["lines"]), lambda x: row(F.coalesce(g["pageNumber"], none), "line", F.lit(""), F.lit(""), text_of(x))), empty)))
    d = d.withColumn("_main", F.filter(F.concat(F.coalesce(p.cast(kind), empty), F.coalesce(t.cast(kind), empty)), lambda x: x["content"] != ""))
    d = d.withColumn("_all", F.when(F.size("_main") > 0, F.col("_main")).otherwise(F.filter(F.coalesce(lines.cast(kind), empty), lambda x: x["content"] != "")))
    out = d.select(key, F.col(file).alias("_file"), F.posexplode("_all").alias("ord", "b"))
    base = F.regexp_extract("_file", r"([^/\\]*)$", 1)
    return out.select(key, "ord", base.alias("file"), F.regexp_replace(base, r"(?<=.)\.[^.]*$", "").alias("doc_title"), "b.*").where(F.length("content") >= least_chars)


def pages_text(df: DataFrame, key: str = "layout_id") -> DataFrame:
    """(key, page, texts): the texts of every page from 1 to the last, those without text as an empty array.

    Paragraphs by their first region's page (1 without one); if none has content, the pages' lines; if there are none
    either, the whole content divided at empty lines, as page 1. A record with nothing has no row.
    """
    d = unwrapped(df)
    ps = F.transform(F.filter(F.col("_paragraphs"), lambda x: x.isNotNull() & (x["content"] != "")), lambda x: F.struct(F.coalesce(first_page(x["boundingRegions"]), F.lit(1)).alias("g"), strip(x["content"]).alias("t")))
    kind = "array<struct<g:int,t:string>>"
    empty = F.from_json(F.lit("[]"), kind)
    # a page without lines still counts as a page
    ls = F.flatten(F.transform(F.filter(F.col("_pages"), lambda g: g.isNotNull() & g["pageNumber"].isNotNull()), lambda g: F.concat(
        F.array(F.struct(g["pageNumber"].alias("g"), F.lit(None).cast("string").alias("t"))),
        F.coalesce(F.transform(F.filter(g["lines"], lambda x: x.isNotNull() & F.coalesce(_some(x["content"]), _some(x["text"])).isNotNull()), lambda x: F.struct(g["pageNumber"].alias("g"), strip(F.coalesce(_some(x["content"]), _some(x["text"]))).alias("t"))), F.array().cast(kind)))))
    parts = F.filter(F.transform(F.split("_content", "\n\n"), strip), lambda x: x != "")
    flat = F.transform(parts, lambda x: F.struct(F.lit(1).alias("g"), x.alias("t")))
    d = d.withColumns({"_ps": F.coalesce(ps.cast(kind), empty), "_ls": F.coalesce(ls.cast(kind), empty), "_fs": F.coalesce(flat.cast(kind), empty)})
    best = F.when(F.size("_ps") > 0, F.col("_ps")).when(F.size("_ls") > 0, F.col("_ls")).otherwise(F.col("_fs"))
    d = d.withColumn("_x", best).where(F.size("_x") > 0).withColumn("_last", F.array_max(F.transform("_x", lambda x: x["g"])))
    d = d.where("_last >= 1").select(key, "_x", F.explode(F.sequence(F.lit(1), F.col("_last"))).alias("page"))
    return d.select(key, "page", F.filter(F.transform(F.filter("_x", lambda x: x["g"] == F.col("page")), lambda x: x["t"]), lambda t: t.isNotNull()).alias("texts"))


def markdown_table(tsv: Column) -> Column:
    """A table's lines as a Markdown table; empty for none."""
    rows = F.transform(F.filter(F.split(tsv, "\n"), lambda x: strip(x) != ""), lambda x: F.split(x, "\t"))
    mark = F.transform(rows, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(F.get(rows, F.lit(0)), lambda x: F.lit("---")), " | "), F.lit(" |"))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(mark, 1, 1), F.array(rule), F.slice(mark, 2, F.greatest(F.size(mark) - 1, F.lit(0)))), "\n")).otherwise("")


def page_items(df: DataFrame, key: str = "layout_id") -> DataFrame:
    """(key, ord, page, kind, section, content, rect): what to draw on each page; rect is null without a full polygon.

    Items without a page are left out, then empty ones; lines stand in where no paragraph or table has a page.
    """
    d = unwrapped(df)
    full = F.col("_content")
    kind = "array<struct<page:int,kind:string,section:string,content:string,polygon:array<double>>>"
    empty = F.from_json(F.lit("[]"), kind)

    def row(page: Column, what: str, section: Column, text: Column, poly: Column) -> Column:
        return F.struct(page.cast("int").alias("page"), F.lit(what).alias("kind"), section.alias("section"), layout_clean(text).alias("content"), poly.alias("polygon"))

    def text_of(x: Column) -> Column:
        return F.coalesce(_some(x["content"]), span_text(full, x["spans"]))

    p = F.transform(_real(F.col("_paragraphs")), lambda x: row(last_page(x["boundingRegions"]), "paragraph", F.coalesce(_some(x["heading"]), _some(x["role"]), F.lit("")), text_of(x), first_polygon(x["boundingRegions"])))

    # the tables' texts are a column of their own, since the Markdown names them several times
    tsvs = F.transform(_real(F.col("_tables")), lambda x: F.when(F.size(_real(x["cells"])) > 0, table_tsv(full, x, trim_spans=False)).otherwise(layout_clean(span_text(full, x["spans"]))))
    d = d.withColumn("_tsvs", tsvs).withColumn("_mds", F.transform("_tsvs", markdown_table))

    def table(x: Column, i: Column) -> Column:
        tsv, md = F.get("_tsvs", i), F.get("_mds", i)
        return row(last_page(x["boundingRegions"]), "table", F.coalesce(x["caption"], F.lit("")), F.when(md != "", md).otherwise(tsv), first_polygon(x["boundingRegions"]))

    t = F.transform(_real(F.col("_tables")), table)
    ls = F.flatten(F.transform(_real(F.col("_pages")), lambda g: F.coalesce(F.transform(_real(g["lines"]), lambda x: row(g["pageNumber"], "line", F.lit(""), text_of(x), F.lit(None).cast("array<double>"))), F.array().cast(kind))))
    d = d.withColumn("_main", F.filter(F.concat(F.coalesce(p.cast(kind), empty), F.coalesce(t.cast(kind), empty)), lambda x: x["page"].isNotNull()))
    d = d.withColumn("_all", F.when(F.size("_main") > 0, F.col("_main")).otherwise(F.filter(F.coalesce(ls.cast(kind), empty), lambda x: x["page"].isNotNull())))
    out = d.select(key, F.posexplode("_all").alias("ord", "i")).where("i.content <> ''")
    return out.select(key, "ord", "i.page", "i.kind", "i.section", "i.content", rectangle(F.col("i.polygon")).alias("rect"))


def pages_in_range(items: DataFrame, n_pages: int) -> DataFrame:
    """Items of pages 1 to n_pages, by page."""
    return items.where((F.col("page") >= 1) & (F.col("page") <= n_pages)).orderBy("page")


def search_documents(block_rows: DataFrame, order: tuple[str, ...] = ("block_id",)) -> DataFrame:
    """The documents of a search index, one for each block, numbered in the order given (which must be total)."""
    d = number_rows(block_rows, *order)
    page = F.coalesce(F.col("page").cast("string"), F.lit(""))
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("content", "doc_title", "block_type", "role", "section")}
    return d.select(
        F.lit("mergeOrUpload").alias("@search.action"), F.concat(slug(F.col("doc_title")), F.lit("-p"), page, F.lit("-"), F.lpad(F.col("k").cast("string"), 6, "0")).alias("id"),
        text["content"].alias("content"), text["doc_title"].alias("doc_title"), F.coalesce(F.col("page"), F.lit(0)).cast("int").alias("page"), text["block_type"].alias("block_type"), text["role"].alias("role"), text["section"].alias("section"), F.lit("pdf").alias("source"), F.lit("es").alias("lang"))


def chunks(block_rows: DataFrame, order: tuple[str, ...] = ("block_id",), prefix: str = "") -> DataFrame:
    """(chunk_name, body): one Markdown text for each block."""
    d = number_rows(block_rows, *order)
    s = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_title", "page", "block_type", "section", "content")}
    head = F.concat(F.lit("# "), s["doc_title"], F.lit(" — p."), s["page"], F.lit(" ["), s["block_type"], F.lit("]\n"))
    bold = F.when(s["section"] != "", F.concat(F.lit("**"), s["section"], F.lit("**\n\n"))).otherwise("")
    name = F.concat(F.lit(prefix), F.when(F.col("k") < 100000, F.lpad(F.col("k").cast("string"), 5, "0")).otherwise(F.col("k").cast("string")), F.lit(".md"))
    return d.select(name.alias("chunk_name"), F.concat(head, bold, dedent(strip(s["content"])), F.lit("\n")).alias("body"))


def markdown_parts(block_rows: DataFrame, order: str = "block_id") -> DataFrame:
    """(file_name, doc_title, page, order, part): a document's Markdown in pieces; sorted by page and order they make its text.

    A file is written by sorting within its partition and appending, so a long document is never held as one value.
    """
    s = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_title", "page", "block_type", "section", "content")}
    head = F.when(s["section"] != "", F.concat(F.lit("\n## "), s["section"], F.lit(" (p."), s["page"], F.lit(") ["), s["block_type"], F.lit("]\n"))).otherwise(F.concat(F.lit("\n### p."), s["page"], F.lit(" ["), s["block_type"], F.lit("]\n")))
    return block_rows.select(F.concat(file_name(s["doc_title"]), F.lit(".md")).alias("file_name"), s["doc_title"].alias("doc_title"), F.coalesce(F.col("page"), F.lit(0)).alias("page"), order, F.concat(head, strip(s["content"]), F.lit("\n")).alias("part"))


def markdown_documents(block_rows: DataFrame, order: str = "block_id") -> DataFrame:
    """(file_name, body): one Markdown text for each document, for documents that fit a row."""
    p = markdown_parts(block_rows, order)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page", order, "part"))), lambda x: x["part"])
    return p.groupBy("file_name", "doc_title").agg(parts.alias("p")).select("file_name", F.concat(F.lit("# "), "doc_title", F.lit("\n"), F.array_join("p", "")).alias("body"))
