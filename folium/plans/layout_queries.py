"""Queries of the layout operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators import layout
from folium.plans.text_queries import sql_layout_clean, sql_strip
from folium.session import table

Query = Callable[[SparkSession, str], DataFrame]


def layout_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of every layout record."""
    return layout.blocks(table(spark, d, "layout_docs"))


def layout_pages(spark: SparkSession, d: str) -> DataFrame:
    """The texts of every page, gaps included."""
    p = layout.pages_text(table(spark, d, "layout_docs"))
    return p.select("layout_id", "page", F.size("texts").alias("n_texts"), F.array_join("texts", "\n").alias("text"))


def layout_items(spark: SparkSession, d: str) -> DataFrame:
    """What to draw on each page, with its rectangle."""
    return layout.page_items(table(spark, d, "layout_docs")).select("layout_id", "ord", "page", "kind", "section", "content", "rect.*")


def layout_rectangles(spark: SparkSession, d: str) -> DataFrame:
    """Rectangles of the paragraphs' first polygons."""
    u = layout.unwrapped(table(spark, d, "layout_docs")).select("layout_id", F.posexplode("_paragraphs").alias("pos", "p")).where("p IS NOT NULL")
    return u.select("layout_id", "pos", layout.rectangle(layout.first_polygon(F.col("p.boundingRegions"))).alias("r")).where("r IS NOT NULL").select("layout_id", "pos", "r.*")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ocr_blocks").dropDuplicates(["block_id"])


def search_documents(spark: SparkSession, d: str) -> DataFrame:
    """A search index's documents."""
    return layout.search_documents(_blocks(spark, d))


def markdown_chunks(spark: SparkSession, d: str) -> DataFrame:
    """One Markdown text for each block."""
    return layout.chunks(_blocks(spark, d))


def markdown_documents(spark: SparkSession, d: str) -> DataFrame:
    """One Markdown text for each document."""
    return layout.markdown_documents(_blocks(spark, d))


_PAGE = "list_filter(list_transform(list_filter(x.boundingRegions, lambda r: r IS NOT NULL), lambda r: r.pageNumber), lambda n: n IS NOT NULL)"


def _spans(x: str) -> str:
    return f"coalesce(array_to_string(list_transform(list_filter({x}.spans, lambda s: s IS NOT NULL), lambda s: substring(full_text, coalesce(s.\"offset\", 0) + 1, coalesce(s.length, 0))), ''), '')"


_D = """
WITH d AS (SELECT layout_id, file, coalesce(coalesce(analyzeResult.content, content), '') AS full_text, coalesce(analyzeResult.content, content) AS content0, coalesce(analyzeResult.paragraphs, paragraphs) AS ps, coalesce(analyzeResult.tables, tables) AS ts, coalesce(analyzeResult.pages, pages) AS gs FROM layout_docs),
pa AS (SELECT layout_id, file, full_text, i, ps[i + 1] AS x FROM (SELECT *, unnest(range(len(ps))) AS i FROM d) WHERE ps[i + 1] IS NOT NULL),
ta AS (SELECT layout_id, file, full_text, i, ts[i + 1] AS x FROM (SELECT *, unnest(range(len(ts))) AS i FROM d) WHERE ts[i + 1] IS NOT NULL),
ga AS (SELECT layout_id, file, full_text, i, gs[i + 1] AS x FROM (SELECT *, unnest(range(len(gs))) AS i FROM d) WHERE gs[i + 1] IS NOT NULL),
la AS (SELECT layout_id, file, full_text, i, j, pg, ls[j + 1] AS x FROM (SELECT layout_id, file, full_text, i, x.pageNumber AS pg, x.lines AS ls, unnest(range(len(x.lines))) AS j FROM ga) WHERE ls[j + 1] IS NOT NULL),
"""
_BLOCKS = _D + f"""
ce AS (SELECT layout_id, i, j, coalesce(c.rowIndex, 0) AS r, coalesce(c.columnIndex, 0) AS k, {sql_strip(f"replace(coalesce(CASE WHEN c.content <> '' THEN c.content END, {_spans('c')}), chr(9), ' ')")} AS v
  FROM (SELECT layout_id, full_text, i, j, cs[j + 1] AS c FROM (SELECT layout_id, full_text, i, x.cells AS cs, unnest(range(len(x.cells))) AS j FROM ta)) WHERE c IS NOT NULL),
cl AS (SELECT layout_id, i, r, k, arg_max(v, j) AS v FROM ce GROUP BY ALL),
ro AS (SELECT layout_id, i, r, max(max(k)) OVER (PARTITION BY layout_id, i) AS w FROM cl GROUP BY layout_id, i, r),
gr AS (SELECT layout_id, i, r, unnest(range(w + 1)) AS k FROM ro),
li AS (SELECT gr.layout_id, gr.i, gr.r, string_agg(coalesce(v, ''), chr(9) ORDER BY gr.k) AS line FROM gr LEFT JOIN cl ON cl.layout_id = gr.layout_id AND cl.i = gr.i AND cl.r = gr.r AND cl.k = gr.k GROUP BY ALL),
tv AS (SELECT layout_id, i, string_agg(line, chr(10) ORDER BY r) AS tsv FROM li GROUP BY ALL),
mb AS (
  SELECT layout_id, file, 0 AS g, i, 0 AS j, {_PAGE}[-1] AS page, 'paragraph' AS block_type, coalesce(CASE WHEN x.role <> '' THEN x.role END, CASE WHEN x.kind <> '' THEN x.kind END, '') AS role, coalesce(x.heading, '') AS section,
    {sql_layout_clean(f"coalesce(CASE WHEN x.content <> '' THEN x.content END, {sql_strip(_spans('x'))})")} AS content FROM pa
  UNION ALL
  SELECT ta.layout_id, file, 1, ta.i, 0, {_PAGE}[-1], 'table', '', coalesce(x.caption, ''), {sql_layout_clean(f"coalesce(tsv, {sql_strip(_spans('x'))})")} FROM ta LEFT JOIN tv ON tv.layout_id = ta.layout_id AND tv.i = ta.i
), mk AS (SELECT * FROM mb WHERE content <> ''),
lb AS (SELECT layout_id, file, 2 AS g, i, j, pg AS page, 'line' AS block_type, '' AS role, '' AS section, {sql_layout_clean(f"coalesce(CASE WHEN x.content <> '' THEN x.content END, {sql_strip(_spans('x'))})")} AS content FROM la WHERE layout_id NOT IN (SELECT layout_id FROM mk)),
al AS (SELECT * FROM mk UNION ALL SELECT * FROM lb WHERE content <> ''),
nu AS (SELECT *, CAST(row_number() OVER (PARTITION BY layout_id ORDER BY g, i, j) - 1 AS INTEGER) AS ord FROM al)
SELECT layout_id, ord, regexp_extract(file, '([^/\\\\]*)$', 1) AS file, regexp_replace(regexp_extract(file, '([^/\\\\]*)$', 1), '^(.+)\\.[^.]*$', '\\1') AS doc_title, page, block_type, role, section, content FROM nu WHERE length(content) >= 25
"""
_TXT = "coalesce(CASE WHEN x.content <> '' THEN x.content END, CASE WHEN x.text <> '' THEN x.text END)"
_PAGES = _D + f"""
pp AS (SELECT layout_id, 0 AS a, i, 0 AS j, coalesce({_PAGE}[1], 1) AS g, {sql_strip('x.content')} AS t FROM pa WHERE x.content <> ''),
ll AS (SELECT layout_id, 1 AS a, i, -1 AS j, x.pageNumber AS g, NULL AS t FROM ga WHERE x.pageNumber IS NOT NULL UNION ALL SELECT layout_id, 1, i, j, pg, {sql_strip(_TXT)} FROM la WHERE pg IS NOT NULL AND {_TXT} IS NOT NULL),
ff AS (SELECT layout_id, 2 AS a, 0 AS i, j, 1 AS g, t FROM (SELECT layout_id, j, {sql_strip('parts[j + 1]')} AS t FROM (SELECT layout_id, string_split(content0, chr(10) || chr(10)) AS parts, unnest(range(len(string_split(content0, chr(10) || chr(10))))) AS j FROM d)) WHERE t <> ''),
u AS (SELECT * FROM pp UNION ALL SELECT * FROM ll UNION ALL SELECT * FROM ff),
b AS (SELECT layout_id, min(a) AS a FROM u GROUP BY layout_id),
s AS (SELECT u.* FROM u JOIN b ON u.layout_id = b.layout_id AND u.a = b.a),
m AS (SELECT layout_id, unnest(range(1, max(g) + 1)) AS page FROM s GROUP BY layout_id)
SELECT m.layout_id, CAST(m.page AS INTEGER) AS page, CAST(count(t) AS INTEGER) AS n_texts, coalesce(string_agg(t, chr(10) ORDER BY i, j), '') AS text FROM m LEFT JOIN s ON s.layout_id = m.layout_id AND s.g = m.page GROUP BY ALL
"""
_OCR = "WITH b AS (SELECT block_id, any_value(doc_title) AS doc_title, any_value(page) AS page, any_value(block_type) AS block_type, any_value(role) AS role, any_value(section) AS section, any_value(content) AS content FROM ocr_blocks GROUP BY block_id), k AS (SELECT *, row_number() OVER (ORDER BY block_id) AS k FROM b) "
_S = {c: f"coalesce(CAST({c} AS VARCHAR), '')" for c in ("doc_title", "page", "block_type", "role", "section", "content")}

SQL = {
    "layout_blocks": _BLOCKS,
    "layout_pages": _PAGES,
    "layout_rectangles": _D + """q AS (SELECT layout_id, CAST(i AS INTEGER) AS pos, list_filter(list_transform(list_filter(x.boundingRegions, lambda r: r IS NOT NULL), lambda r: r.polygon), lambda p: len(p) > 0)[1] AS p FROM pa)
        SELECT layout_id, pos, list_min(xs) AS x0, list_min(ys) AS y0, list_max(xs) AS x1, list_max(ys) AS y1 FROM (SELECT layout_id, pos, list_transform(range(0, (len(p) + 1) // 2), lambda k: p[2 * k + 1]) AS xs, list_transform(range(0, len(p) // 2), lambda k: p[2 * k + 2]) AS ys FROM q WHERE len(p) >= 8)""",
    "search_documents": _OCR + f"""SELECT 'mergeOrUpload' AS "@search.action", left(regexp_replace(regexp_replace({_S['doc_title']}, '[^a-zA-Z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 64) || '-p' || {_S['page']} || '-' || lpad(CAST(k AS VARCHAR), 6, '0') AS id,
        {_S['content']} AS content, {_S['doc_title']} AS doc_title, coalesce(page, 0) AS page, {_S['block_type']} AS block_type, {_S['role']} AS role, {_S['section']} AS section, 'pdf' AS source, 'es' AS lang FROM k""",
    "markdown_chunks": _OCR + f"""SELECT CASE WHEN k < 100000 THEN lpad(CAST(k AS VARCHAR), 5, '0') ELSE CAST(k AS VARCHAR) END || '.md' AS chunk_name,
        '# ' || {_S['doc_title']} || ' — p.' || {_S['page']} || ' [' || {_S['block_type']} || ']' || chr(10) || CASE WHEN {_S['section']} <> '' THEN '**' || section || '**' || chr(10) || chr(10) ELSE '' END || regexp_replace({sql_strip(_S['content'])}, '(?m)^[ \\t]+$', '', 'g') || chr(10) AS body FROM k""",
    "markdown_documents": _OCR + f"""SELECT regexp_replace({_S['doc_title']}, '[^\\p{{L}}\\p{{N}}\\-_.]', '-', 'g') || '.md' AS file_name, '# ' || {_S['doc_title']} || chr(10) ||
        string_agg(CASE WHEN {_S['section']} <> '' THEN chr(10) || '## ' || section || ' (p.' || {_S['page']} || ') [' || {_S['block_type']} || ']' ELSE chr(10) || '### p.' || {_S['page']} || ' [' || {_S['block_type']} || ']' END || chr(10) || {sql_strip(_S['content'])} || chr(10), '' ORDER BY coalesce(page, 0), block_id) AS body FROM k GROUP BY coalesce(doc_title, '')""".replace(_S["doc_title"], "coalesce(doc_title, '')"),
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (layout_blocks, layout_pages, layout_items, layout_rectangles, search_documents, markdown_chunks, markdown_documents)}
