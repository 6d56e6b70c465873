"""Queries of the page operators, on pages written from the bulletin index, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators import html
from folium.session import table

Query = Callable[[SparkSession, str], DataFrame]


def bulletin_pages(spark: SparkSession, d: str) -> DataFrame:
    """(url, html): a page for each index entry, with unclosed paragraphs, a script, and comments."""
    b = table(spark, d, "bulletin_index").groupBy("url_es").agg(F.min_by(F.struct("title", "section", "date_published", "bopv_number"), "entry_id").alias("b")).select("url_es", "b.*")
    t = F.coalesce(F.concat(F.lit("<h1>"), "title", F.lit("</h1>")), F.lit(""))
    meta = F.coalesce(F.concat(F.lit('<meta name="DC.date" content="'), F.date_format(F.to_date("date_published"), "dd/MM/yyyy"), F.lit('">')), F.lit(""))
    sec = F.coalesce(F.concat(F.lit("<h2>"), "section", F.lit("</h2>")), F.lit(""))
    page = F.concat(F.lit("<!DOCTYPE html><html><head><title>Anuncio "), F.coalesce("bopv_number", F.lit("s/n")), F.lit("</title>"), meta, F.lit('<script>var a = "</p>";</script></head><body><nav><a href="/">Inicio</a></nav><!-- x -->'), sec, F.lit('<div class="bopv-content">'), t,
                    F.lit("<p>Primer p&aacute;rrafo <b>del anuncio</b> n.&ordm; uno.<p>corto<ul><li>Elemento de lista bastante largo<li>otro</ul><p>Segundo   párrafo con blancos.</div><footer>Pie</footer></body></html>"))
    return b.select(F.col("url_es").alias("url"), page.alias("html"))


def page_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents read from the pages."""
    p = html.documents(bulletin_pages(spark, d))
    return p.select("url", "language", "title", "date_published", "section", "bopv_number", "paragraph_count", F.array_join("paragraphs", "|").alias("text"), "file_name")


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links from a year's index page to its bulletins, with the address of the other language."""
    b = table(spark, d, "bulletin_index").select("year", "url_es").distinct()
    links = F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('<li><a href="'), "url_es", F.lit('">x</a><a href="/aviso.pdf">y</a>')))), "")
    pages = b.groupBy("year").agg(links.alias("l")).select(F.concat(F.lit("https://gaceta.example/es/bopv/"), F.col("year").cast("string"), F.lit("/index.shtml")).alias("url"), F.concat(F.lit("<ul>"), "l", F.lit("</ul>")).alias("html"))
    return html.index_links(pages).select("index_url", "url_es", "url_eu")


def page_urls(spark: SparkSession, d: str) -> DataFrame:
    """Every entry's addresses in each language."""
    e = table(spark, d, "bulletin_index").select("url_es", "url_eu").distinct()
    return html.language_pages(e, ["es", "eu"]).distinct()


SQL = {
    "page_documents": f"""WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_es ORDER BY entry_id) AS r FROM bulletin_index WHERE url_es IS NOT NULL) WHERE r = 1),
        c AS (SELECT url_es AS url, CASE WHEN contains(url_es, '/eu/') THEN 'eu' ELSE 'es' END AS language, coalesce(title, 'Anuncio ' || coalesce(bopv_number, 's/n')) AS title, date_published, CASE WHEN regexp_matches(section, '(?i)^[IVX]+\\s*[-–]\\s*.+') THEN section END AS section, nullif(regexp_extract(url_es, '/(\\d{{8}})\\.s?html?', 1), '') AS bopv_number, title AS h1 FROM b),
        p AS (SELECT *, list_filter([h1, 'Primer párrafo del anuncio n.º uno.', 'corto', 'Elemento de lista bastante largo', 'otro', 'Segundo párrafo con blancos.'], lambda x: length(x) > 20) AS ps FROM c)
        SELECT url, language, title, date_published, section, bopv_number, CAST(len(ps) AS INTEGER) AS paragraph_count, array_to_string(ps, '|') AS text, 'bopv_' || coalesce(date_published, 'unknown-date') || '_' || bopv_number || '_' || language || '.json' AS file_name FROM p""",
    "page_links": "SELECT DISTINCT 'https://gaceta.example/es/bopv/' || year || '/index.shtml' AS index_url, url_es, replace(url_es, '/es/', '/eu/') AS url_eu FROM bulletin_index WHERE regexp_matches(url_es, '(?i)\\d{8}\\.s?html?$')",
    "page_urls": "SELECT DISTINCT url_es AS url, 'es' AS language FROM bulletin_index WHERE url_es IS NOT NULL UNION SELECT DISTINCT url_eu, 'eu' FROM bulletin_index WHERE url_eu IS NOT NULL",
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (page_documents, page_links, page_urls)}
