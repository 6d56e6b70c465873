"""Bulletin pages (url, html) to documents: title, date, section, number, paragraphs; links of an index page.

HTML is read by a tolerant event parser in one Arrow kernel that returns what the page holds; everything decided from
it is column expressions. p and li end where a block begins, as browsers have it; scripts and styles hold no text.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.text import document_name, scraper_clean, strip

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
TEXT_TAGS = ("p", "li", "h1", "h2", "h3", "h4", "blockquote")


class _Node:
    __slots__ = ("attrs", "kids", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def texts(self) -> Iterator[str]:
        stack: list[object] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in ("script", "style"):
                stack.extend(reversed(x.kids))

    def nodes(self) -> Iterator[_Node]:
        stack = [self]
        while stack:
            x = stack.pop()
            yield x
            stack.extend(reversed([k for k in x.kids if not isinstance(k, str)]))


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("#", {})
        self.open = [self.root]

    def _close(self, tag: str, stop: frozenset[str] = frozenset()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close("p", frozenset(("table", "td", "div", "article", "main", "section", "body")))
        if tag == "li":
            self._close("li", frozenset(("ul", "ol")))
        n = _Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(n)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].kids.append(_Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(data)


PAGE = "h1 string, title string, metas array<string>, times array<string>, heads array<string>, numbers array<string>, body array<string>, links array<string>"


def parse(html: str | None) -> dict | None:
    """What a page holds, in document order; null for null and empty pages."""
    if not html:
        return None
    t = _Tree()
    try:
        t.feed(html)
        t.close()
    except (AssertionError, ValueError):
        return None
    every = list(t.root.nodes())

    def some(tags: tuple[str, ...], limit: int) -> list[_Node]:
        return [n for n in every if n.tag in tags][:limit]

    def text(n: _Node, sep: str = "") -> str:
        return sep.join(n.texts())

    def tight(n: _Node) -> str:
        return "".join(s.strip() for s in n.texts())

    rules = (lambda n: n.tag == "div" and "bopv-content" in n.attrs.get("class", "").split(), lambda n: n.tag == "article", lambda n: n.tag == "main", lambda n: n.tag == "div" and n.attrs.get("id") == "contenido", lambda n: n.tag == "body")
    box = next((n for r in rules for n in every if r(n)), None)
    h1, title = some(("h1",), 1), some(("title",), 1)
    return {
        "h1": text(h1[0]) if h1 else None, "title": text(title[0]) if title else None,
        "metas": [n.attrs.get("content", "") for n in every if n.tag == "meta" and "date" in (n.attrs.get("name") or n.attrs.get("property") or "").lower()],
        "times": [text(n) for n in some(("time", "span", "p"), 30)], "heads": [tight(n) for n in some(("h2", "h3", "div", "span"), 20)], "numbers": [tight(n) for n in some(("span", "p", "div"), 30)],
        "body": [text(n, " ") for n in box.nodes() if n is not box and n.tag in TEXT_TAGS] if box else [], "links": [n.attrs["href"] for n in every if n.tag == "a" and "href" in n.attrs],
    }


def page_parts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, language, h, PAGE): what each page holds; language is kept if pages has it."""
    keep = [url, *[c for c in ("language",) if c in pages.columns]]
    names = [x.split()[0] for x in PAGE.split(", ")]
    arrays = [pa.string(), pa.string(), *[pa.list_(pa.string())] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                got = [parse(x) for x in b.column(len(keep)).to_pylist()]
                rows = [i for i, g in enumerate(got) if g is not None]
                take = pa.array(rows, pa.int64())
                cols = [b.column(i).take(take) for i in range(len(keep))]
                cols += [pa.array([got[i][n] for i in rows], t) for n, t in zip(names, arrays, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *names])

    return pages.select(*keep, html).mapInArrow(run, ", ".join(f"`{c}` string" for c in keep) + ", " + PAGE)


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd of a date in one of five spellings; null for anything else."""
    s = F.trim(c)
    tries = [F.when(s.rlike(p), F.date_format(F.try_to_date(s, f), "yyyy-MM-dd")) for p, f in ((r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/y"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-y"), (r"^\d{8}$", "yyyyMMdd"))]
    return F.coalesce(*tries)


def documents(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, language, title, date_published, section, bopv_number, paragraphs, paragraph_count, file_name) of each page.

    Pages that are null or can't be read have no row. Without a language column the address tells it (/eu/, else es).
    """
    d = page_parts(pages, url, html)
    u = F.col(url)
    lang = F.col("language") if "language" in pages.columns else F.when(u.contains("/eu/"), "eu").otherwise("es")
    first = lambda a: F.get(F.filter(a, lambda x: x.isNotNull()), F.lit(0))
    meta = first(F.transform("metas", iso_date))
    in_url = F.regexp_extract(u, r"/(\d{4})/(\d{2})/(\d{2})/", 0)
    seen = first(F.filter(F.transform("times", lambda x: F.regexp_extract(x, r"\b(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})\b", 0)), lambda x: x != ""))
    parts = F.split(seen, r"[/\-.]")
    text_date = F.concat_ws("-", F.get(parts, F.lit(2)), F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.lpad(F.get(parts, F.lit(0)), 2, "0"))
    date = F.coalesce(meta, F.when(in_url != "", F.replace(F.trim(in_url, F.lit("/")), F.lit("/"), F.lit("-"))), F.when(seen.isNotNull(), text_date))
    number_url = F.regexp_extract(u, r"/(\d{8})\.s?html?", 1)
    number_text = first(F.filter(F.transform("numbers", lambda x: F.regexp_extract(x, r"(?i)n[uú]m(?:ero)?[.\s]*:?\s*(\d+)", 1)), lambda x: x != ""))
    number = F.coalesce(F.when(number_url != "", number_url), number_text)
    d = d.withColumns({"_section": first(F.filter("heads", lambda x: x.rlike(r"(?i)^[IVX]+\s*[-–]\s*.+"))), "_title": F.coalesce("h1", "title", F.lit("")), "_lang": lang, "_date": date, "_number": number})
    # paragraphs are cleaned one by one: exploded, cleaned by the same expressions, put back in order within the row
    clean = F.transform("body", lambda x: strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"[\p{C}&&[^\n\t]]", ""), r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")))
    d = d.withColumn("paragraphs", F.filter(clean, lambda x: F.length(x) > 20))
    return d.select(u, F.col("_lang").alias("language"), scraper_clean(F.col("_title")).alias("title"), F.col("_date").alias("date_published"), scraper_clean(F.col("_section")).alias("section"), F.col("_number").alias("bopv_number"), "paragraphs", F.size("paragraphs").alias("paragraph_count"), document_name(F.col("_date"), F.col("_number"), u, F.col("_lang")).alias("file_name"))


def index_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(index_url, ord, url_es, url_eu): links of index pages to documents, each once, in order of first appearance."""
    d = page_parts(pages, url, html).select(F.col(url).alias("index_url"), F.posexplode("links").alias("ord", "href"))
    host = F.regexp_extract("index_url", r"^([a-zA-Z]+://[^/]+)", 1)
    folder = F.regexp_replace("index_url", r"[^/]*$", "")
    absolute = F.when(F.col("href").rlike(r"^[a-zA-Z]+://"), F.col("href")).when(F.col("href").startswith("/"), F.concat(host, "href")).otherwise(F.concat(folder, "href"))
    ok = d.select("index_url", "ord", absolute.alias("url_es")).where(F.col("url_es").rlike(r"(?i)\d{8}\.s?html?$"))
    return ok.groupBy("index_url", "url_es").agg(F.min("ord").alias("ord")).select("index_url", "ord", "url_es", F.replace("url_es", F.lit("/es/"), F.lit("/eu/")).alias("url_eu"))


def language_pages(entries: DataFrame, languages: list[str], max_docs: int | None = None) -> DataFrame:
    """(url, language) of index entries in each language; max_docs counts entries, in the order of ord."""
    if max_docs is not None:
        entries = entries.orderBy("ord").limit(max_docs)
    pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("language"), F.col(f"url_{x}").alias("url")) for x in languages]))
    return entries.select(pairs.alias("p")).select("p.url", "p.language").where("url IS NOT NULL")
