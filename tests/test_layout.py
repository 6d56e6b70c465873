from pyspark.sql import functions as F

from folium.operators import layout
from folium.session import table
from tests.conftest import TINY, rows

P = "array<struct<content:string,role:string,kind:string,heading:string,spans:array<struct<offset:int,length:int>>,boundingRegions:array<struct<pageNumber:int,polygon:array<double>>>>>"
TB = "array<struct<caption:string,spans:array<struct<offset:int,length:int>>,boundingRegions:array<struct<pageNumber:int,polygon:array<double>>>,cells:array<struct<rowIndex:int,columnIndex:int,content:string,spans:array<struct<offset:int,length:int>>>>>>"
G = "array<struct<pageNumber:int,lines:array<struct<content:string,text:string,spans:array<struct<offset:int,length:int>>>>>>"
SCHEMA = f"layout_id long, file string, content string, paragraphs {P}, tables {TB}, pages {G}, analyzeResult struct<content:string,paragraphs:{P},tables:{TB},pages:{G}>"
SQ = [0.0, 0.0, 4.0, 0.0, 4.0, 2.0, 0.0, 2.0]


def records(spark):
    full = "Un texto bastante largo para un bloque. Otro texto que sale solo de los spans."
    paras = [("Un texto bastante largo para un bloque.", None, "note", "H", None, [(1, []), (2, SQ)]), None, ("", "title", None, None, [(40, 38)], None), ("corto", None, None, None, None, None)]
    cells = [(0, 1, "b", None), (2, 0, "a\tz", None), (0, 1, "B", None), (2, 2, None, [(0, 2)]), None]
    tables = [("Cap", None, [(3, [1.0])], cells), (None, [(0, 39)], None, [])]
    pages = [(1, [("linea que solo cuenta si no hay mas", None, None)]), (3, [(None, "texto de linea", None), None])]
    return spark.createDataFrame([(1, "dir/a.b.json", full, paras, tables, pages, None), (2, "c.json", None, None, None, None, (full, [], None, pages)), (3, None, None, None, None, None, None), (4, "d", "uno\n\n dos \n\n", [], [], [], None)], SCHEMA)


def test_blocks(spark):
    got = {tuple(r) for r in layout.blocks(records(spark), least_chars=0).collect()}
    a, full = ("a.b.json", "a.b"), "Un texto bastante largo para un bloque."
    assert got == {
        (1, 0, *a, 2, "paragraph", "note", "H", full), (1, 1, *a, None, "paragraph", "title", "", "Otro texto que sale solo de los spans."), (1, 2, *a, None, "paragraph", "", "", "corto"),
        (1, 3, *a, 3, "table", "", "Cap", "B\na z\t\tUn"), (1, 4, *a, None, "table", "", "", full),
        (2, 0, "c.json", "c", 1, "line", "", "", "linea que solo cuenta si no hay mas"),
    }
    assert {r["ord"] for r in layout.blocks(records(spark)).where("layout_id = 1").collect()} == {0, 1, 4}


def test_pages(spark):
    got = {(r["layout_id"], r["page"]): r["texts"] for r in layout.pages_text(records(spark)).collect()}
    assert got[1, 1] == ["Un texto bastante largo para un bloque.", "corto"][:1] + ["corto"]
    assert got[2, 1] == ["linea que solo cuenta si no hay mas"] and got[2, 2] == [] and got[2, 3] == ["texto de linea"]
    assert got[4, 1] == ["uno", "dos"] and not any(k[0] == 3 for k in got)


def test_items_and_rectangles(spark):
    items = layout.page_items(records(spark)).where("layout_id = 1").orderBy("ord").collect()
    assert [(r["page"], r["kind"], r["section"]) for r in items] == [(2, "paragraph", "H"), (3, "table", "Cap")]
    assert tuple(items[0]["rect"]) == (0.0, 0.0, 4.0, 2.0) and items[1]["rect"] is None
    assert items[1]["content"].split("\n") == ["|  | B |  |", "| --- | --- | --- |", "| a z |  | Un |"]
    assert layout.pages_in_range(layout.page_items(records(spark)), 2).where("page > 2").isEmpty()


def test_exports(spark):
    b = spark.createDataFrame([(2, "Año X", 3, "paragraph", "", "S", " dos "), (1, "Año X", None, "line", None, None, "uno"), (3, None, 1, None, None, "", None)], "block_id long, doc_title string, page int, block_type string, role string, section string, content string")
    ids = [r["id"] for r in layout.search_documents(b).orderBy("id").collect()]
    assert sorted(ids) == sorted(["A-o-X-p-000001", "A-o-X-p3-000002", "-p1-000003"])
    c = {r["chunk_name"]: r["body"] for r in layout.chunks(b).collect()}
    assert c["00002.md"] == "# Año X — p.3 [paragraph]\n**S**\n\ndos\n" and c["00001.md"] == "# Año X — p. [line]\nuno\n"
    md = {r["file_name"]: r["body"] for r in layout.markdown_documents(b).collect()}
    assert md["Año-X.md"] == "# Año X\n\n### p. [line]\nuno\n\n## S (p.3) [paragraph]\ndos\n" and ".md" in md
    assert layout.search_documents(b.limit(0)).isEmpty()


def test_empty_and_tiny(spark):
    d = table(spark, TINY, "layout_docs")
    assert layout.blocks(d.limit(0)).isEmpty() and layout.pages_text(d.limit(0)).isEmpty()
    assert rows(layout.blocks(d).select("layout_id").distinct()) <= rows(d.select("layout_id"))
    assert layout.blocks(d.withColumn("ord", F.lit(1)).withColumn("page", F.lit(2))).count() == layout.blocks(d).count()
