from folium.operators import html
from tests.conftest import rows

PAGE = """<html><head><title>t</title><meta name="DC.date" content="15/01/2024"></head><body><nav>menu</nav><div class="x bopv-content"><h1>Decreto 1/2024</h1>
<h2>I - DISPOSICIONES GENERALES</h2><p>Artículo primero del <b>decreto de prueba<p>Artículo segundo, también largo</b></p><script>var p = "<p>no</p>";</script><ul><li>Un elemento de lista bien largo<li>no</ul></div></body></html>"""


def pages(spark, *p):
    return spark.createDataFrame(list(p), "url string, html string")


def test_documents(spark):
    d = html.documents(pages(spark, ("https://x/eu/bopv/00012345.shtml", PAGE), ("https://x/es/2023/02/03/a.html", "<p>Núm. 77 y nada más que decir</p>"), ("u", None), ("v", ""), ("w", "<span>el 5/6/2020</span><body>x"), ("q", "<<<>><a"))).collect()
    by = {r["url"]: r for r in d}
    a = by["https://x/eu/bopv/00012345.shtml"]
    assert (a["language"], a["title"], a["date_published"], a["bopv_number"], a["file_name"]) == ("eu", "Decreto 1/2024", "2024-01-15", "00012345", "bopv_2024-01-15_00012345_eu.json")
    assert a["paragraphs"] == ["I - DISPOSICIONES GENERALES", "Artículo primero del decreto de prueba", "Artículo segundo, también largo", "Un elemento de lista bien largo"]
    b = by["https://x/es/2023/02/03/a.html"]
    assert (b["language"], b["date_published"], b["bopv_number"], b["paragraphs"]) == ("es", "2023-02-03", "77", [])
    assert by["w"]["date_published"] == "2020-06-05" and "u" not in by and "v" not in by


def test_links(spark):
    p = pages(spark, ("https://h/es/2024/i.html", '<a href="/es/a/00000001.shtml">1</a><a href="00000002.HTML">2</a><a href="/es/a/00000001.shtml">1</a><a>x</a><a href="/doc.pdf">p</a>'))
    got = html.index_links(p)
    assert rows(got) == {("https://h/es/2024/i.html", 0, "https://h/es/a/00000001.shtml", "https://h/eu/a/00000001.shtml"), ("https://h/es/2024/i.html", 1, "https://h/es/2024/00000002.HTML", "https://h/eu/2024/00000002.HTML")}
    assert html.language_pages(got, ["es", "eu"], 1).count() == 2
