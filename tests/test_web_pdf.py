import os
import re
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

from folium.operators import layout
from folium.session import table
from folium.sources import pdf, web
from tests.conftest import TINY


def test_fetch_year(spark):
    hits = []

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            hits.append(self.path)
            pages = {"/es/i.html": '<a href="/es/00000001.shtml">a</a><a href="/es/00000002.shtml">b</a>', "/es/00000001.shtml": "<h1>Uno</h1><body><p>Un texto con más de veinte letras", "/eu/00000001.shtml": "<h1>Bat</h1><body><p>Hogei letra baino gehiagoko testua"}
            body = pages.get(self.path)
            self.send_response(200 if body else 500)
            self.end_headers()
            self.wfile.write((body or "").encode())

        def log_message(self, *a):
            pass

    s = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{s.server_port}"
    got = web.year_documents(spark, [f"{base}/es/i.html"], ["es", "eu"], pause=0.0, backoff=0.0).collect()
    assert {(r["url"], r["language"], r["title"]) for r in got} == {(f"{base}/es/00000001.shtml", "es", "Uno"), (f"{base}/eu/00000001.shtml", "eu", "Bat")}
    assert hits.count("/es/00000002.shtml") >= 3
    failed = web.fetch(spark.createDataFrame([(f"{base}/no", 1), (None, 2)], "url string, k int"), pause=0.0, backoff=0.0).collect()
    assert len(failed) == 1 and failed[0]["html"] is None and "500" in failed[0]["error"]
    s.shutdown()


def test_pdf(spark, tmp_path):
    p = layout.pages_text(table(spark, TINY, "layout_docs"))
    pdf.write_pdfs(p, str(tmp_path / "pdf"))
    assert len(os.listdir(tmp_path / "pdf")) == p.select("layout_id").distinct().count()
    b = pdf.render([["Uno (dos) \\", "x" * 400], [], ["tres " * 2000]], "Título")
    assert b.startswith(b"%PDF-1.4") and b.endswith(b"%%EOF\n") and b"Uno \\(dos\\) \\\\" in b
    at = int(re.search(rb"startxref\n(\d+)", b)[1])
    assert b[at : at + 4] == b"xref"
    for k, m in enumerate(re.findall(rb"(\d{10}) 00000 n", b), 1):
        assert b[int(m) :].startswith(b"%d 0 obj" % k)
    assert int(re.search(rb"/Count (\d+)", b)[1]) >= 4
    assert all(pdf.width(x, 10) <= 101 for x in pdf.wrap("palabra " * 50 + "y" * 90, 10, 100))
