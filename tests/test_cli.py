import json

from folium import cli
from folium.session import table
from tests.conftest import TINY


def run(*a):
    return cli.main([str(x) for x in a])


def test_documents_to_graph_and_edges(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"t": "x​ y", "pages": [{"n": 1, "text": "“q”"}], "paragraphs": ["La ley y el decreto del gobierno vasco y de los ciudadanos"]}))
    (src / "b.json").write_text("{bad")
    run("clean", "--in", src, "--out", tmp_path / "clean", "--report", tmp_path / "rep")
    assert "a.json,a_clean.json,3,2,0,3,yes" in capsys.readouterr().out
    run("clean", "--in", src, "--out", tmp_path / "c2", "--report", tmp_path / "r2", "--dry-run", "--keys-only")
    assert not (tmp_path / "c2").exists() and not (tmp_path / "r2").exists()
    assert run("graph", "--in", src, "--out", tmp_path / "g") == 0
    run("schema", "--in", src, "--out", tmp_path / "s")
    assert spark.read.csv(str(tmp_path / "s/relations"), header=True).first()["child_node"] == "pages"
    (tmp_path / "x.relations.csv").write_text("parent_node,child_node,type\na_root,a_pages,\na_root,words,T\nno,nada,T\n")
    capsys.readouterr()
    run("resolve", "--nodes", tmp_path / "g/nodes", "--relations", tmp_path / "*.relations.csv", "--out", tmp_path / "e")
    assert capsys.readouterr().out.strip() == "2"
    run("resolve", "--nodes", tmp_path / "g/nodes", "--relations", tmp_path / "*.relations.csv", "--out", tmp_path / "e2", "--orphans-out", tmp_path / "o", "--allow-orphans", "--merge", tmp_path / "e")
    assert spark.read.csv(str(tmp_path / "e2"), header=True).count() == 3 and spark.read.csv(str(tmp_path / "o"), header=True).count() == 3
    run("consolidate", "--in", tmp_path / "g/nodes", "--out", tmp_path / "all_nodes.csv")
    assert spark.read.csv(str(tmp_path / "all_nodes.csv"), header=True).count() == 3
    run("language", "--file", src, "--out", tmp_path / "l")
    run("domain", "--file", src, "--out", tmp_path / "d")
    assert spark.read.json(str(tmp_path / "l/documents")).first()["dominant_language"] == "es"
    assert spark.read.json(str(tmp_path / "d/documents")).first()["domain"] == "legal"
    capsys.readouterr()
    run("domain", "--text", "impuesto y renta ante la agencia tributaria")
    assert json.loads(capsys.readouterr().out)["domain"] == "fiscal"


def test_layout_to_exports(spark, tmp_path, capsys):
    d = table(spark, TINY, "layout_docs").select("content", "paragraphs", "tables", "pages", "analyzeResult")
    src = tmp_path / "lay"
    src.mkdir()
    for i, r in enumerate(d.toJSON().collect()):
        (src / f"d{i}.json").write_text(r)
    run("blocks", "--in", src, "--out", tmp_path / "b")
    run("pages-text", "--in", src, "--out", tmp_path / "pt")
    run("pdf", "--in", src, "--out", tmp_path / "pdf", "--pagesize", "LETTER")
    assert any(p.suffix == ".pdf" for p in (tmp_path / "pdf").iterdir())
    run("search", "--in", tmp_path / "b", "--out", tmp_path / "s")
    run("chunks", "--in", tmp_path / "b", "--out", tmp_path / "c", "--prefix", "p-")
    run("markdown", "--in", tmp_path / "b", "--out", tmp_path / "m")
    n = spark.read.csv(str(tmp_path / "b"), header=True, multiLine=True, escape='"').count()
    assert n == spark.read.text(str(tmp_path / "s")).count() == len(list((tmp_path / "c").iterdir())) > 0
    assert {p.suffix for p in (tmp_path / "m").iterdir()} == {".md"} and spark.read.json(str(tmp_path / "pt")).count() > 0
    (tmp_path / "one.csv").write_text('a,b\n1,"x\ny"\n')
    capsys.readouterr()
    run("validate", "--in", tmp_path / "one.csv")
    assert capsys.readouterr().out.strip() == "2"
    (tmp_path / "p.html").write_text("<body><h1>T</h1><p>Un párrafo bastante largo para quedarse</body>")
    run("pages", "--in", tmp_path / "p.html", "--out", tmp_path / "docs")
    assert spark.read.json(str(tmp_path / "docs")).first()["title"] == "T"
