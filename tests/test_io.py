import json
import os

import pytest

from folium.operators import graph, jsontree, layout
from folium.sources import readers, sinks
from folium.streaming import feeds
from folium.session import table
from tests.conftest import TINY, rows


def test_json_files(spark, tmp_path):
    for n, t in (("b.JSON", '{"a": 1}'), ("a.json", '{"x": [1]}'), ("c.json", "{bad"), ("d.json", "{}"), ("e.txt", "x")):
        (tmp_path / n).write_text(t)
    assert [os.path.basename(p) for p in readers.list_files(spark, str(tmp_path), ".json")] == ["a.json", "b.JSON", "c.json", "d.json"]
    with pytest.raises(FileNotFoundError):
        readers.list_files(spark, str(tmp_path / "no"))
    d = readers.read_json_texts(spark, str(tmp_path))
    assert {(r["source"], r["ok"]) for r in d.collect()} == {("a", True), ("c", False), ("d", True)}
    assert rows(readers.usable(d).select("source")) == {("a",)}
    with pytest.raises(Exception, match="not JSON"):
        readers.read_json_texts(spark, str(tmp_path), strict=True).collect()


def test_csv_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("1", 'a "q"\nb', "", "NA"), ("2", "x,y", None, "s")], "id string, name string, type string, source string")
    sinks.write_csv(d.coalesce(1), str(tmp_path / "n_nodes.csv"))
    got = readers.read_nodes(spark, str(tmp_path / "n_nodes.csv")).select("id", "name", "type", "source")
    assert rows(got) == {("1", 'a "q"\nb', "", ""), ("2", "x,y", "", "s")}
    assert readers.count_csv_rows(spark, str(tmp_path / "n_nodes.csv")) == 3
    (tmp_path / "r1.csv").write_text("parent_node,child_node,rel\na,b,T\n")
    (tmp_path / "r2.csv").write_text("x,y\n1,2\n")
    r, left = readers.read_relations(spark, [str(tmp_path / "r1.csv"), str(tmp_path / "r2.csv")])
    assert rows(r) == {("a", "b", "T", "r1.csv")} and left == [str(tmp_path / "r2.csv")]


def test_pairs_rules_settings(spark, tmp_path):
    for n in ("x_nodes.csv", "x_relationships.csv", "x_nodes.metadata.json", "y_nodes.csv"):
        (tmp_path / n).write_text("a\n")
    (p,) = readers.table_pairs(spark, str(tmp_path))
    assert p[2].endswith("x_nodes.metadata.json") and p[3] is None
    (tmp_path / "r.json").write_text('{"replace": {"a": "b"}}')
    assert readers.load_rules(str(tmp_path / "r.json")) == {"replace": {"a": "b"}} and readers.load_rules(None) == {}
    with pytest.raises(KeyError):
        readers.settings(("A", "B"), {"A": "1"})
    assert readers.settings(("A",), {"A": "1"}) == {"A": "1"}


def test_sinks(spark, tmp_path):
    b = table(spark, TINY, "ocr_blocks").dropDuplicates(["block_id"])
    sinks.write_files(layout.chunks(b), str(tmp_path / "md"))
    assert len(os.listdir(tmp_path / "md")) == b.count()
    sinks.write_markdown(layout.markdown_parts(b), str(tmp_path / "docs"))
    for r in layout.markdown_documents(b).collect():
        assert (tmp_path / "docs" / r["file_name"]).read_bytes().decode() == r["body"]
    sinks.write_ndjson(layout.search_documents(b), str(tmp_path / "nd"))
    assert "@search.action" in json.loads(spark.read.text(str(tmp_path / "nd")).first()[0])
    t = jsontree.tree_rows(spark.createDataFrame([("s", '{"a": {"b": "q\\"w"}}')], "source string, json string"))
    assert sinks.write_graph(graph.nodes(t), graph.edges(t), str(tmp_path / "g"))
    assert not sinks.write_graph(graph.nodes(t).limit(0), graph.edges(t), str(tmp_path / "g2"))
    assert spark.read.csv(str(tmp_path / "g/nodes"), header=True, escape='"').where("id = 's_a'").first()["prop_b"] == 'q"w'


def test_streams(spark, tmp_path):
    ev = table(spark, TINY, "events")
    ev.limit(300).write.parquet(str(tmp_path / "in"))
    s = feeds.read_feed(spark, str(tmp_path / "in"), ev.schema)
    q = feeds.windowed(feeds.first_arrivals(s, "event_id", "ts"), late=None).writeStream.outputMode("append").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").count() >= 0 and q.exception() is None
    assert feeds.windowed(ev).agg({"n": "sum"}).first()[0] == ev.count()
    rel, nodes = table(spark, TINY, "relations"), table(spark, TINY, "graph_nodes")
    rel.repartition(3).write.parquet(str(tmp_path / "rel"))
    seen = []
    feed = feeds.OrphanFeed(lambda n, snap: seen.append((n, snap.agg({"n": "sum"}).first()[0])))
    q = feed.follow(feeds.read_feed(spark, str(tmp_path / "rel"), rel.schema, 2), nodes, str(tmp_path / "cp"))
    q.awaitTermination(180)
    assert q.exception() is None and len(seen) >= 2
    from folium.plans.queries import p4_found

    assert rows(feed.state.pending().select("ref_id", "side", "reason")) == rows(p4_found(spark, TINY))
    nodes.write.parquet(str(tmp_path / "nodes"))
    feeds.upsert_feed(feeds.read_feed(spark, str(tmp_path / "nodes"), nodes.schema), str(tmp_path / "store"), ["loaded_at"], str(tmp_path / "cp2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "store/v=0")).count() == nodes.select("id").distinct().count()
