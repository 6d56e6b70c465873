from pyspark.sql import functions as F

from folium.operators import quality, resolve
from folium.plans import graph_queries
from tests.conftest import rows

NODES = [("d1_root", "d1", "root", "d1", 0), ("d1_p", "Nombre", "pages", "d1", 1), ("d2_x", "Nombre", "pages", "d1", 2), ("", "vacio", "", "", 3), ("d3_q", "spans", "", "", 4)]


def nodes(spark, extra=()):
    return spark.createDataFrame([*NODES, *extra], "id string, name string, type string, source string, o int")


def rels(spark, *pairs):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "ord long, parent_node string, child_node string, type string")


def test_cascade(spark):
    r = rels(spark, ("d1_root", " d1_p ", None), ("Nombre", "d1_pages", " "), ("vacio", "d1_root", "X"), ("d1_root", "nada", "X"), (None, "", "X"))
    got = resolve.resolve(r, nodes(spark), node_order=["o"]).orderBy("ord").collect()
    assert [(x["start_id"], x["end_id"], x["etype"]) for x in got] == [("d1_root", "d1_p", "TIENE"), ("d1_p", "d1_p", "TIENE"), (None, "d1_root", "X"), ("d1_root", None, "X"), (None, None, "X")]
    assert resolve.unresolved_count(resolve.resolve(r, nodes(spark), node_order=["o"])).first()[0] == 3


def test_base_types_and_orphans(spark):
    r = rels(spark, ("d1_root", "pages", ""), ("d3_q", "words", ""), ("d3_q", "words", ""), ("zz", "words", ""))
    d = resolve.resolve(r, nodes(spark), node_order=["o"], allow_orphans=True)
    assert rows(resolve.resolved_edges(d)) == {("d1_root", "d1_p", "TIENE"), ("d3_q", "d3_words", "TIENE"), ("ORPHAN::zz", "ORPHAN::words", "TIENE")}
    assert rows(resolve.made_nodes(d)) == {("d3_words", "words", "words", "d3"), ("ORPHAN::zz", "zz", "orphan", "relations"), ("ORPHAN::words", "words", "orphan", "relations")}


def test_capture_follows_a_single_pass(spark):
    r = rels(spark, ("zz", "words", ""), ("d3_q", "words", ""), ("d1_root", "words", ""), ("words", "d3_words", ""))
    c = resolve.capture_bare_types(r, nodes(spark), ["o"])
    assert c == {"words": (1, "d3_words")}
    got = resolve.resolve(r, nodes(spark), node_order=["o"], allow_orphans=True, captures=c).orderBy("ord").collect()
    assert [(x["start_id"], x["end_id"]) for x in got] == [("ORPHAN::zz", "ORPHAN::words"), ("d3_q", "d3_words"), ("d1_root", "d3_words"), ("d3_words", "d3_words")]


def test_captured_query_takes_whole_tables(spark, tmp_path):
    n = [("d1_root", "d1", "d1", "root", "0"), ("d1_p", "Nombre", "d1", "pages", "1"), ("d3_q", "spans", "d3", "spans", None)]
    spark.createDataFrame(n, "id string, name string, source string, type string, depth string").selectExpr("*", "timestamp'2024-01-01' AS loaded_at").write.parquet(str(tmp_path / "graph_nodes.parquet"))
    r = [(1, "zz", "words", "a.b"), (2, "d1_root", "d1_p", "pages"), (3, "d3_q", "words", "x.lines"), (4, "d1_root", "words", "words")]
    spark.createDataFrame(r, "rel_id long, parent_node string, child_node string, json_path string").selectExpr("*", "'TIENE' AS type").write.parquet(str(tmp_path / "relations.parquet"))
    want = {("ORPHAN::zz", "ORPHAN::words"), ("d1_root", "d1_p"), ("d3_q", "d3_words"), ("d1_root", "d3_words")}
    assert rows(graph_queries.graph_captured(spark, str(tmp_path)).select("start_id", "end_id")) == want


def test_type_column():
    assert resolve.relation_type_column(["x", "edge_type", "rel"]) == "rel" and resolve.relation_type_column(["x"]) is None


def test_checks(spark):
    n = spark.createDataFrame([("a", "s", "p"), ("b", "s", None), ("c", "t", None), ("c", "t", None)], "id string, source string, prop string")
    e = spark.createDataFrame([("a", "b"), ("b", "zz"), (None, "c")], "start_id string, end_id string")
    assert rows(quality.edges_per_source(e, n)) == {("s", 1)}
    assert rows(quality.connectivity(e, n)) == {("with relations", 2), ("without relations", 1)}
    assert rows(quality.isolated(e, n)) == set()
    assert quality.leaves(e, n, ["id", "prop"]).first()["leaves"] == 2
    assert quality.invalid_edges(e, n).count() == 2
    dev = quality.deviation(spark.createDataFrame([("x", 100), ("y", 0)], "k string, expected long"), spark.createDataFrame([("x", 97), ("z", 1)], "k string, actual long"), ["k"])
    assert {(r["k"], r["deviation"], r["ok"]) for r in dev.collect()} == {("x", 3.0, False), ("y", 0.0, True), ("z", 0.0, True)}
    assert rows(quality.shares(n, "source")) == {("s", 2, 50.0), ("t", 2, 50.0)}
    assert rows(quality.repeated_keys(n, ["id"])) == {("c", 2)}
    empty = e.limit(0)
    assert quality.connectivity(empty, n).count() == 1 and quality.shares(n.limit(0), "source").isEmpty()
    assert n.select(F.lit(1)).count() == 4
