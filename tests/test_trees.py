import json

from pyspark.sql import functions as F

from folium.operators import graph, jsontree
from tests.conftest import rows

DOC = {"titulo": "Decreto de prueba", "anio": 2024, "activo": True, "tags": ["legal", "eu"], "sub": {"clave": "valor"}}


def docs(spark, *pairs):
    return spark.createDataFrame([(s, d if isinstance(d, str) or d is None else json.dumps(d)) for s, d in pairs], "source string, json string")


def test_unseeded_root_keeps_values(spark):
    n = {r["id"]: r for r in graph.nodes(jsontree.tree_rows(docs(spark, ("t", DOC)), seed_root=False)).collect()}
    assert n["t_root"]["label"] == "ObjectNode"
    assert n["t_root"]["props"] == {"prop_titulo": "Decreto de prueba", "prop_anio": "2024", "prop_activo": "True", "prop_tags": "legal; eu"}
    assert set(n) == {"t_root", "t_sub"}


def test_seeded_root_reserves_the_id(spark):
    t = jsontree.tree_rows(docs(spark, ("t", DOC)))
    n = {r["id"]: r for r in graph.nodes(t).collect()}
    assert n["t_root"]["label"] == "DocumentRoot" and n["t_root"]["props"] == {}
    assert rows(graph.edges(t)) == {("t_root", "t_sub", "TIENE", "")}


def test_collisions_lists_and_odd_values(spark):
    d = {"a.b": {"x": None}, "a_b": {"x": 1.5, "y": 1e22}, "e": {}, "l": [], "m": [1, {"k": 2}, [3]], "ll": [[1], [2]], "p": [1, None]}
    n = {r["id"]: r for r in graph.nodes(jsontree.tree_rows(docs(spark, ("s", d)), seed_root=False)).collect()}
    assert n["s_a_b"]["props"] == {"prop_x": "None"} and n["s_a_b"]["path"] == "a.b"
    assert set(n) == {"s_root", "s_a_b", "s_e", "s_m", "s_m_1", "s_ll"} and n["s_m"]["length"] == 3
    assert n["s_root"]["props"] == {"prop_p": "1; None"}


def test_top_level_list_duplicates_and_depth(spark):
    deep = {"k": 1}
    for _ in range(60):
        deep = {"d": deep}
    t = jsontree.tree_rows(docs(spark, ("l", [{"a": 1}, 2]), ("dup", '{"a": 1, "a": 2, "b": {}}'), ("deep", deep), ("bad", "{x"), ("none", None), ("empty", {}), ("flat", [1])))
    n = graph.nodes(t)
    assert rows(n.where("source = 'l'").select("id")) == {("l_root",), ("l_",), ("l_0",)}
    assert n.where("source = 'deep'").agg(F.max("depth")).first()[0] == 50
    assert rows(n.where("source IN ('bad', 'none', 'empty')")) == set() and rows(n.where("source = 'flat'").select("id")) == {("flat_root",)}
    one = graph.nodes(jsontree.tree_rows(docs(spark, ("dup", '{"a": 1, "a": 2, "b": {}}')), seed_root=False)).where("id = 'dup_root'").first()
    assert one["props"] == {"prop_a": "2"}


def test_every_node_but_the_root_has_one_edge(spark):
    t = jsontree.tree_rows(docs(spark, *[(f"s{k}", {"rows": [{"v": i, "in": {"w": i}} for i in range(k)]}) for k in range(1, 6)]))
    assert graph.edges(t).count() == graph.nodes(t).count() - 5


def test_relations(spark):
    d = {"a": [{"b": [{"c": 1}], "e": []}, {"b": []}], "o": {"q": [{"z": []}]}, "m": [1, {}], "n": [[{"x": []}]]}
    got = [tuple(r)[2:] for r in jsontree.relations(docs(spark, ("s", d))).orderBy("ord").collect()]
    assert got == [("ROOT", "a", "a"), ("a", "b", "a.b"), ("a", "e", "a.e"), ("a", "b", "a.b"), ("o", "q", "o.q"), ("q", "z", "o.q.z")]


def test_schema_rows(spark):
    got = {(r["json_path"], r["type"]): (r["documents"], r["required"]) for r in jsontree.key_types(docs(spark, ("a", {"x": 1, "y": [{"z": "s"}]}), ("b", {"x": 2.5}), ("c", None))).collect()}
    assert got == {("$", "object"): (2, False), ("$.x", "integer"): (1, True), ("$.x", "number"): (1, True), ("$.y", "array"): (1, False), ("$.y[]", "object"): (1, False), ("$.y[].z", "string"): (1, True)}


def test_clean_json(spark):
    d = {"content": "a  b", "k ": "“q”", "list": ["…"], "in": {"text": "x\u0007"}, "n": 1}
    r = jsontree.clean_json(docs(spark, ("s", d), ("bad", "{"))).collect()
    assert json.loads(r[0]["json"]) == {"content": "a b", "k ": '"q"', "list": ["..."], "in": {"text": "x"}, "n": 1}
    assert tuple(r[0])[2:] == (4, 4, 1, 5) and r[1]["json"] is None and tuple(r[1])[2:] == (0, 0, 0, 0)
    only = jsontree.clean_json(docs(spark, ("s", d)), keys=("content", "list", "text")).first()
    assert json.loads(only["json"])["list"] == ["…"] and only["strings_changed"] == 2 and only["strings_total"] == 4


def test_wide_nodes_consolidation_and_upsert(spark):
    n = graph.nodes(jsontree.tree_rows(docs(spark, ("s", {"b": {"z": 1}, "a": {"y": None}}))))
    w = graph.wide_nodes(n)
    assert w.columns == ["id", "label", "name", "source", "type", "path", "depth", "length", "prop_y", "prop_z"]
    assert w.where("id = 's_b'").first()["prop_z"] == "1" and w.where("id = 's_b'").first()["prop_y"] == ""
    a = spark.createDataFrame([("1", "a", 1), ("1", "b", 0), (None, "n", 5)], "id string, name string, o int")
    b = spark.createDataFrame([("1", "c", -1, "x"), ("2", "d", 0, "y")], "id string, name string, o int, more string")
    assert rows(graph.consolidate([a, b], ["o"]).select("id", "name", "more")) == {("1", "b", None), ("2", "d", "y"), (None, "n", None)}
    assert rows(graph.upsert_nodes(a.where("o = 1"), b.where("id = '1'"), ["o"]).select("id", "name")) == {("1", "c")}
    assert graph.consolidate([a.limit(0)], ["o"]).isEmpty()


def test_edges_merge_and_load(spark):
    e = spark.createDataFrame([("a", "b", "T"), ("a", "b", "T"), ("a", "b", "S"), ("a", None, "T"), ("x", "b", "T")], "start_id string, end_id string, type string")
    n = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert rows(graph.load_edges(e, n)) == {("a", "b", "TIENE", "S")}
    assert graph.merge_edges(e, e).count() == 4 and graph.merge_edges(n, e).count() == 4
    nn, ee = graph.metadata(graph.nodes(jsontree.tree_rows(docs(spark, ("s", DOC)))), e)
    assert ee.first()["relationship_types"] == {"S": 1, "T": 4} and nn.first()["total_nodes"] == 2
