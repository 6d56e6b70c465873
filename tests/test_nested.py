from pyspark.sql import functions as F

from folium.operators import nested
from folium.session import table
from tests.conftest import TINY, rows

ROOTS = ["paragraphs", "tables", "pages"]


def brute(record):
    """All objects within lists, by plain recursion over a row as a dict."""
    out = []

    def visit(v, path, holder):
        if isinstance(v, list):
            for i, x in enumerate(v):
                if isinstance(x, dict):
                    at = f"{path}[{i}]"
                    out.append((holder, at))
                    for k, y in x.items():
                        visit(y, f"{at}.{k}", at)

    inner = record.get("analyzeResult") or {}
    for r in ROOTS:
        v = inner.get(r) if inner.get(r) is not None else record.get(r)
        visit(v, r, "")
    return out


def test_links_match_recursion(spark):
    d = table(spark, TINY, "layout_docs")
    want = {(r["layout_id"], *x) for r in (q.asDict(recursive=True) for q in d.collect()) for x in brute(r)}
    assert rows(nested.object_links(d, "layout_id", ROOTS, "analyzeResult")) == want


def test_flat_tables_keep_links_and_values(spark):
    d = table(spark, TINY, "layout_docs")
    t = nested.flat_tables(d, "layout_id", ROOTS, "analyzeResult")
    assert set(t) == {"paragraphs", "spans", "boundingRegions", "tables", "cells", "pages", "lines"}
    for name, df in t.items():
        assert df.groupBy("layout_id", "path").count().where("count > 1").isEmpty()
        held = df.where("parent_path <> ''")
        for holder in [r[0] for r in held.select("parent_table").distinct().collect()]:
            up = t[holder].select("layout_id", F.col("path").alias("parent_path"))
            assert held.where(F.col("parent_table") == holder).join(up, ["layout_id", "parent_path"], "left_anti").isEmpty(), name


def test_nulls_positions_inlining_and_odd_columns(spark):
    schema = "id long, `table` string, path string, rows array<struct<a:int,path:string,in:struct<b:int,c:struct<d:string>>,kids:array<struct<v:int>>>>, kids array<struct<v:int>>"
    d = spark.createDataFrame([(1, "x", "y", [None, (1, "p", (2, ("z",)), [None, (5,)]), (None, None, None, None)], None), (2, None, None, [], [(7,)]), (None, None, None, None, None)], schema)
    got = nested.flat_tables(d, "id", ["rows", "kids"])
    assert rows(got["rows"].select("id", "path", "pos", "a", "f_path", "in_b", "in_c_d")) == {(1, "rows[1]", 1, 1, "p", 2, "z"), (1, "rows[2]", 2, None, None, None, None)}
    assert rows(got["kids"].select("id", "path", "parent_table", "parent_path", "v")) == {(1, "rows[1].kids[1]", "rows", "rows[1]", 5), (2, "kids[0]", "", "", 7)}
    assert nested.object_links(d.limit(0), "id", ["rows", "kids"]).isEmpty()


def test_shared_and_differing_shapes(spark):
    t = spark.createDataFrame([], "id int, a array<struct<s:array<struct<x:int>>>>, b array<struct<s:array<struct<x:int>>>>, c array<struct<s:array<struct<y:string>>>>").schema
    g = nested.schema_graph({f.name: f.dataType.elementType for f in t.fields[1:]})
    assert len([e for (n, _), e in g.items() if n == "s"]) == 2
    assert len({e.table for e in g.values()}) == len(g)
