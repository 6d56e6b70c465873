import collections
import unicodedata

import pytest

from folium.llm import lookalikes as la
from folium.session import table
from tests.conftest import SMALL, rows


@pytest.mark.parametrize(("a", "b"), [("аbс", "abc"), ("ｆｕｌｌ　１２", "full 12"), ("é", "é"), ("a​b­", "ab"), ("ﬁn", "fin"), ("Ω", "Ω"), ("µ", "μ"), ("K", "K"), ("x y", "x y"), ("a‑b", "a-b"), ("Βοx", "Box")])
def test_alike(a, b):
    assert la.skeleton(a) == la.skeleton(b)


@pytest.mark.parametrize(("a", "b"), [("a", "A"), ("e", "é"), ("m²", "m2"), ("½", "1/2"), ("a–b", "a-b"), ("n.º", "n.°"), ("1", "l"), ("a  b", "a b")])
def test_different(a, b):
    assert la.skeleton(a) != la.skeleton(b)


def test_skeleton_is_stable():
    for cp in range(0x20, 0x3000):
        s = la.skeleton(chr(cp))
        assert la.skeleton(s) == s
        assert la.skeleton(unicodedata.normalize("NFC", s)) == s


def test_pairs_match_brute_force(spark):
    d = table(spark, SMALL, "json_strings")
    groups = collections.defaultdict(list)
    for r in d.collect():
        k = la.skeleton(r["content"])
        if k and k.strip() and r["file_in"] is not None:
            groups[r["file_in"], k].append((r["string_id"], r["content"]))
    want = {(min(a, b)[0], max(a, b)[0]) for g in groups.values() for i, a in enumerate(g) for b in g[:i] if a[1] != b[1]}
    assert rows(la.lookalike_pairs(d)) == want


def test_edges(spark):
    d = spark.createDataFrame([(1, "f", "а", 1), (2, "f", "a", 2), (2, "f", "a", 2), (3, None, "a", 3), (4, "f", None, 3), (None, "f", "a", 3), (5, "f", " ", 1), (6, "f", " ", 1), (7, "f", "a", 1)], "string_id long, file_in string, content string, _k int")
    assert rows(la.lookalike_pairs(d)) == {(1, 2), (1, 7)}
    c = {r["string_id"]: (r["canonical"], r["changed"]) for r in la.canonical_strings(d).collect()}
    assert c[1] == ("a", True) and c[2] == ("a", False) and c[4] == (None, False)
    assert rows(la.lookalike_classes(d)) == {("f", "a", 2, 5)}
    assert rows(la.mapped_report(d.where("file_in = 'f'"))) == {("f", 7, 2, 2)}
    assert la.lookalike_pairs(d.limit(0)).isEmpty() and la.mapped_report(d.limit(0)).isEmpty()
