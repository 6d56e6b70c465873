import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folium.functions import text as tx
from folium.functions.ordering import number_rows
from tests.conftest import rows


def one(spark, f, *values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in d.select(f(F.col("s")), "i").orderBy("i").collect()]


def test_clean(spark):
    a, b, c, d, e = one(spark, tx.clean, "a  b​c—d…", "x\u0007yz\n\tq­", "é", None, "")
    assert tuple(a) == ("a bc-d...", 0, 5, True)
    assert tuple(b) == ("xyz\n q­", 2, 0, True)
    assert tuple(c) == ("é", 0, 0, True)
    assert d is None and tuple(e) == ("", 0, 0, False)


def test_layout_clean(spark):
    assert one(spark, tx.layout_clean, "vál-\nvula\r\n\n  uno \x0b dos", None, "  ") == ["válvula\nuno\ndos", "", ""]
    assert one(spark, lambda c: tx.layout_clean(c, True), "5 oC u") == ["5 °C µ"]


def test_scraper_clean(spark):
    assert one(spark, tx.scraper_clean, "  hola   mundo  ", "a​b\x07c\n\n\n\nd") == ["hola mundo", "abc\n\nd"]


def test_names(spark):
    assert one(spark, tx.safe_path, "pages[0].my key-a/b]", "_x_", "") == ["pages_0_my_key_a_b", "x", ""]
    assert one(spark, tx.slug, "Catálogo (2024)!", None, "-" * 5 + "a" * 80) == ["Cat-logo-2024", "", "a" * 64]
    assert one(spark, tx.file_name, "Año 1/2.x") == ["Año-1-2.x"]
    assert one(spark, tx.csv_value, 'a"b', None) == ['a"b', ""]
    assert one(spark, lambda c: tx.csv_value(c, True), 'a"b') == ['a""b']
    d = spark.createDataFrame([("https://x/abc/12.html", None, None), ("u", "2024-01-15", "00012345")], "u string, d string, n string")
    assert rows(d.select(tx.document_name(F.col("d"), F.col("n"), F.col("u"), F.lit("eu")))) == {("bopv_unknown-date_ttps___x_abc_12_html_eu.json",), ("bopv_2024-01-15_00012345_eu.json",)}


def plain_normal(s):
    t = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
    return " ".join("".join(c if c == "_" or unicodedata.category(c)[0] in "LN" else " " for c in t).split())


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", categories=("L", "N", "P", "Z", "M"), exclude_characters="İ", max_codepoint=0x24F), max_size=40), min_size=20, max_size=40))
def test_normal_form_matches_plain(spark, texts):
    assert one(spark, tx.normal_form, *texts) == [plain_normal(t) for t in texts]


def test_number_rows(spark):
    d = spark.range(0, 500).withColumn("x", (F.col("id") * 7919) % 1009)
    got = number_rows(d, "x", "id").orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(1, 501))
    assert [(r["x"], r["id"]) for r in got] == sorted((r["x"], r["id"]) for r in got)
    assert number_rows(d.limit(0), "x", "id").isEmpty()


def test_lowest_is_a_fixed_sample(spark):
    from folium.session import lowest

    d = spark.range(20_000).withColumn("h", F.xxhash64("id"))
    want = [r["h"] for r in d.orderBy("h").limit(100).collect()]
    assert [r["h"] for r in lowest(d.repartition(7), "h", 100).collect()] == want
    assert lowest(d.limit(50), "h", 100).count() == 50 and lowest(d.limit(0), "h", 5).isEmpty()
