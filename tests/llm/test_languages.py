from pyspark.sql import functions as F

from folium.llm import languages as lg
from folium.session import table
from tests.conftest import SMALL, rows


def test_declared_names_and_addresses(spark):
    d = spark.createDataFrame([(x,) for x in ("es", "ES ", "es-ES", "castellano", "eus", "Euskara", "en_GB", "français", "de", "und", "??", "", " ", None, "unknown")], "x string")
    got = {r["x"]: r["l"] for r in d.select("x", lg.declared_language(F.col("x")).alias("l")).collect()}
    assert [got[k] for k in ("es", "ES ", "es-ES", "castellano", "eus", "Euskara", "en_GB", "français", "de")] == ["es"] * 4 + ["eu"] * 2 + ["en", "fr", "other"]
    assert all(got[k] is None for k in ("und", "??", "", " ", None, "unknown"))
    s = spark.createDataFrame([(x,) for x in ("https://a.eus", "cat-1-EU.json", "https://a.example/es/doc/1.shtml", "bopv_2022.json", None)], "x string")
    assert [r[0] for r in s.select(lg.address_suffix(F.col("x"))).collect()] == ["eu", "eu", "es", None, None]


def test_held_out_documents(spark):
    """Documents with one right label: the model, fitted on some of them, must give the others' paragraphs that language."""
    d = table(spark, SMALL, "para_docs").dropDuplicates(["pdoc_id"])
    segs = lg.classify(d, lg.fit_text_model(d, per_language=30)).cache()
    docs = lg.document_languages(segs).where("declared IN ('es', 'eu', 'en', 'fr') AND NOT mixed")
    right = docs.where("declared = language").count()
    assert right >= 0.85 * docs.count()  # the rest are labels that are wrong in the data
    assert segs.where("confidence > 1.0001 OR confidence < 0.25").isEmpty()
    found = lg.unlabelled_paragraphs(lg.paragraph_languages(segs))
    assert found.count() == found.distinct().count()
    sure = segs.where("declared = language").select("pdoc_id").distinct()
    assert found.join(sure, "pdoc_id", "left_semi").groupBy("pdoc_id").agg(F.count_distinct("language").alias("n")).where("n = 1").isEmpty()


def test_mixed_wrong_missing_and_odd(spark):
    es, eu = "El tribunal confirmó la resolución y el plazo de los recursos.", "Auzitegiak ebazpena berretsi zuen eta errekurtsoen epea luzatu egin zen."
    rows_in = [(k, "s", [es, es], "es", "2022-01-01") for k in range(8)] + [(10 + k, "s", [eu, eu], "eu", "2022-01-01") for k in range(8)]
    rows_in += [(20, "s", [f"{es} {eu}", None, "", "12 - 34", "MQ-1 · 2.3"], "es", None), (21, None, [es], "eu", None), (22, "s", [eu], None, "x"), (23, "s", [es], "castellano", "x"), (22, "s", [eu], None, "x"), (24, "s", None, None, None), (25, "s", [], "fr", None)]
    d = spark.createDataFrame(rows_in, "pdoc_id long, source string, paragraphs array<string>, language string, date_published string")
    got = rows(lg.unlabelled_paragraphs(lg.paragraph_languages(lg.classify(d))))
    assert got == {(20, 0, "es"), (20, 0, "eu"), (21, 0, "es"), (22, 0, "eu")}
    assert lg.classify(d.limit(0)).isEmpty()
