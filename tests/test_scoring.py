from folium.operators import domain, language
from tests.conftest import rows

EU = "Eusko Jaurlaritzaren dekretuaren arabera, lege hau indarrean dago eta herritarrek beren eskubideak izango dituzte."
ES = "La ley de los ciudadanos y el decreto del gobierno vasco se publican en el boletin. Todos los documentos son para la consulta."


def test_languages(spark):
    d = spark.createDataFrame([(1, [EU, ES, "Kaixo", None, ""]), (2, None), (3, [])], "pdoc_id long, paragraphs array<string>")
    p = language.paragraph_languages(d)
    got = {(r["pdoc_id"], r["index"]): (r["language"], r["method"]) for r in p.collect()}
    assert got == {(1, 0): ("eu", "internal"), (1, 1): ("es", "internal"), (1, 2): ("unknown", "too_short"), (1, 3): ("unknown", "too_short"), (1, 4): ("unknown", "too_short")}
    assert p.where("index = 0").first()["confidence"] > 0.55
    assert rows(language.document_languages(p)) == {(1, "unknown", 0.2, 1, 1, 3)}


def test_dominant_tie_goes_to_the_first(spark):
    p = spark.createDataFrame([(1, 0, "es"), (1, 1, "eu")], "pdoc_id long, index int, language string")
    assert language.document_languages(p).first()["dominant_language"] == "es"


def test_domains(spark):
    texts = ["El decreto y la normativa: el derecho a la salud, la asistencia no; tratamiento, red sanitaria y sanitaria.".replace("la asistencia no; ", ""), "La ley regula la primaria y la secundaria.", "La ley: impuesto, renta e iva ante la agencia tributaria.", "nada de nada aqui hoy", "corto", None]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: (r["domain"], r["confidence"], r["method"]) for r in domain.score_domain(d, "t").collect()}
    assert got[0] == ("health", 0.6154, "internal")
    assert got[1] == ("education", 0.6667, "internal")
    assert got[2] == ("fiscal", 0.7778, "internal")
    assert got[3] == ("other", 0.0, "internal")
    assert got[4] == got[5] == ("other", 0.0, "too_short")
    assert {r["domain"] for r in domain.score_domain(d, "t", threshold=0.99).collect()} == {"other"}


def test_document_domains_and_shares(spark):
    d = spark.createDataFrame([(1, ["La ley y el decreto", None, "impuesto y tributo y ley"]), (2, None)], "pdoc_id long, paragraphs array<string>")
    assert {(r["pdoc_id"], r["domain"]) for r in domain.document_domains(d).collect()} == {(1, "legal"), (2, "other")}
    assert rows(domain.domain_distribution(domain.paragraph_domains(d))) == {(1, "legal", 0.3333), (1, "other", 0.3333), (1, "fiscal", 0.3333)}
