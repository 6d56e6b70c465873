import pytest

from folium.llm.sentences import sentence_spans, split_documents
from folium.session import table
from tests.conftest import SMALL


def cut(t, lang=None):
    return [t[a:b] for a, b in sentence_spans(t, lang)]


@pytest.mark.parametrize(("text", "units"), [
    ("Según el art. 8 y la pág. 9, la Sra. Ruiz fijó 15,5 puntos. Otra frase.", 2), ("Los EE. UU. y el Dr. Pérez, p. ej., usan otra. Fin.", 2), ("Queda... por fijar. ¿Hay fugas? —preguntó el jefe.", 2),
    ("(Consúltese el anexo 2.) Por falta de prueba, archivó.", 2), ("El ponente dijo: «No procede. Se archiva.» y cerró.", 1), ("Dijo: «No.» Luego salió.", 2), ("Código v15.11.1 en www.a.example/b.html de 3.5 mm. Ya.", 2),
    ("See Fig. 13 and Sec. 7.13 for the U.S. version, e.g. model HB-9. It's Dr. Smith's.", 2), ('The inspector said, "No leaks.\nProceed." and left the hall. Done.', 2), ("Please come by 5 p.m. at the latest. Ok?", 2),
    ("L'inspecteur a dit : « Pas de fuite. Continuez. » et il est parti. Qui signe l'acte n° 38 ? Moi !", 3), ("Nach Abs. 3 Nr. 4 gilt z. B. der Filter. Am 3. Mai 2020 war es.", 2), ("Der Prüfer sagte: „Alles dicht. Keine Mängel.“ und unterschrieb.", 1),
    ("Auzitegiaren arabera, 328. artikuluari lotzen zaio. 2016ko ekainaren 10.a da (ikus 18. oharra).", 2), ("型号A的压力为4.9巴。检验员说：“没有泄漏。可以使用。”然后签了字。详见第21页！", 3), ("担当者は「漏れはありません。使用できます。」と述べました。次です？", 2),
    ("डॉ. के कार्यालय में 3 आवेदन मिले। निरीक्षक ने कहा, \"नहीं है।\" और हस्ताक्षर किए। क्या?", 3), ("هل الحلقة تالفة؟ افحص الأسطوانة، ثم صل! نشر.", 3), ("ดูที่หน้า3 รุ่นVX-1ใช้แรงดัน1.2บาร์ ซีลเสียหาย", 3),
    ("Una linea\nque sigue. Otra.\n\nANEXO 14\n\nTexto.", 4), ("1. copia\n2. plano núm. 5;\n3. otra", 3), ("- a\n- 67. planoa;\n• b", 3), ("consulta dezake\n78. orrialdean. Bai.", 2), ("Fin de una.Otra sigue aquí.", 2), ("  \n ", 0), ("", 0), (None, 0),
])
def test_units(text, units):
    assert len(cut(text or "", None) if text is not None else sentence_spans(None)) == units


def test_spans_have_no_blanks_around_and_cover_all(spark):
    d = table(spark, SMALL, "documents").select("doc_id", "text", "lang").collect()
    for r in d:
        s = sentence_spans(r["text"], r["lang"])
        t = r["text"] or ""
        assert all(a < b and not t[a].isspace() and not t[b - 1].isspace() for a, b in s)
        assert all(x[1] <= y[0] for x, y in zip(s, s[1:]))
        kept = "".join("".join(t[a:b].split()) for a, b in s)
        assert kept.replace("​", "") == "".join(t.split()).replace("​", "")


def test_documents(spark):
    d = spark.createDataFrame([(1, "Una. Dos.", None, 5), (2, None, "es", 1), (3, " ", "xx", 1), (None, "Sola.", "es", 1), (1, "Una. Dos.", None, 5)], "doc_id long, text string, lang string, start_pos int")
    got = [tuple(r) for r in split_documents(d).orderBy("doc_id", "ord").collect()]
    assert got.count((1, 0, 0, 4, "Una.")) == 2 and (None, 0, 0, 5, "Sola.") in got and len(got) == 5
    assert split_documents(d.limit(0)).isEmpty()
    long = "Frase larga número 3,5. " * 40_000
    assert len(sentence_spans(long, "es")) == 40_000
