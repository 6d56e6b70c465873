import random

from folium.llm import alignment as al
from tests.conftest import rows

_RNG = random.Random(0)


def _word(syllables):
    return "".join(_RNG.choice(syllables) for _ in range(3))


WORDS = {_word(["ca", "sa", "pe", "rro", "mon", "te", "li", "bro", "fue", "go"]): _word(["etx", "ur", "men", "di", "zko", "aga", "txi", "ri", "ku", "oho"]) for _ in range(250)}


def bulletin(rng, k):
    """Pages of a bulletin with sentences left out, joined and moved, and the true pairs."""
    n = rng.randrange(5, 12)
    src = [(rng.sample(sorted(WORDS), 5), rng.randrange(10, 999)) for _ in range(n)]
    es = [f"El {' '.join(w)} de {x} metros." for w, x in src]
    units = [([i], f"{x} metroko {' '.join(WORDS[a] for a in reversed(w))} da.") for i, (w, x) in enumerate(src) if rng.random() > 0.1]
    if len(units) > 4 and rng.random() < 0.5 and units[2][0][0] == units[1][0][0] + 1:
        units[1:3] = [(units[1][0] + units[2][0], units[1][1][:-1] + "; " + units[2][1])]
    if rng.random() < 0.3:
        units.append(units.pop(1))
    base = k * 100
    pairs = {(base + i, base + 50 + j) for j, (src_ids, _) in enumerate(units) for i in src_ids}
    rows_ = [(base + i, f"es{k}", "es", i // 3, i, t) for i, t in enumerate(es)] + [(base + 50 + j, f"eu{k}", "eu", j // 3, j, t) for j, (_, t) in enumerate(units)]
    return rows_, pairs


def test_planted_translations(spark):
    rng = random.Random(1)
    got = [bulletin(rng, k) for k in range(60)]
    sents = [r for b, _ in got for r in b]
    sents += sents[:20] + [(99_001, "es0", "es", 9, 9, "  "), (99_002, "eu0", "eu", 9, 9, None)]
    index = [(f"es{k}", f"eu{k}") for k in range(60)] + [("es0", "eu0"), ("es1", None), ("es2", "es2"), (None, "eu1"), ("gone", "eu9999")]
    pairs = al.page_pairs(spark.createDataFrame(index, "url_es string, url_eu string"), spark.createDataFrame(sents, "sent_id long, url string, language string, para_no int, sent_no int, content string"))
    assert pairs.count() == 60
    model = al.train(pairs, max_train=60)
    found = rows(al.found_pairs(al.align(pairs, model)))
    want = set().union(*(p for _, p in got))
    assert len(found & want) >= 0.95 * len(want) and len(found - want) <= 0.05 * len(found)
    assert all(a < b for a, b in found)


def test_long_pages_come_in_windows(spark):
    rng = random.Random(2)
    rows_, pairs = [], set()
    for k in range(40):
        b, p = bulletin(rng, k)
        rows_ += [(i, "es" if lang == "es" else "eu", lang, k * 20 + para, n, t) for i, _, lang, para, n, t in b]
        pairs |= p
    idx = spark.createDataFrame([("es", "eu")], "url_es string, url_eu string")
    s = spark.createDataFrame(rows_, "sent_id long, url string, language string, para_no int, sent_no int, content string")
    one, many = al.page_pairs(idx, s), al.page_pairs(idx, s, window=60)
    assert one.count() == 1 and many.count() >= 4
    other = [r for k in range(150) for r in bulletin(rng, k)[0]]
    model = al.train(al.page_pairs(spark.createDataFrame([(f"es{k}", f"eu{k}") for k in range(150)], idx.schema), spark.createDataFrame(other, s.schema)))
    for p in (one, many):
        found = rows(al.found_pairs(al.align(p, model)))
        assert len(found & pairs) >= 0.9 * len(pairs) and len(found - pairs) <= 0.08 * len(found)


def test_tokens_and_clauses():
    assert al.tokens("el 6,8 % de 12:00etan a 11.421,89", set()) == ["el", "#68", "de", "#12", "etan", "a", "#1142189"]
    assert al.page_names(["En la villa de Ardoza hay pan."]) == {"Ardoza"}
    assert [al.pattern(c) for c in al.clauses("Uno, con 31 votos; salvo en Ardoza", {"Ardoza"})] == ["uno", "con # votos", "salvo en @"]


def test_table_parts():
    t = al.Table([("b", "y", 0.5, 0.25), ("a", "x", 0.75, 1.0), ("b", "x", 0.125, 0.5)])
    f, b = t.part(["a", "c", "b"], ["z", "y", "x"])
    assert f.tolist() == [[0, 0, 0.75], [0, 0, 0], [0, 0.5, 0.125]] and b.tolist() == [[0, 0, 1.0], [0, 0, 0], [0, 0.25, 0.5]]
    assert (t.column == -1).all() and t.part([], ["x"])[0].shape == (0, 1) and al.Table().part(["a"], ["x"])[0].tolist() == [[0]]


def test_edges(spark):
    i = spark.createDataFrame([], "url_es string, url_eu string")
    s = spark.createDataFrame([], "sent_id long, url string, language string, para_no int, sent_no int, content string")
    p = al.page_pairs(i, s)
    assert al.found_pairs(al.align(p, al.train(p, rounds=2))).isEmpty()
    assert al.Pages([], ["x"], al.Model()).decode() == [] and al.Pages(["uno"], [], al.Model()).decode() == []
    p = al.Pages(*al.marked(["uno 5 casa"], ["etxe 5"]), al.Model())
    assert p.decode() == [(0, 0, p.scores()[0, 0] / 2)] and p.S == [["uno", "#5", "casa"]]
    assert [al.parts_of(x) for x in al.marked(["Uno, dos 3; 4"], ["..."])[0]] == [[["uno"], ["dos", "#3"], ["#4"]]] and al.parts_of("") == [[]]


def test_far_counterparts_on_long_pages_are_found(spark):
    rng = random.Random(3)
    words = sorted(WORDS)
    src = [(rng.sample(words, 6), 1000 + k) for k in range(60)]
    es = [(k, "es", "es", k, k, f"El {' '.join(w)} de {x} metros.") for k, (w, x) in enumerate(src)]
    order = [*range(4, 54), 0, 1, 2, 3, *range(54, 60)]  # the first passage stands near the target's end
    eu = [(1000 + j, "eu", "eu", j, j, f"{src[i][1]} metroko {' '.join(WORDS[a] for a in reversed(src[i][0]))} da.") for j, i in enumerate(order)]
    other = [r for k in range(150) for r in bulletin(rng, k)[0]]
    sch = "sent_id long, url string, language string, para_no int, sent_no int, content string"
    model = al.train(al.page_pairs(spark.createDataFrame([(f"es{k}", f"eu{k}") for k in range(150)], "url_es string, url_eu string"), spark.createDataFrame(other, sch)))
    p = al.page_pairs(spark.createDataFrame([("es", "eu")], "url_es string, url_eu string"), spark.createDataFrame(es + eu, sch), window=20)
    assert p.count() == 3 and {len(r["es"]) for r in p.collect()} == {60}
    assert {(k, 1050 + k) for k in range(4)} <= rows(al.found_pairs(al.align(p, model)))


def test_tiles_give_the_same_as_whole_pages(spark):
    rng = random.Random(4)
    es, eu = [], []
    for k in range(6):
        b, _ = bulletin(rng, k)
        es += [r[5] for r in b if r[2] == "es"]
        eu += [r[5] for r in b if r[2] == "eu"]
    other = [r for k in range(100) for r in bulletin(rng, k)[0]]
    model = al.train(al.page_pairs(spark.createDataFrame([(f"es{k}", f"eu{k}") for k in range(100)], "url_es string, url_eu string"), spark.createDataFrame(other, "sent_id long, url string, language string, para_no int, sent_no int, content string")))
    es, eu = al.marked(es, eu)
    for m in (al.Model(), model.model()):
        whole, tiled = al.Pages(es, eu, m), al.LongPages(es, eu, m, tile=7, cells=500)
        a, b = whole.decode(), tiled.decode()
        assert [x[:2] for x in a] == [x[:2] for x in b] and max(abs(x[2] - y[2]) for x, y in zip(a, b, strict=True)) < 1e-9
        if m.trained:
            assert all(abs(whole.hit(i, j) - tiled.hit(i, j)) < 1e-9 for i, j, _ in a)
        c, d = whole.counts(a), tiled.counts(b)
        assert c.keys() == d.keys() and all(abs(c[k] - d[k]) < 1e-6 for k in c)


def test_all_page_pairs_count(spark):
    text = [(f"El perro ladra en {k} metros.", f"{k} metrotan zakurra da.") for k in range(3200)]
    pairs = spark.createDataFrame([(k, [2 * k], [a], [2 * k + 1], [b], 0, 1) for k, (a, b) in enumerate(text)], "pair long, es_ids array<long>, es array<string>, eu_ids array<long>, eu array<string>, at long, of long")
    rare = spark.createDataFrame([(9000 + k, [9000 + 2 * k], [f"Sol {w}."], [9001 + 2 * k], [f"Eguzki {w}."], 0, 1) for k, w in enumerate(["ardo", "ardo"])], pairs.schema)
    model = al.train(pairs.unionByName(rare), rounds=1).model()
    assert round(model.bg_s["#"] / model.bg_s["ardo"]) == 1600 and "ardo" in model.table.source


def test_a_divided_table_gives_the_same(spark):
    rng = random.Random(6)
    sents = [r for k in range(40) for r in bulletin(rng, k)[0]]
    idx = spark.createDataFrame([(f"es{k}", f"eu{k}") for k in range(40)], "url_es string, url_eu string")
    pairs = al.page_pairs(idx, spark.createDataFrame(sents, "sent_id long, url string, language string, para_no int, sent_no int, content string")).cache()
    one, many = al.train(pairs, rounds=3), al.train(pairs, rounds=3, max_entries=0)
    assert many.spread() and not one.spread()
    a, b = one.model(), many.model()
    assert a.table.source.keys() == b.table.source.keys() and len(a.table.f) == len(b.table.f) and a.loose == b.loose and all(abs(a.rate_s[w] - b.rate_s[w]) < 1e-9 for w in a.rate_s)
    assert rows(al.found_pairs(al.align(pairs, one))) == rows(al.found_pairs(al.align(pairs, many)))
    assert al.found_pairs(al.align(pairs.where("pair is null"), many)).isEmpty()
