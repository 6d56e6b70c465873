import random

import pytest

from folium.llm import scans as sc
from folium.session import table
from tests.conftest import TINY, rows

BASE = "el orden de las filas en la hoja suelta no tiene significado para la presión admisible del cilindro según la norma vigente que confirma el tribunal municipal durante cada jornada".split()


def pages(rng, files=6, n_pages=8):
    """Blocks with planted noise, and what was planted."""
    blocks, want, bid = [], set(), 0
    for f in range(files):
        for p in range(1, n_pages + 1):
            for k in range(2):
                bid += 1
                words = [rng.choice(BASE) for _ in range(30)]
                lines, at = [], 0
                while at < len(words):
                    lines.append(words[at : at + 6])
                    at += 6
                out = []
                shift = 1
                if k == 0 and p > 1:
                    out.append(f"Catálogo de bombas {f} 2020")
                    want.add((bid, 1, "header", ""))
                    shift = 2
                for i, ws in enumerate(lines):
                    ws = list(ws)
                    if rng.random() < 0.08:
                        w = ws[2]
                        for a, b in (("m", "rn"), ("d", "cl"), ("t", "f"), ("u", "ii"), ("o", "0"), ("l", "1")):
                            if a in w and len(w) > 4:
                                ws[2] = w.replace(a, b, 1)
                                want.add((bid, i + shift, "char", w))
                                break
                    out.append(" ".join(ws))
                if rng.random() < 0.5:
                    i = rng.randrange(len(lines) - 1)
                    w = "significado"
                    out[i + shift - 1] += " signi-"
                    out[i + shift] = "ficado " + out[i + shift]
                    want.add((bid, i + shift, "hyphen", w))
                if k == 1:
                    out.append(f"- {p} -")
                    want.add((bid, len(out), "page_number", ""))
                out[shift - 1] = out[shift - 1].capitalize()
                blocks.append((bid, f"f{f}.json", None if rng.random() < 0.1 else p, "paragraph", "", "\n".join(out)))
            if p > 1 and rng.random() < 0.6:
                bid += 1
                blocks.append((bid, f"f{f}.json", p, "paragraph", "pageHeader", f"CATÁLOGO DE BOMBAS {f} 2020"))
                want.add((bid, 1, "header", ""))
    return blocks, want


def test_planted_noise_is_found_and_mended(spark):
    blocks, want = pages(random.Random(3))
    d = spark.createDataFrame([*blocks, *blocks[:4], (9999, None, None, None, None, None), (9998, "f", 1, "line", None, "  ")], "block_id long, file string, page int, block_type string, role string, content string")
    r = sc.find_noise(d)
    got = {(a, b, c, e if c != "char" else e) for a, b, c, e in rows(r.found())}
    low = lambda s: {(a, b, c, e.lower()) for a, b, c, e in s}
    for kind, share in (("page_number", 0.95), ("header", 0.9), ("hyphen", 0.95), ("char", 0.85)):
        w, g = {x for x in low(want) if x[2] == kind}, {x for x in low(got) if x[2] == kind}
        assert len(w & g) >= share * len(w), (kind, sorted(w - g)[:5])
        assert len(g - w) <= 0.1 * len(g), (kind, sorted(g - w)[:5])
    texts = {x["block_id"]: x["text"] for x in sc.paragraphs(r).collect()}
    assert len(texts) == len({b[0] for b in blocks})
    assert all("\n" not in t and "signi-" not in t and "Catálogo" not in t for t in texts.values())


@pytest.mark.parametrize(("line", "n"), [("12", 12), ("— 3 —", 3), ("xiv", 14), ("3/10", 3), ("pág. 7", 7), ("Page 4 of 9", 4), ("22. or.", 22), ("~5~", 5), ("[8]", 8), ("740 bar", None), ("mm.", None), ("17).", None), ("2018.", None), ("", None), ("página 4.", None)])
def test_number_lines(line, n):
    got = sc.number_form(line)
    assert (got[1] if got else None) == n


def test_operations_restore_the_word():
    rng = random.Random(0)
    rules = {}
    for r in sc.SHAPES:
        a, b = r.split()
        rules.setdefault(a, []).append(b)
    for w in ("municipal", "torneo", "clave", "hierro", "2040"):
        for _ in range(30):
            read, ops = sc.operations(w, rng, rules, 2)
            back = "".join(c if o == sc.KEEP else "" if o == sc.DROP else o[8:] for c, o in zip(read, ops, strict=True))
            assert back == w


def test_averaged_perceptron_learns():
    rng = random.Random(1)
    data = [([f"a{x}", f"b{rng.randrange(5)}"], ["p", "q"], "p" if x else "q") for x in (rng.randrange(2) for _ in range(200))]
    m = sc.Perceptron.fit(data)
    assert all(max(s, key=s.get) == y for f, labs, y in data for s in [m.score(f, labs)])


def test_all_single_edits_are_proposed():
    opts = {"l": [sc.KEEP, "replace i", "replace h", sc.DROP], "i": [sc.KEEP, "replace l", "replace n", sc.DROP], "r": [sc.KEEP, "replace m"], "n": [sc.KEEP, sc.DROP]}
    e = sc.Editor(sc.Perceptron(), opts)
    for s in ("lilrnlilirnilliril" * 3, "rn", "x", ""):
        want = set()
        for i, c in enumerate(s):
            for o in opts.get(c, ()):
                if o.startswith("replace"):
                    want.add(s[:i] + o[8:] + s[i + 1 :])
                    if i + 1 < len(s) and sc.DROP in opts.get(s[i + 1], ()):
                        want.add(s[:i] + o[8:] + s[i + 2 :])
        got = e.proposals(s)
        assert {t for t, _, n in got if n == 1} == want - {s}
        assert e.proposals(s, 1) == [x for x in got if x[2] == 1]


def test_places_on_pages_of_many_chunks(spark):
    rng = random.Random(8)
    data = [(k, rng.choice(["a", "b", None]), rng.choice([1, 1, None, 2]) if k > 40 else None) for k in range(300)]
    got = {r["block_id"]: (r["page_key"], r["top"], r["bottom"]) for r in sc.placed_blocks(spark.createDataFrame(data, "block_id long, file string, page int"), chunk=16).collect()}
    last, pages_ = {}, {}
    for k, f, p in data:
        last[f] = p if p is not None else last.get(f)
        pages_.setdefault((f, float(p) if p is not None else (last[f] or 0) + 0.5), []).append(k)
    assert got == {k: (key[1], i + 1, len(ks) - i) for key, ks in pages_.items() for i, k in enumerate(ks)}


def test_edges(spark):
    d = table(spark, TINY, "ocr_blocks")
    assert sc.find_noise(d.limit(0)).found().isEmpty()
    f = sc.find_noise(d.withColumnRenamed("doc_title", "kind")).found()
    assert f.count() == f.distinct().count() > 0
    assert {r["kind"] for r in f.select("kind").distinct().collect()} <= {"header", "page_number", "hyphen", "char"}
