import random

import numpy as np

from folium.llm import subjects
from folium.llm.features import bag, fold

TOPICS = {"law": "el tribunal anuló la sentencia del juez por falta de prueba", "sport": "la delantera marcó tantos y decidió el torneo de pelota", "tax": "la hacienda calcula la cuota del impuesto sobre la renta"}
NEUTRAL = ["el orden de las filas no tiene significado", "se ruega devolver la hoja antes de las horas", "quien lo desee puede consultar la nota al pie"]
PASSING = ["un juez olvidado revisó el texto de la sala", "había un balón de pelota en la sala", "el sello de la hacienda aparece borroso"]


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows, truth = [], set()
    for k in range(n):
        own = rng.sample(sorted(TOPICS), rng.choice([0, 1, 1, 2]))
        paras, count = [], dict.fromkeys(own, 0)
        for _ in range(rng.randrange(3, 8)):
            s = [rng.choice(NEUTRAL)]
            if own and rng.random() < 0.7:
                a = rng.choice(own)
                count[a] += 1
                w = TOPICS[a].split()
                s = [" ".join([*w[:5], *rng.sample(w[5:], len(w) - 5)])]
            if rng.random() < 0.3:
                s.append(rng.choice(PASSING))
            paras.append(". ".join(x[0].upper() + x[1:] for x in s) + f" {rng.randrange(99)}.")
        truth |= {(k, a) for a, c in count.items() if c >= 2}
        label = None if rng.random() < 0.5 else rng.choice(own) if own and rng.random() < 0.9 else rng.choice([*TOPICS, "other"])
        rows.append((k, [*paras, None, ""], label, 1))
    return spark.createDataFrame(rows, "pdoc_id long, paragraphs array<string>, domain string, para_no int"), truth


def test_areas_of_held_out_documents(spark):
    d, _ = corpus(spark)
    p = subjects.train(d, sorted(TOPICS), buckets=1 << 12)
    held, truth = corpus(spark, 150, seed=9)
    got = {(r["pdoc_id"], r["domain"]) for r in subjects.document_areas(subjects.paragraph_areas(held, p)).collect()}
    assert len(got & truth) >= 0.95 * len(truth) and len(got - truth) <= 0.05 * len(got)
    areas = spark.createDataFrame([(a,) for a in [*TOPICS, "none"]], "domain string")
    comp = {r["domain"]: r["documents"] for r in subjects.composition(subjects.document_areas(subjects.paragraph_areas(held, p)), held, areas).collect()}
    assert set(comp) == {*TOPICS, "none"} and comp["none"] == 0 and sum(comp.values()) == len(got)
    twice = subjects.document_areas(subjects.paragraph_areas(held.union(held), p))
    assert {(r["pdoc_id"], r["domain"], r["n_paragraphs"]) for r in twice.collect()} == {(r["pdoc_id"], r["domain"], r["n_paragraphs"]) for r in subjects.document_areas(subjects.paragraph_areas(held, p)).collect()}


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    texts = ["uno dos", "12 /", "dos tres dos", "cuatro"]
    b = subjects.block(texts, [0, 0, 1, -1], [2.0, 5.0, 1.0, 3.0], 23)
    e, o, c = rng.standard_normal((23, 3)), rng.standard_normal((3, 2)), rng.standard_normal(2)
    bags = [bag(t, 23) for t in texts if bag(t, 23)]
    y, w = np.array([[1.0, 0], [0, 1], [0, 0]]), np.array([2.0, 1.0, 3.0])

    def loss(x):
        ee, oo, cc = x[:69].reshape(23, 3), x[69:75].reshape(3, 2), x[75:]
        s = 1 / (1 + np.exp(-(np.array([ee[k].mean(0) for k in bags]) @ oo + cc)))
        return -(w[:, None] * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    flat = np.concatenate([e.ravel(), o.ravel(), c])
    g = subjects.gradient(e, o, c, b)
    for k in range(len(flat)):
        d = np.zeros_like(flat)
        d[k] = 1e-5
        assert abs((loss(flat + d) - loss(flat - d)) / 2e-5 - g[k]) < 1e-3
    assert subjects.block(["12 /", ""], [0, 1], [1.0, 1.0], 23) is None


def test_shares_are_of_all_sentences(spark):
    d, _ = corpus(spark)
    whole = subjects.train(d, sorted(TOPICS), buckets=64, rounds=1)
    some = subjects.train(d.union(d), sorted(TOPICS), buckets=64, rounds=1, max_rows=50)
    assert np.allclose(whole.base, some.base) and 0 < whole.base.sum() < 1


def test_edges(spark):
    empty = spark.createDataFrame([], "pdoc_id long, paragraphs array<string>, domain string")
    p = subjects.train(empty, ["a", "b"], buckets=64, rounds=2)
    assert subjects.paragraph_areas(empty, p).isEmpty()
    odd = spark.createDataFrame([(1, None, "a"), (2, [None, ""], None), (None, ["x" * 20000], "zzz")], empty.schema)
    assert subjects.document_areas(subjects.paragraph_areas(odd, p)).isEmpty()
    assert subjects.train(odd, ["a"], buckets=64, rounds=2).embed.shape[0] == 64
    assert bag(fold("ÁRBOL"), 1000) == bag(fold("arbol"), 1000)
