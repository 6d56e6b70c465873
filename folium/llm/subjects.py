"""Problem 6: the subject areas of each document, and the composition of the corpus by area.

Method: averaged word and subword embeddings with independent logistic outputs, one for each area. The unit that is
trained on and scored is the sentence; a sentence's label is its document's declared area. These labels are noisy: most
sentences of a document are about nothing or something else, and some declared areas are wrong. But the outputs learn
the chance of each label given the sentence, and a sentence that deals with an area has that area's label several times
as often as one that mentions its things in passing or says nothing of it. A paragraph is about an area if one of
its sentences is well above that area's share of all labels; a document if enough of its paragraphs are.

Training is synchronous: in every round each partition sends the gradient over its rows, and the driver adds them and
moves the parameters. Rows are a bounded sample of labelled sentences (max_rows); everything else covers all data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.llm.features import bag, fold, segments, subwords, words
from folium.session import cut, slots


@dataclass
class Params:
    """embed (buckets, dim), out (dim, areas), bias (areas); base: each area's share of the labels."""

    areas: list[str]
    embed: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    base: np.ndarray

    def thresholds(self, lift: float) -> np.ndarray:
        """What a sentence must reach: the area's share of all labels, and `lift` of the way from there to certainty."""
        return self.base + lift * (1 - self.base)

    def scores(self, bags: list[list[int]]) -> np.ndarray:
        """(len(bags), areas): the chance of each area; an empty bag gets the bias alone."""
        n = np.array([len(b) for b in bags], dtype=np.int64)
        h = np.zeros((len(bags), self.embed.shape[1]), dtype=np.float32)
        some = np.flatnonzero(n)
        if len(some):
            values = np.fromiter(chain.from_iterable(bags), dtype=np.int64, count=int(n.sum()))
            h[some] = np.add.reduceat(self.embed[values], np.r_[0, np.cumsum(n[some])[:-1]], axis=0) / n[some, None]
        return 1 / (1 + np.exp(-(h @ self.out + self.bias)))


#: Sentences of one block.
BLOCK = 16_384
BLOCK_FIELDS = ("word_bucket", "word_from", "row_word", "row_from", "row_size", "sorted_row", "sorted_from", "sorted_word", "bucket_from", "bucket", "label", "weight")


def block(texts: list[str], labels: list[int], weights: list[float], buckets: int) -> dict[str, np.ndarray] | None:
    """Sentences as word numbers, and words as buckets, with the orders in which gradients are summed; None without a word.

    A sentence is the mean of all its words' buckets, so the buckets of a word are summed once a round for all
    sentences that have it. Sentences without a word are left out.
    """
    ids: dict[str, int] = {}
    row_word, counts, keep = [], [], []
    for k, t in enumerate(texts):
        ws = words(t)
        if ws:
            row_word += [ids.setdefault(w, len(ids)) for w in ws]
            counts.append(len(ws))
            keep.append(k)
    if not keep:
        return None
    parts = [subwords(w, buckets) for w in ids]
    size = np.array([len(p) for p in parts], dtype=np.int32)
    word_bucket = np.fromiter(chain.from_iterable(parts), dtype=np.int32, count=int(size.sum()))
    rw, n = np.array(row_word, dtype=np.int32), np.array(counts, dtype=np.int64)
    row_from = np.r_[0, np.cumsum(n)[:-1]]
    by_word, by_bucket = np.argsort(rw, kind="stable"), np.argsort(word_bucket, kind="stable")
    sb = word_bucket[by_bucket]
    bucket_from = np.flatnonzero(np.r_[True, sb[1:] != sb[:-1]])
    got = (
        word_bucket, np.r_[0, np.cumsum(size)[:-1]], rw, row_from, np.add.reduceat(size[rw], row_from),
        np.repeat(np.arange(len(n)), n)[by_word], np.r_[0, np.cumsum(np.bincount(rw))[:-1]],
        np.repeat(np.arange(len(size)), size)[by_bucket], bucket_from, sb[bucket_from], np.array(labels)[keep],
    )
    return {k: x.astype(np.int32) for k, x in zip(BLOCK_FIELDS, got, strict=False)} | {"weight": np.array(weights, dtype=np.float32)[keep]}


def gradient(embed: np.ndarray, out: np.ndarray, bias: np.ndarray, b: dict[str, np.ndarray]) -> np.ndarray:
    """The flat gradient of the weighted logistic loss over a block, all parameters one after another."""
    size = b["row_size"][:, None].astype(np.float32)
    by_word = np.add.reduceat(embed[b["word_bucket"]], b["word_from"], axis=0)
    h = np.add.reduceat(by_word[b["row_word"]], b["row_from"], axis=0) / size
    y = np.zeros((len(h), len(bias)), dtype=np.float32)
    has = np.flatnonzero(b["label"] >= 0)
    y[has, b["label"][has]] = 1
    d = (1 / (1 + np.exp(-(h @ out + bias))) - y) * b["weight"][:, None]
    gh = (d @ out.T) / size
    gw = np.add.reduceat(gh[b["sorted_row"]], b["sorted_from"], axis=0)
    ge = np.zeros_like(embed)
    ge[b["bucket"]] = np.add.reduceat(gw[b["sorted_word"]], b["bucket_from"], axis=0)
    return np.concatenate([ge.ravel(), (h.T @ d).ravel(), d.sum(axis=0)]).astype(np.float32)


def labelled_sentences(docs: DataFrame, areas: list[str], id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(h, label int, t, n): all sentences of labelled documents, each with its declared areas; label -1 is none of the areas.

    Equal sentences (figures aside) with equal labels are one row with their number; h is the hash of the sentence. A
    document delivered more than once counts once; a null or blank label is none.
    """
    known = {a.strip().lower(): k for k, a in enumerate(areas)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts, labels = [], []
                for ps, lab in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    k = known.get(lab.strip().lower(), -1)
                    for p in ps or []:
                        for x, y in segments(p):
                            texts.append("".join("0" if c.isdigit() else c for c in fold(p[x:y])))
                            labels.append(k)
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.int32())], names=["t", "label"])

    labelled = docs.select(id_col, text_col, F.col(label_col).cast("string").alias("_l")).where(F.trim("_l") != "").dropDuplicates([id_col])
    rows = labelled.select(text_col, "_l").mapInArrow(run, "t string, label int")
    return rows.groupBy(F.xxhash64("t").alias("h"), "label").agg(F.first("t").alias("t"), F.count("*").cast("double").alias("n"))


def train(
    docs: DataFrame, areas: list[str], *, id_col: str = "pdoc_id", text_col: str = "paragraphs", label_col: str = "domain",
    buckets: int = 1 << 15, dim: int = 12, rounds: int = 40, rate: float = 0.08, decay: float = 0.04, floor: float = 1e-5, max_rows: int = 150_000, parts: int | None = None, seed: int = 7,
) -> Params:
    """Parameters after so many synchronous rounds of Adam over the sample. No labelled row: everything scores near 0.

    The sample is about max_rows distinct sentences, those of lowest hash, each with all its labels, whose shares are
    what is learned; it doesn't depend on how the input is divided. The areas' shares are of all labelled sentences.
    """
    spark = docs.sparkSession
    rng = np.random.default_rng(seed)
    A = len(areas)
    p = Params(areas, (rng.standard_normal((buckets, dim)) * 0.1).astype(np.float32), (rng.standard_normal((dim, A)) * 0.5).astype(np.float32), np.full(A, -2.0, dtype=np.float32), np.zeros(A))
    parts = parts or slots(spark, 8)
    rows = cut(labelled_sentences(docs, areas, id_col, text_col, label_col))
    worded = F.col("t").rlike(r"\p{L}")
    counts = {r["label"]: r for r in rows.where(worded).groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    total = sum(r["n"] for r in counts.values())
    if not total:
        p.bias[:] = -9
        return p
    p.base[:] = [counts[k]["n"] / total if k in counts else 0.0 for k in range(A)]
    sample = rows.where(worded)
    if (share := max_rows / sum(r["k"] for r in counts.values())) < 1:
        sample = sample.where(F.col("h") < F.lit(int(-(2**63) + share * 2**64)))
    kind = {f: np.dtype("f4" if f == "weight" else "i4") for f in BLOCK_FIELDS}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[list[str], list[int], list[float]] = ([], [], [])

        def full() -> Iterator[pa.RecordBatch]:
            got = block(*waiting, buckets)
            for x in waiting:
                x.clear()
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([got[f].astype(kind[f]).tobytes()], pa.binary()) for f in BLOCK_FIELDS] + [pa.array([float(got["weight"].sum())])], names=[*BLOCK_FIELDS, "total"])

        for b in batches:
            for k in range(3):
                waiting[k].extend(b.column(k).to_pylist())
            if len(waiting[0]) >= BLOCK:
                yield from full()
        yield from full()

    schema = ", ".join(f"{f} binary" for f in BLOCK_FIELDS) + ", total double"
    data = cut(sample.select("t", "label", "n", "h").repartitionByRange(parts, "h").sortWithinPartitions("h", "label").select("t", "label", "n").mapInArrow(blocks, schema))
    used = data.agg(F.sum("total")).first()[0]
    sizes = (p.embed.size, p.out.size, p.bias.size)
    flat = np.concatenate([p.embed.ravel(), p.out.ravel(), p.bias])
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for r in range(1, rounds + 1):
        sent = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            x = sent.value
            e, o, c = x[: sizes[0]].reshape(buckets, dim), x[sizes[0] : sizes[0] + sizes[1]].reshape(dim, A), x[-A:]
            g = None
            for batch in batches:
                for k in range(batch.num_rows):
                    d = gradient(e, o, c, {f: np.frombuffer(batch.column(f)[k].as_buffer(), dtype=kind[f]) for f in BLOCK_FIELDS})
                    g = d if g is None else g + d
            if g is not None:
                yield pa.RecordBatch.from_arrays([pa.array([g.tobytes()], pa.binary())], names=["g"])

        got = data.mapInArrow(run, "g binary").collect()  # one gradient a partition
        sent.destroy()
        g = sum(np.frombuffer(row["g"], dtype=np.float32) for row in got) / used
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        flat = flat - rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + floor)
        flat[:-A] *= 1 - decay
        flat = flat.astype(np.float32)
    p.embed, p.out, p.bias = flat[: sizes[0]].reshape(buckets, dim), flat[sizes[0] : sizes[0] + sizes[1]].reshape(dim, A), flat[-A:]
    return p


def paragraph_areas(docs: DataFrame, p: Params, *, id_col: str = "pdoc_id", text_col: str = "paragraphs", lift: float = 0.18) -> DataFrame:
    """(id_col, para_no, domain, score): the areas that a paragraph is about; score is its best sentence's."""
    kind = docs.schema[id_col].dataType
    sent = docs.sparkSession.sparkContext.broadcast(p)
    buckets = p.embed.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        par = sent.value
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                at, bags = [], []
                for r, ps in enumerate(b.column(1).to_pylist()):
                    for q, text in enumerate(ps or []):
                        for x, y in segments(text):
                            got = bag(fold(text[x:y]), buckets)
                            if got:
                                at.append((r, q))
                                bags.append(got)
                best: dict[tuple[int, int, int], float] = {}
                s = par.scores(bags) if bags else np.zeros((0, len(par.areas)))
                for i, a in zip(*np.nonzero(s >= par.thresholds(lift)), strict=True):
                    key = (*at[i], int(a))
                    best[key] = max(best.get(key, 0.0), float(s[i, a]))
                keys = list(best)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([x[0] for x in keys], pa.int64())), pa.array([x[1] for x in keys], pa.int32()), pa.array([par.areas[x[2]] for x in keys], pa.string()), pa.array([best[x] for x in keys], pa.float64())], names=[id_col, "para_no", "domain", "score"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("para_no", T.IntegerType()), T.StructField("domain", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def document_areas(paragraphs: DataFrame, id_col: str = "pdoc_id", least: int = 2) -> DataFrame:
    """(id_col, domain, n_paragraphs, score): the areas that at least `least` paragraphs of a document are about.

    A document delivered more than once counts its paragraphs once. Documents about no area have no row.
    """
    once = paragraphs.groupBy(id_col, "domain", "para_no").agg(F.max("score").alias("score"))
    return once.groupBy(id_col, "domain").agg(F.count("*").alias("n_paragraphs"), F.avg("score").alias("score")).where(F.col("n_paragraphs") >= least)


def composition(doc_areas: DataFrame, docs: DataFrame, areas: DataFrame, id_col: str = "pdoc_id") -> DataFrame:
    """(domain, documents, paragraphs, share): every area with its documents and their share of all documents."""
    n = docs.agg(F.count_distinct(id_col).alias("n"))
    by = doc_areas.groupBy("domain").agg(F.count("*").alias("d"), F.sum("n_paragraphs").alias("p"))
    return areas.select("domain").distinct().join(by, "domain", "left").crossJoin(F.broadcast(n)).select("domain", F.coalesce("d", F.lit(0)).alias("documents"), F.coalesce("p", F.lit(0)).alias("paragraphs"), F.round(F.coalesce(F.col("d") / F.when(F.col("n") > 0, F.col("n")), F.lit(0.0)), 6).alias("share"))
