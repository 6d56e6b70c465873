"""Problem 7: the language of each document and of each segment of another language within it.

Method: Bayesian evidence fusion. The likelihood of a segment's text under each language comes from a character and
word model; it is combined with the chance of each language given what the record declares, given a language code at
the end of its address, and given its host, the latter smoothed from all records over the host to the host's year. The
chances of languages given declared codes, suffixes and hosts are grouped counts over all data, taken with the
languages that the text alone suggests; so a label that is often wrong persuades little, and a segment that has
little text of its own follows its document and host.

The text model is trained on records that declare one of the languages (a bounded sample, per_language), once with
the declared languages and again with those that the first model gives to each segment.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.llm.features import fold, segments, words
from folium.session import cut, lowest

LANGUAGES = ("es", "eu", "en", "fr")
# Names and codes of the languages, without case and region.
NAMES = {
    "es": "es spa esp español espanol castellano castilian spanish espagnol gaztelania espainiera",
    "eu": "eu eus baq euskara euskera vasco basque",
    "en": "en eng english inglés ingles anglais ingelesa",
    "fr": "fr fra fre français francais francés frances french frantsesa",
}
# What stands for no language.
PLACEHOLDERS = "und unknown unk mul mis zxx none null nil nan n/a na other ? ?? ??? - -- xx"


def declared_language(c: Column) -> Column:
    """A declared label as es, eu, en or fr; null if it is missing or a placeholder; `other` for any other name."""
    raw = F.lower(F.trim(c.cast("string")))
    base = F.regexp_replace(raw, r"^([a-z]{2,3})[-_].*$", "$1")
    out = F.when(raw.isNull() | (raw == "") | raw.isin(*PLACEHOLDERS.split()) | ~raw.rlike(r"\p{L}"), F.lit(None).cast("string"))
    for k, names in NAMES.items():
        out = out.when(raw.isin(*names.split()) | base.isin(*names.split()), k)
    return out.otherwise("other")


def address_suffix(c: Column) -> Column:
    """A language code that an address or file name carries: /es/, .eus, -EU.json; null if none."""
    s = F.lower(c.cast("string"))
    got = F.regexp_extract(s, r"(?:[-_./](es|eu|eus|en|fr)(?:\.[a-z]{2,5})?$)|(?:/(es|eu|en|fr)/)", 0)
    code = F.regexp_extract(got, r"(eus|es|eu|en|fr)", 1)
    return F.when(code == "eus", "eu").when(code != "", code)


def host_of(c: Column) -> Column:
    """The host of an address, or what stands before the first underscore or digit of a file name."""
    s = F.lower(c.cast("string"))
    host = F.regexp_extract(s, r"^[a-z]+://([^/]+)", 1)
    return F.when(host != "", host).otherwise(F.regexp_extract(s, r"^([^_\d]*)", 1))


#: What a figure is part of, such as a code or a date, is no word of a language.
CODE = regex.compile(r"\S*\p{N}\S*")


@dataclass
class TextModel:
    """Log-likelihoods of words and of 3-character pieces under each language."""

    vocab: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]
    unseen: np.ndarray

    def loglik(self, folded: str) -> tuple[np.ndarray, int]:
        """(log-likelihood by language, number of words). A word unknown as a whole counts by its pieces."""
        out, n = np.zeros(len(LANGUAGES)), 0
        for w in words(CODE.sub(" ", folded)):
            if len(w) < 2 and w not in "aeoyu":
                continue
            v = self.vocab.get(w)
            if v is not None:
                n += 1
                out = out + v
                continue
            if len(w) < 3:
                continue
            n += 1
            x, k, s = f"<{w}>", 0, np.zeros(len(LANGUAGES))
            for i in range(len(x) - 2):
                g = self.grams.get(x[i : i + 3])
                if g is not None:
                    s = s + g
                    k += 1
            if k:
                out = out + s * min(1.0, 2.0 / k)
        return out, n

    @staticmethod
    def fit(rows: list[tuple[str, np.ndarray]], least: int = 3) -> TextModel:
        """From (folded text, weight by language)."""
        L = len(LANGUAGES)
        wc: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(L))
        gc: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(L))
        for text, weight in rows:
            for w in words(CODE.sub(" ", text)):
                wc[w] += weight
        for w, c in wc.items():
            x = f"<{w}>"
            for i in range(len(x) - 2):
                gc[x[i : i + 3]] += c
        total = sum(wc.values(), np.zeros(L)) + 1.0
        gtotal = sum(gc.values(), np.zeros(L)) + 1.0
        # each count is seen against the language's whole, so languages with many records don't draw words to them
        vocab = {w: np.clip(np.log((c + 0.1 * total / total.sum()) / total), -30, 0) for w, c in wc.items() if c.sum() >= least}
        grams = {g: np.log((c + 1.0) / gtotal) for g, c in gc.items()}
        vocab = {w: v - v.max() for w, v in vocab.items()}
        grams = {g: v - v.max() for g, v in grams.items()}
        # one word never settles it alone
        vocab = {w: np.maximum(v, -5.0) for w, v in vocab.items()}
        grams = {g: np.maximum(v, -2.0) for g, v in grams.items()}
        return TextModel(vocab, grams, np.zeros(L))


def fit_text_model(docs: DataFrame, id_col: str = "pdoc_id", text_col: str = "paragraphs", lang_col: str = "language", per_language: int = 1500) -> TextModel:
    """Trained on at most per_language records of each declared language, those of lowest hash."""
    rows = docs.select(F.xxhash64(F.col(id_col)).alias("h"), declared_language(F.col(lang_col)).alias("l"), F.col(text_col).alias("p")).where(F.col("l").isin(*LANGUAGES))
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    got = []
    for lang in LANGUAGES:  # a bounded number of records each
        got += [(lang, r["p"]) for r in lowest(rows.where(F.col("l") == lang), "h", per_language, sizes.get(lang, 0)).select("p").collect()]
    first, pieces = [], []
    for lang, ps in got:
        w = np.array([float(lang == x) for x in LANGUAGES])
        for p in ps or []:
            for a, b in segments(p):
                t = fold(p[a:b])
                first.append((t, w))
                pieces.append(t)
    model = TextModel.fit(first)
    again = []
    for t in pieces:
        ll, n = model.loglik(t)
        if n >= 2:
            again.append((t, np.eye(len(LANGUAGES))[int(ll.argmax())]))
    return TextModel.fit(again) if again else model


SEGMENTS = T.StructType([
    T.StructField("para_no", T.IntegerType()), T.StructField("seg_no", T.IntegerType()), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType()),
    T.StructField("n_words", T.IntegerType()), T.StructField("ll", T.ArrayType(T.DoubleType())),
])


def segment_likelihoods(docs: DataFrame, model: TextModel, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """(id_col, keep..., para_no, seg_no, start_pos, end_pos, n_words, ll): each sentence that has a word."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                at, rows = [], []
                for r, ps in enumerate(b.column(len(names)).to_pylist()):
                    for q, text in enumerate(ps or []):
                        s = 0
                        for x, y in segments(text):
                            ll, n = m.loglik(fold(text[x:y]))
                            if n:
                                at.append(r)
                                rows.append((q, s, x, y, n, ll.tolist()))
                                s += 1
                take = pa.array(at, pa.int64())
                cols = [b.column(i).take(take) for i in range(len(names))]
                kinds = [pa.int32()] * 5 + [pa.list_(pa.float64())]
                cols += [pa.array([x[i] for x in rows], kinds[i]) for i in range(6)]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *SEGMENTS.names])

    schema = T.StructType([docs.schema[c] for c in names] + SEGMENTS.fields)
    return docs.select(*names, text_col).mapInArrow(run, schema)


def _vector(counts: Column) -> Column:
    return F.array(*[counts.getItem(k) for k in range(len(LANGUAGES))])


def classify(
    docs: DataFrame, model: TextModel | None = None, *, id_col: str = "pdoc_id", text_col: str = "paragraphs", lang_col: str = "language", source_col: str = "source", date_col: str = "date_published",
    strength: float = 20.0, doc_weight: float = 0.15, sure_words: int = 4,
) -> DataFrame:
    """(id_col, declared, para_no, seg_no, start_pos, end_pos, n_words, language, confidence): the language of each segment.

    A document delivered more than once is classified once. Segments without a word (blanks, codes, figures) and null
    paragraphs have no row. confidence is the posterior of the language. All evidence but the text is counted over all
    documents. declared is the label read as a language, null or `other`.
    """
    model = model or fit_text_model(docs, id_col, text_col, lang_col)
    L = range(len(LANGUAGES))
    once = docs.dropDuplicates([id_col]).select(
        F.col(id_col), F.col(text_col), declared_language(F.col(lang_col)).alias("_d"), address_suffix(F.col(source_col)).alias("_s"), host_of(F.col(source_col)).alias("_h"), F.substring(F.col(date_col).cast("string"), 1, 4).alias("_y"))
    once = once.withColumns({c: F.coalesce(c, F.lit("")) for c in ("_d", "_s", "_h", "_y")})
    seg = cut(segment_likelihoods(once, model, id_col, text_col, ["_d", "_s", "_h", "_y"]))
    best = F.array_position(F.col("ll"), F.array_max("ll")).cast("int") - 1
    votes = [F.sum(F.when((best == k) & (F.col("n_words") >= sure_words), F.least(F.col("n_words"), F.lit(20))).otherwise(0)).cast("double").alias(f"v{k}") for k in L]
    doc = seg.groupBy(id_col, "_d", "_s", "_h", "_y").agg(*votes)
    top = F.greatest(*[F.col(f"v{k}") for k in L])
    main = F.coalesce(*[F.when((F.col(f"v{k}") == top) & (top > 0), k) for k in L])
    doc = doc.withColumn("_m", main)
    ones = [F.sum(F.when(F.col("_m") == k, 1.0).otherwise(0.0)).alias(f"c{k}") for k in L]

    def counts(*by: str) -> DataFrame:
        return doc.groupBy(*by).agg(*ones)

    def share(base: list[Column], n: list[Column]) -> list[Column]:
        total = sum(n[1:], n[0])
        return [(n[k] + F.lit(strength) * base[k]) / (total + F.lit(strength)) for k in L]

    flat = [F.lit(1.0 / len(LANGUAGES)) for _ in L]
    whole = doc.agg(*[x.alias(f"g{k}") for k, x in enumerate(ones)])
    g = share(flat, [F.coalesce(f"g{k}", F.lit(0.0)) for k in L])
    whole = whole.select(*[g[k].alias(f"g{k}") for k in L])  # one row
    # from all records to the host, from the host to its year; the wider level is the prior of the narrower
    hy = counts("_h", "_y")
    by_host = Window.partitionBy("_h")
    hy = hy.select("_h", "_y", *[f"c{k}" for k in L], *[F.sum(f"c{k}").over(by_host).alias(f"h{k}") for k in L]).crossJoin(F.broadcast(whole))
    host = share([F.col(f"g{k}") for k in L], [F.col(f"h{k}") for k in L])
    year = share(host, [F.col(f"c{k}") for k in L])
    hy = hy.select("_h", "_y", F.array(*year).alias("p_host"))
    said = counts("_d").crossJoin(F.broadcast(whole))
    said = said.select("_d", F.array(*share([F.col(f"g{k}") for k in L], [F.col(f"c{k}") for k in L])).alias("p_said"), F.array(*[F.col(f"g{k}") for k in L]).alias("p_all"))
    suff = counts("_s").crossJoin(F.broadcast(whole))
    suff = suff.select("_s", F.array(*share([F.col(f"g{k}") for k in L], [F.col(f"c{k}") for k in L])).alias("p_suff"))
    # at most six declared values and five suffixes; hosts are joined
    ev = doc.join(F.broadcast(said), "_d").join(F.broadcast(suff), "_s").join(hy, ["_h", "_y"])
    total = sum((F.col(f"v{k}") for k in L), F.lit(0.0))
    prior = []
    for k in L:
        p = lambda c, k=k: F.col(c).getItem(k)
        meta = p("p_host") * (p("p_said") / p("p_all")) * (p("p_suff") / p("p_all"))
        prior.append(F.log(meta + 1e-6) + F.lit(doc_weight * 10) * (F.col(f"v{k}") / (total + 1.0)))
    ev = ev.select(F.col(id_col).alias("_id"), F.array(*prior).alias("prior"))
    joined = seg.join(ev, seg[id_col].eqNullSafe(ev["_id"])).drop("_id")
    score = F.zip_with("ll", "prior", lambda a, b: a + b)
    post = joined.withColumn("score", score).withColumn("top", F.array_max("score"))
    z = F.aggregate(F.transform("score", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    lang = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), F.array_position("score", F.col("top")).cast("int"))
    return post.select(id_col, F.when(F.col("_d") != "", F.col("_d")).alias("declared"), "para_no", "seg_no", "start_pos", "end_pos", "n_words", lang.alias("language"), (1 / z).alias("confidence"))


def paragraph_languages(segs: DataFrame, id_col: str = "pdoc_id", sure: float = 0.9, least_words: int = 2) -> DataFrame:
    """(id_col, declared, para_no, language, n_words): each paragraph with the languages of its whole sentences.

    A language other than that of most of the paragraph's words needs a segment of least_words words and the
    confidence `sure`; the paragraph's main language needs neither.
    """
    by = segs.groupBy(id_col, "declared", "para_no", "language").agg(F.sum("n_words").alias("n_words"), F.max(((F.col("confidence") >= sure) & (F.col("n_words") >= least_words)).cast("int")).alias("ok"))
    w = Window.partitionBy(id_col, "para_no").orderBy(F.desc("n_words"), "language")
    return by.withColumn("r", F.row_number().over(w)).where("r = 1 OR ok = 1").select(id_col, "declared", "para_no", "language", "n_words")


def unlabelled_paragraphs(paras: DataFrame, id_col: str = "pdoc_id") -> DataFrame:
    """(id_col, para_no, language) of the documents whose label is missing, wrong, or not the only language."""
    doc = paras.groupBy(id_col).agg(F.first("declared").alias("d"), F.collect_set("language").alias("ls"))  # at most four
    bad = doc.where(F.col("d").isNull() | ~F.array_contains("ls", F.col("d")) | (F.size("ls") > 1)).select(id_col)
    return paras.join(bad, id_col, "left_semi").select(id_col, "para_no", "language")


def document_languages(segs: DataFrame, id_col: str = "pdoc_id") -> DataFrame:
    """(id_col, declared, language, confidence, mixed): the language of most of a document's words.

    confidence is the mean posterior of its segments in that language, weighted by words, times their share of words.
    """
    by = segs.groupBy(id_col, "declared", "language").agg(F.sum("n_words").alias("n"), F.sum(F.col("n_words") * F.col("confidence")).alias("c"))
    w = Window.partitionBy(id_col)
    top = by.withColumns({"all_n": F.sum("n").over(w), "k": F.count("*").over(w), "r": F.row_number().over(w.orderBy(F.desc("n"), "language"))}).where("r = 1")
    return top.select(id_col, "declared", "language", (F.col("c") / F.col("all_n")).alias("confidence"), (F.col("k") > 1).alias("mixed"))


