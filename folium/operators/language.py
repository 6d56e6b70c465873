"""Language of a paragraph as Basque or Spanish from function words, letter groups and endings; of a document by vote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions import lexicon as lx
from folium.functions.text import WORD, WS, normal_form, round4, strip

_TOKEN = f"[{WORD}]"


def _among(words: list[str]) -> Callable[[Column], Column]:
    return lambda t: t.isin(*words)


def _share(found: Column, of: Column) -> Column:
    return F.when(of > 0, found / of).otherwise(F.lit(0.0))


def _ending(ends: list[str]) -> str:
    return f"(?<!{_TOKEN}){_TOKEN}+(?:{'|'.join(ends)})(?!{_TOKEN})"


def _whole(words: list[str]) -> str:
    return f"(?<!{_TOKEN})(?:{'|'.join(words)})(?!{_TOKEN})"


EU_PATTERNS = [_ending(lx.EU_GENITIVES), _ending(lx.EU_VERBAL), _whole(lx.EU_PARTICLES), _ending(lx.EU_LOCATIVES), "|".join(lx.EU_CLUSTERS), f"(?<!{_TOKEN}){_TOKEN}*(?:{'|'.join(lx.EU_ADMIN)}){_TOKEN}*"]
ES_PATTERNS = [_ending(lx.ES_ENDINGS), _whole(lx.ES_ACCENTED), _ending(lx.ES_GERUNDS), "[¿¡]", _whole(lx.ES_LEGAL)]


def score_language(df: DataFrame, text: str, least_chars: int = lx.LEAST_CHARS) -> DataFrame:
    """df with language (eu, es, unknown), confidence, conf_eu, conf_es and method of the text column.

    Null counts as empty. Shorter texts than least_chars are unknown, with method too_short. No shuffle, no Python.
    """
    raw = strip(F.coalesce(F.col(text), F.lit("")))
    d = df.withColumn("_raw", raw).withColumn("_norm", normal_form(F.col("_raw"))).withColumn("_low", F.lower("_raw"))
    d = d.withColumn("_tok", F.when(F.col("_norm") != "", F.split("_norm", " ")).otherwise(F.array().cast("array<string>")))
    n3 = F.length("_norm") - 2
    tri = F.when(n3 > 0, F.transform(F.sequence(F.lit(1), F.greatest(n3, F.lit(1))), lambda i: F.substring(F.col("_norm"), i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    d = d.withColumn("_tri", tri).withColumn("_words", F.size(F.filter(F.split("_raw", f"[{WS}]+"), lambda x: x != "")))
    score = {}
    for k, stop, grams, pats in (("eu", lx.EU_STOPWORDS, lx.EU_TRIGRAMS, EU_PATTERNS), ("es", lx.ES_STOPWORDS, lx.ES_TRIGRAMS, ES_PATTERNS)):
        sw = _share(F.size(F.filter("_tok", _among(stop))), F.size("_tok"))
        tg = _share(F.size(F.filter("_tri", _among(grams))), F.size("_tri"))
        hits = sum((F.regexp_count("_low", F.lit(p)) for p in pats[1:]), F.regexp_count("_low", F.lit(pats[0])))
        score[k] = lx.W_STOPWORD * sw + lx.W_TRIGRAM * tg + lx.W_PATTERN * F.least(_share(hits, F.col("_words")), F.lit(1.0))
    d = d.withColumns({"_eu": score["eu"], "_es": score["es"]}).withColumn("_all", F.col("_eu") + F.col("_es"))
    short, none = F.length("_raw") < least_chars, F.col("_all") < 1e-9
    eu, es = F.try_divide("_eu", "_all"), F.try_divide("_es", "_all")
    best = F.greatest(eu, es)
    zero = short | none
    return d.withColumns({
        "language": F.when(zero | (best < lx.LEAST_CONFIDENCE), "unknown").when(eu > es, "eu").otherwise("es"),
        "confidence": F.when(zero, 0.0).otherwise(round4(best)),
        "conf_eu": F.when(zero, 0.0).otherwise(round4(eu)),
        "conf_es": F.when(zero, 0.0).otherwise(round4(es)),
        "method": F.when(short, "too_short").otherwise("internal"),
    }).drop("_raw", "_norm", "_low", "_tok", "_tri", "_words", "_eu", "_es", "_all")


def paragraph_languages(docs: DataFrame, id_col: str = "pdoc_id", paragraphs: str = "paragraphs") -> DataFrame:
    """(id_col, index, language, confidence, method): each paragraph; a null one is unknown. Null arrays have no row."""
    rows = docs.select(id_col, F.posexplode(paragraphs).alias("index", "_p"))
    return score_language(rows, "_p").select(id_col, "index", "language", "confidence", "method")


def document_languages(paras: DataFrame, id_col: str = "pdoc_id") -> DataFrame:
    """(id_col, dominant_language, eu_ratio, n_eu, n_es, n_unknown): the language of most paragraphs, the first seen of equals."""
    n = {k: F.sum((F.col("language") == k).cast("long")) for k in ("eu", "es", "unknown")}
    first = {k: F.coalesce(F.min(F.when(F.col("language") == k, F.col("index"))), F.lit(2**31 - 1)) for k in n}
    d = paras.groupBy(id_col).agg(*[n[k].alias(f"n_{k}") for k in n], *[first[k].alias(f"_{k}") for k in n], F.count("*").alias("_n"))
    best = F.greatest(*[F.struct(F.col(f"n_{k}").alias("n"), (-F.col(f"_{k}")).alias("f"), F.lit(k).alias("l")) for k in n])
    return d.select(id_col, best.getField("l").alias("dominant_language"), round4(F.col("n_eu") / F.col("_n")).alias("eu_ratio"), "n_eu", "n_es", "n_unknown")
