"""Domain of a text by weighted terms: shares of four domains, the largest if it reaches the threshold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions import lexicon as lx
from folium.functions.text import normal_form, round4, strip

DOMAINS = tuple(lx.DOMAIN_TERMS)


def _among(words: list[str]) -> Callable[[Column], Column]:
    return lambda t: t.isin(*words)


def _sum(tokens: Column, pairs: Column, domain: str) -> Column:
    parts = []
    for n, c in ((1, tokens), (2, pairs)):
        for w, ts in lx.terms(domain, n).items():
            if ts:
                parts.append(F.lit(float(w)) * F.size(F.filter(c, _among(ts))))
    return sum(parts[1:], parts[0])


def score_domain(df: DataFrame, text: str, threshold: float = lx.DOMAIN_THRESHOLD) -> DataFrame:
    """df with domain, confidence, score_<domain> and method of the text column. Null counts as too short."""
    raw = F.coalesce(F.col(text), F.lit(""))
    d = df.withColumn("_norm", normal_form(raw)).withColumn("_short", F.length(strip(raw)) < lx.DOMAIN_LEAST_CHARS)
    d = d.withColumn("_tok", F.when(F.col("_norm") != "", F.split("_norm", " ")).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("_two", F.when(F.size("_tok") > 1, F.zip_with(F.slice("_tok", 1, F.size("_tok") - 1), F.slice("_tok", 2, F.size("_tok") - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>")))
    d = d.withColumns({f"_{k}": _sum(F.col("_tok"), F.col("_two"), k) for k in DOMAINS})
    total = sum((F.col(f"_{k}") for k in DOMAINS[1:]), F.col(f"_{DOMAINS[0]}"))
    zero = F.col("_short") | (total < 1e-9)
    d = d.withColumns({f"score_{k}": F.when(zero, 0.0).otherwise(round4(F.col(f"_{k}") / total)) for k in DOMAINS})
    best = F.greatest(*[F.col(f"score_{k}") for k in DOMAINS])
    named = F.coalesce(*[F.when(F.col(f"score_{k}") == best, k) for k in DOMAINS])
    out = d.withColumns({"confidence": best, "domain": F.when(zero | (best < threshold), "other").otherwise(named), "method": F.when(F.col("_short"), "too_short").otherwise("internal")})
    return out.drop("_norm", "_short", "_tok", "_two", *[f"_{k}" for k in DOMAINS])


def paragraph_domains(docs: DataFrame, id_col: str = "pdoc_id", paragraphs: str = "paragraphs", threshold: float = lx.DOMAIN_THRESHOLD) -> DataFrame:
    """(id_col, index, domain, confidence, score_*): each paragraph; null arrays have no row."""
    rows = docs.select(id_col, F.posexplode(paragraphs).alias("index", "_p"))
    return score_domain(rows, "_p", threshold).drop("_p", "method")


def document_domains(docs: DataFrame, id_col: str = "pdoc_id", paragraphs: str = "paragraphs", threshold: float = lx.DOMAIN_THRESHOLD) -> DataFrame:
    """(id_col, domain, confidence, score_*, method) of the paragraphs taken together, null ones left out."""
    rows = docs.select(id_col, F.array_join(F.coalesce(F.col(paragraphs), F.array().cast("array<string>")), " ").alias("_p"))
    return score_domain(rows, "_p", threshold).drop("_p")


def domain_distribution(paras: DataFrame, id_col: str = "pdoc_id") -> DataFrame:
    """(id_col, domain, share): the share of a document's paragraphs in each domain that occurs."""
    n = paras.groupBy(id_col, "domain").agg(F.count("*").alias("n"))
    whole = paras.groupBy(id_col).agg(F.count("*").alias("all_n"))
    return n.join(whole, id_col).select(id_col, "domain", round4(F.col("n") / F.col("all_n")).alias("share"))
