"""Queries of the text operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions import lexicon as lx
from folium.functions import text as tx
from folium.operators import domain, language
from folium.session import table

Query = Callable[[SparkSession, str], DataFrame]


def text_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every string cleaned, with what was removed and mapped."""
    s = table(spark, d, "json_strings").where("content IS NOT NULL")
    return s.select("string_id", tx.clean(F.col("content")).alias("c")).select("string_id", "c.*")


def text_clean_report(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning of each file in figures."""
    c = table(spark, d, "json_strings").where("content IS NOT NULL").select("file_in", tx.clean(F.col("content")).alias("c"))
    return c.groupBy("file_in").agg(F.count("*").alias("strings_total"), F.sum(F.col("c.changed").cast("long")).alias("strings_changed"), F.sum("c.removed").cast("long").alias("chars_removed"), F.sum("c.mapped").cast("long").alias("chars_mapped"))


def text_layout_clean(spark: SparkSession, d: str) -> DataFrame:
    """Block texts with divided words joined and empty lines gone."""
    return table(spark, d, "ocr_blocks").select("block_id", tx.layout_clean(F.col("content")).alias("content")).distinct()


def text_scraper_clean(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of pages without control and format characters."""
    return table(spark, d, "bulletin_sentences").select("sent_id", tx.scraper_clean(F.col("content")).alias("content")).distinct()


def text_names(spark: SparkSession, d: str) -> DataFrame:
    """Paths as ids, titles as slugs and file names."""
    b = table(spark, d, "json_strings").select("json_path", "file_in").distinct()
    return b.select("json_path", "file_in", tx.safe_path(F.col("json_path")).alias("safe"), tx.slug(F.col("file_in")).alias("slug"), tx.file_name(F.col("file_in")).alias("file_name"))


def _paras(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "para_docs").dropDuplicates(["pdoc_id"])


def lang_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Basque, Spanish or unknown, for each paragraph."""
    return language.paragraph_languages(_paras(spark, d))


def lang_documents(spark: SparkSession, d: str) -> DataFrame:
    """The language of most paragraphs of each document."""
    return language.document_languages(lang_paragraphs(spark, d))


def domain_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The domain of each paragraph by weighted terms."""
    return domain.paragraph_domains(_paras(spark, d))


def domain_documents(spark: SparkSession, d: str) -> DataFrame:
    """The domain of each document by weighted terms."""
    return domain.document_domains(_paras(spark, d))


def domain_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of each domain among a document's paragraphs."""
    return domain.domain_distribution(domain_paragraphs(spark, d))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{tx.WS}]+|[{tx.WS}]+$', '', 'g')"


def sql_layout_clean(x: str) -> str:
    lines = f"regexp_split_to_array(replace(replace(coalesce({x}, ''), '-' || chr(10), ''), chr(13), ''), '{tx.BREAKS}')"
    return f"array_to_string(list_filter(list_transform({lines}, lambda s: {sql_strip('s')}), lambda s: s <> ''), chr(10))"


_KEYS = lx.TO_BLANK + "".join(lx.QUOTES) + lx.TO_NOTHING
_TO = " " * len(lx.TO_BLANK) + "".join(lx.QUOTES.values())
_CLEAN = rf"""
WITH a AS (SELECT string_id, file_in, content, nfc_normalize(content) AS n FROM json_strings WHERE content IS NOT NULL),
b AS (SELECT *, replace(translate(n, {_q(_KEYS)}, {_q(_TO)}), '…', '...') AS m, length(n) - length(translate(n, {_q(_KEYS + lx.ELLIPSIS)}, '')) AS mapped FROM a),
c AS (SELECT *, regexp_replace(m, '[\x{{0}}-\x{{8}}\x{{b}}-\x{{1f}}\x{{7f}}-\x{{9f}}\p{{Co}}]', '', 'g') AS k FROM b),
d AS (SELECT string_id, file_in, content, regexp_replace(regexp_replace(k, '[ \t\x{{a0}}\x{{2000}}-\x{{200b}}\x{{202f}}\x{{2060}}\x{{feff}}]+', ' ', 'g'), ' {{2,}}', ' ', 'g') AS cleaned, CAST(length(m) - length(k) AS INTEGER) AS removed, CAST(mapped AS INTEGER) AS mapped FROM c)
"""

_FA, _FB = tx.fold_map()


def sql_normal(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(translate(lower({x}), {_q(_FA)}, {_q(_FB)}), '\\p{{Mn}}', '', 'g'), '[^{tx.WORD}]+', ' ', 'g'))"


_PARAS = f"""
WITH p AS (SELECT pdoc_id, any_value(paragraphs) AS ps FROM para_docs GROUP BY pdoc_id),
x AS (SELECT pdoc_id, i AS "index", coalesce(ps[i + 1], '') AS txt FROM (SELECT *, unnest(range(len(ps))) AS i FROM p)),
r AS (SELECT *, {sql_strip('txt')} AS raw FROM x),
"""
_TOKENS = "CASE WHEN norm = '' THEN []::VARCHAR[] ELSE string_split(norm, ' ') END"


def _share(hits: str, of: str) -> str:
    return f"CASE WHEN {of} > 0 THEN CAST({hits} AS DOUBLE) / {of} ELSE 0e0 END"


def _score(stop: list[str], grams: list[str], hits: str) -> str:
    return f"4.5e-1 * ({_share(f'len(list_filter(tok, lambda t: list_contains({_list(stop)}, t)))', 'len(tok)')}) + 3e-1 * ({_share(f'len(list_filter(tri, lambda t: list_contains({_list(grams)}, t)))', 'len(tri)')}) + 2.5e-1 * least({_share(hits, 'words')}, 1e0)"


def _ends(ends: list[str]) -> str:
    return f"len(list_filter(w, lambda t: regexp_matches(t, '^.+(?:{'|'.join(ends)})$')))"


def _whole(words: list[str]) -> str:
    return f"len(list_filter(w, lambda t: list_contains({_list(words)}, t)))"


_EU_HITS = "(" + " + ".join([_ends(lx.EU_GENITIVES), _ends(lx.EU_VERBAL), _whole(lx.EU_PARTICLES), _ends(lx.EU_LOCATIVES), f"len(regexp_extract_all(low, '{'|'.join(lx.EU_CLUSTERS)}'))", f"len(list_filter(w, lambda t: regexp_matches(t, '{'|'.join(lx.EU_ADMIN)}')))"]) + ")"
_ES_HITS = "(" + " + ".join([_ends(lx.ES_ENDINGS), _whole(lx.ES_ACCENTED), _ends(lx.ES_GERUNDS), "len(regexp_extract_all(low, '[¿¡]'))", _whole(lx.ES_LEGAL)]) + ")"
_LANG = _PARAS + f"""
n AS (SELECT *, {sql_normal('raw')} AS norm, lower(raw) AS low FROM r),
t AS (SELECT *, {_TOKENS} AS tok, list_transform(range(1, greatest(length(norm) - 2, 0) + 1), lambda k: substring(norm, k, 3)) AS tri, regexp_extract_all(low, '[{tx.WORD}]+') AS w, len(list_filter(regexp_split_to_array(raw, '[{tx.WS}]+'), lambda s: s <> '')) AS words FROM n),
s AS (SELECT pdoc_id, "index", raw, {_score(lx.EU_STOPWORDS, lx.EU_TRIGRAMS, _EU_HITS)} AS eu, {_score(lx.ES_STOPWORDS, lx.ES_TRIGRAMS, _ES_HITS)} AS es FROM t),
c AS (SELECT *, length(raw) < {lx.LEAST_CHARS} AS short, length(raw) < {lx.LEAST_CHARS} OR eu + es < 1e-9 AS zero, eu / (eu + es) AS ce, es / (eu + es) AS cs FROM s),
l AS (SELECT pdoc_id, CAST("index" AS INTEGER) AS "index", CASE WHEN zero OR greatest(ce, cs) < 0.52 THEN 'unknown' WHEN ce > cs THEN 'eu' ELSE 'es' END AS language, CASE WHEN zero THEN 0e0 ELSE floor(greatest(ce, cs) * 1e4 + 5e-1) / 1e4 END AS confidence, CASE WHEN short THEN 'too_short' ELSE 'internal' END AS method FROM c)
"""  # fmt: skip


def _domain_sum(name: str) -> str:
    parts = []
    for n, col in ((1, "tok"), (2, "two")):
        for w, ts in lx.terms(name, n).items():
            if ts:
                parts.append(f"{w} * len(list_filter({col}, lambda t: list_contains({_list(ts)}, t)))")
    return "CAST(" + " + ".join(parts) + " AS DOUBLE)"


_DOMAIN_TAIL = f"""
n AS (SELECT *, {sql_normal('txt')} AS norm, length(raw) < {lx.DOMAIN_LEAST_CHARS} AS short FROM r),
t AS (SELECT *, {_TOKENS} AS tok FROM n),
u AS (SELECT *, list_transform(range(1, greatest(len(tok) - 1, 0) + 1), lambda k: tok[k] || ' ' || tok[k + 1]) AS two FROM t),
s AS (SELECT *, {', '.join(f'{_domain_sum(k)} AS _{k}' for k in domain.DOMAINS)} FROM u),
z AS (SELECT *, short OR {' + '.join(f'_{k}' for k in domain.DOMAINS)} < 1e-9 AS zero FROM s),
c AS (SELECT *, {', '.join(f"CASE WHEN zero THEN 0e0 ELSE floor(_{k} / ({' + '.join(f'_{j}' for j in domain.DOMAINS)}) * 1e4 + 5e-1) / 1e4 END AS score_{k}" for k in domain.DOMAINS)} FROM z),
g AS (SELECT *, greatest({', '.join(f'score_{k}' for k in domain.DOMAINS)}) AS confidence FROM c),
f AS (SELECT *, CASE WHEN zero OR confidence < {lx.DOMAIN_THRESHOLD} THEN 'other' {' '.join(f"WHEN score_{k} = confidence THEN '{k}'" for k in domain.DOMAINS)} END AS domain FROM g)
"""
_SCORES = ", ".join(f"score_{k}" for k in domain.DOMAINS)
_DOMAIN_PARAS = _PARAS + _DOMAIN_TAIL
_DOMAIN_DOCS = f"""
WITH p AS (SELECT pdoc_id, any_value(paragraphs) AS ps FROM para_docs GROUP BY pdoc_id),
x AS (SELECT pdoc_id, coalesce(array_to_string(list_filter(ps, lambda s: s IS NOT NULL), ' '), '') AS txt FROM p),
r AS (SELECT *, {sql_strip('txt')} AS raw FROM x),
""" + _DOMAIN_TAIL

SQL = {
    "text_clean": _CLEAN + "SELECT string_id, cleaned, removed, mapped, cleaned <> content AS changed FROM d",
    "text_clean_report": _CLEAN + "SELECT file_in, count(*) AS strings_total, CAST(count(*) FILTER (cleaned <> content) AS BIGINT) AS strings_changed, CAST(sum(removed) AS BIGINT) AS chars_removed, CAST(sum(mapped) AS BIGINT) AS chars_mapped FROM d GROUP BY file_in",
    "text_layout_clean": f"SELECT DISTINCT block_id, {sql_layout_clean('content')} AS content FROM ocr_blocks",
    "text_scraper_clean": f"SELECT DISTINCT sent_id, {sql_strip(r'''regexp_replace(regexp_replace(regexp_replace(nfc_normalize(content), '[\x{0}-\x{8}\x{b}-\x{1f}\x{7f}-\x{9f}\p{Cf}\p{Co}]', '', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')''')} AS content FROM bulletin_sentences",
    "text_names": r"""SELECT DISTINCT json_path, file_in, regexp_replace(replace(translate(json_path, '.[ -/', '_____'), ']', ''), '^_+|_+$', '', 'g') AS safe,
        left(regexp_replace(regexp_replace(coalesce(file_in, ''), '[^a-zA-Z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 64) AS slug, regexp_replace(file_in, '[^\p{L}\p{N}\-_.]', '-', 'g') AS file_name FROM json_strings""",
    "lang_paragraphs": _LANG + "SELECT * FROM l",
    "lang_documents": _LANG + """, q AS (SELECT pdoc_id, language, count(*) AS n, min("index") AS f FROM l GROUP BY ALL),
        k AS (SELECT *, row_number() OVER (PARTITION BY pdoc_id ORDER BY n DESC, f) AS r FROM q)
        SELECT pdoc_id, max(language) FILTER (r = 1) AS dominant_language, floor(CAST(coalesce(sum(n) FILTER (language = 'eu'), 0) AS DOUBLE) / sum(n) * 1e4 + 5e-1) / 1e4 AS eu_ratio,
        CAST(coalesce(sum(n) FILTER (language = 'eu'), 0) AS BIGINT) AS n_eu, CAST(coalesce(sum(n) FILTER (language = 'es'), 0) AS BIGINT) AS n_es, CAST(coalesce(sum(n) FILTER (language = 'unknown'), 0) AS BIGINT) AS n_unknown FROM k GROUP BY pdoc_id""",
    "domain_paragraphs": _DOMAIN_PARAS + f'SELECT pdoc_id, CAST("index" AS INTEGER) AS "index", domain, confidence, {_SCORES} FROM f',
    "domain_documents": _DOMAIN_DOCS + f"SELECT pdoc_id, domain, confidence, {_SCORES}, CASE WHEN short THEN 'too_short' ELSE 'internal' END AS method FROM f",
    "domain_shares": _DOMAIN_PARAS + ", n2 AS (SELECT pdoc_id, domain, count(*) AS n FROM f GROUP BY ALL) SELECT pdoc_id, domain, floor(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY pdoc_id) * 1e4 + 5e-1) / 1e4 AS share FROM n2",
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (text_clean, text_clean_report, text_layout_clean, text_scraper_clean, text_names, lang_paragraphs, lang_documents, domain_paragraphs, domain_documents, domain_shares)}
