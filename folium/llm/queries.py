"""Queries of this package by name: p1, p3 and p5 to p10. Each runs over its whole tables."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.llm import alignment, languages, lookalikes, packing, scans, sentences, subjects, tokens
from folium.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def _pairs(spark: SparkSession, d: str) -> tuple[DataFrame, alignment.Statistics]:
    pairs = cut(alignment.page_pairs(table(spark, d, "bulletin_index"), table(spark, d, "bulletin_sentences")))
    return pairs, alignment.train(pairs)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of a bulletin's two pages that translate each other."""
    return alignment.found_pairs(alignment.align(*_pairs(spark, d)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Noise of scanned pages: headers, page numbers, divided and misread words."""
    return scans.find_noise(table(spark, d, "ocr_blocks")).found()


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Each block as a continuous, repaired text."""
    return scans.paragraphs(scans.find_noise(table(spark, d, "ocr_blocks")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of strings of a file that look alike and aren't the same."""
    return lookalikes.lookalike_pairs(table(spark, d, "json_strings"))


def p5_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every string."""
    return lookalikes.canonical_strings(table(spark, d, "json_strings"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """What the mapping does to each file, beside what a report of another cleaner says (the largest, if delivered twice)."""
    mine = lookalikes.mapped_report(table(spark, d, "json_strings"))
    other = table(spark, d, "clean_report").groupBy("file_in").agg(F.max("chars_mapped").alias("reported_mapped"))
    return mine.join(other, "file_in", "left")


def _areas(spark: SparkSession, d: str) -> list[str]:
    return sorted(r[0] for r in table(spark, d, "subject_areas").select("domain").where("domain IS NOT NULL").distinct().collect())


def _document_areas(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "para_docs")
    model = subjects.train(docs, _areas(spark, d))
    return subjects.document_areas(subjects.paragraph_areas(docs, model))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The areas of each document."""
    return _document_areas(spark, d).select("pdoc_id", "domain")


def p6_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents, paragraphs and share of the corpus by area."""
    return subjects.composition(_document_areas(spark, d), table(spark, d, "para_docs"), table(spark, d, "subject_areas"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and their languages, of documents whose label is missing, wrong or not the only language."""
    segs = languages.classify(table(spark, d, "para_docs"))
    return languages.unlabelled_paragraphs(languages.paragraph_languages(segs))


def p7_documents(spark: SparkSession, d: str) -> DataFrame:
    """The main language of each document, with confidence."""
    got = languages.document_languages(languages.classify(table(spark, d, "para_docs")))
    return got.withColumn("confidence", F.round("confidence", 4))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_documents(table(spark, d, "documents"))


def p9_packing(spark: SparkSession, d: str) -> DataFrame:
    """Which container each text lies in, for each kind of container."""
    return packing.pack(cut(tokens.count_tokens(table(spark, d, "documents"))), table(spark, d, "containers"))


def p9_limited(spark: SparkSession, d: str) -> DataFrame:
    """The same where texts and attention cost are limited too: a text for each 128 tokens of room, half the cost of one text that fills it."""
    boxes = table(spark, d, "containers")
    room = {r[0]: int(r[1]) for r in boxes.select("container_kind", "capacity_tokens").where("capacity_tokens >= 1").collect()}  # a few rows
    return packing.pack(cut(tokens.count_tokens(table(spark, d, "documents"))), boxes, items_limit={k: max(1, c // 128) for k, c in room.items()}, cost_limit={k: max(1, c * c // 2) for k, c in room.items()})


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are, beside the least number that could hold all."""
    return packing.bin_report(p9_packing(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of every document."""
    return sentences.split_documents(table(spark, d, "documents")).select("doc_id", "start_pos", "end_pos")


def queries() -> dict[str, Query]:
    every = (p1_found, p3_found, p3_paragraphs, p5_found, p5_canonical, p5_report, p6_found, p6_composition, p7_found, p7_documents, p8_ids, p9_packing, p9_limited, p9_fill, p10_found)
    return {f.__name__: f for f in every}


def _canonical_sql(x: str) -> str:
    """The canonical form in SQL: its characters' forms, taken one by one from the same table, composed again."""
    one, to, gone, several = [], [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0xE000 <= cp <= 0xF8FF or 0xF0000 <= cp:
            continue
        c = chr(cp)
        k = unicodedata.normalize("NFC", lookalikes.skeleton(c))
        if k != unicodedata.normalize("NFC", c):
            if len(k) == 1:
                one.append(c)
                to.append(k)
            else:
                (several if k else gone).append((c, k))
    q = lambda s: "'" + s.replace("'", "''") + "'"
    x = f"nfc_normalize({x})"
    for c, k in several:
        x = f"replace({x}, {q(c)}, {q(k)})"
    return f"nfc_normalize(translate({x}, {q(''.join([chr(9), chr(11), chr(12), *one, *(c for c, _ in gone)]))}, {q('   ' + ''.join(to))}))"


def oracle_sql() -> dict[str, str]:
    """SQL for look-alikes; the others depend on trained models, a vocabulary or rules that SQL lacks, and tests/llm checks them."""
    s = f"WITH s AS (SELECT string_id, file_in, content, {_canonical_sql('content')} AS canonical FROM json_strings) "
    known = "".join(chr(c) for c in lookalikes.prototypes())
    return {
        "p5_report": s + f"""SELECT file_in, n AS strings_total, changed AS strings_changed, mapped AS chars_mapped, r AS reported_mapped FROM (
            SELECT file_in, count(*) AS n, count(*) FILTER (canonical <> content) AS changed, CAST(sum(CASE WHEN regexp_full_match(content, '[\\x00-\\x7F]*') THEN 0 ELSE length(content) - length(translate(content, '{known}', '')) END) AS BIGINT) AS mapped
            FROM s WHERE content IS NOT NULL GROUP BY file_in) LEFT JOIN (SELECT file_in, max(chars_mapped) AS r FROM clean_report GROUP BY file_in) USING (file_in)""",
        "p5_canonical": s + "SELECT string_id, canonical, coalesce(canonical <> content, false) AS changed FROM s",
        "p5_found": s + "SELECT DISTINCT a.string_id AS string_id_a, b.string_id AS string_id_b FROM s a JOIN s b ON a.file_in = b.file_in AND a.canonical = b.canonical AND a.content <> b.content AND a.string_id < b.string_id WHERE trim(a.canonical) <> ''",
    }
