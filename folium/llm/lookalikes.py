"""Problem 5: one form for strings that look alike though their characters differ.

Method: confusables skeleton. A string is decomposed, every character replaced by its prototype, and the result
decomposed again; originals with equal skeletons look alike. The prototype table is built by rule from the character
database (full-width and half-width forms, no-break and ligature forms, blanks, characters that don't show), and only
look-alike letters of other scripts are listed. Case, accents, raised digits, fractions and other punctuation stay.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.session import cut

# Cyrillic, Greek and other letters that look like a Latin one, and the micro sign.
LETTERS = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ѕ": "s", "у": "y", "ү": "y", "х": "x", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "ο": "o", "ν": "v", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "ϲ": "c", "ϳ": "j",
    "ɑ": "a", "ɡ": "g", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "µ": "μ",
}
#: Hyphens that look like the hyphen-minus.
HYPHENS = "‐‑﹣"
#: Blank letters and other characters without a glyph that aren't of category Cf.
UNSEEN = "͏ᅟᅠ឴឵ㅤﾠ᠋᠌᠍᠏"


@functools.lru_cache(maxsize=1)
def prototypes() -> dict[int, str]:
    """Code point to what stands for it; the empty string for what doesn't show."""
    table: dict[int, str] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        cat = unicodedata.category(c)
        if cat == "Cf" or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or c in UNSEEN:
            table[cp] = ""
        elif cat in ("Zs", "Zl", "Zp"):
            table[cp] = " "
        elif c in HYPHENS:
            table[cp] = "-"
        elif c in LETTERS:
            table[cp] = LETTERS[c]
        else:
            d = unicodedata.decomposition(c)
            if d.startswith(("<wide>", "<narrow>", "<noBreak>")) or 0xFB00 <= cp <= 0xFB06:
                p = unicodedata.normalize("NFKC", c)
                table[cp] = "".join(LETTERS.get(x, x) for x in p)
    for cp in (0x09, 0x0B, 0x0C, 0x85):
        table[cp] = " "
    return table


def skeleton(s: str | None) -> str | None:
    """The form that all strings looking like s share; null stays null."""
    if s is None:
        return None
    if s.isascii():
        return s.translate(prototypes()) if "\t" in s or "\x0b" in s or "\x0c" in s else s
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", s).translate(prototypes()))


@F.pandas_udf(T.StringType())
def skeleton_udf(s: pd.Series) -> pd.Series:
    return s.map(skeleton, na_action="ignore")


@F.pandas_udf(T.StringType())
def canonical_udf(s: pd.Series) -> pd.Series:
    """The skeleton, composed again: the form in which text is kept."""
    return s.map(lambda x: unicodedata.normalize("NFC", skeleton(x)), na_action="ignore")


def canonical_strings(strings: DataFrame, id_col: str = "string_id", text_col: str = "content") -> DataFrame:
    """(id_col, canonical, changed boolean): one row for each row of strings.

    Null content gives null and changed false; empty and blank content keep their blanks as ordinary ones.
    """
    c = F.col(text_col)
    plain = c.rlike(r"\A[\x20-\x7e\n\r]*\z")  # nothing to do, so it needn't leave the JVM's side of the comparison
    out = strings.select(F.col(id_col), c, canonical_udf(c).alias("canonical"), plain.alias("_plain"))
    return out.select(id_col, "canonical", F.coalesce(~F.col("_plain") & ~F.col("canonical").eqNullSafe(F.col(text_col)), F.lit(False)).alias("changed"))


def lookalike_pairs(strings: DataFrame, id_col: str = "string_id", group_col: str = "file_in", text_col: str = "content") -> DataFrame:
    """(id_a, id_b): rows of one group whose texts look alike but aren't the same characters, id_a < id_b.

    Null and blank texts, null ids and rows without a group have no pair; repeated rows (one id) pair once. Only groups
    of equal skeleton that hold different texts reach the join, and the join works on distinct texts with the ids
    gathered only at the end, so many copies of one text never meet each other.
    """
    rows = strings.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_g"), F.col(text_col).alias("_t"), skeleton_udf(F.col(text_col)).alias("_s"))
    rows = rows.where("_id IS NOT NULL AND _g IS NOT NULL AND trim(_s) <> ''")
    rows = rows.select("_id", F.xxhash64("_g", "_s").alias("_k"), "_g", "_s", "_t")
    mixed = rows.groupBy("_k", "_g", "_s").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi")).where("_lo <> _hi").select("_k", "_g", "_s")
    some = cut(rows.join(mixed, ["_k", "_g", "_s"], "left_semi"))
    classes = some.select("_k", "_g", "_s", "_t").distinct()
    a, b = classes.withColumnRenamed("_t", "_ta"), classes.withColumnRenamed("_t", "_tb")
    texts = a.join(b, ["_k", "_g", "_s"]).where("_ta <> _tb")
    left = some.select("_k", "_g", "_s", F.col("_t").alias("_ta"), F.col("_id").alias("_a"))
    right = some.select("_k", "_g", "_s", F.col("_t").alias("_tb"), F.col("_id").alias("_b"))
    pairs = texts.join(left, ["_k", "_g", "_s", "_ta"]).join(right, ["_k", "_g", "_s", "_tb"]).where("_a < _b")
    return pairs.select(F.col("_a").alias(f"{id_col}_a"), F.col("_b").alias(f"{id_col}_b")).distinct()


def lookalike_classes(strings: DataFrame, id_col: str = "string_id", group_col: str = "file_in", text_col: str = "content") -> DataFrame:
    """(group_col, canonical, texts, rows): classes of a group that hold more than one text, with their sizes."""
    rows = strings.select(F.col(group_col), F.col(text_col).alias("_t"), canonical_udf(F.col(text_col)).alias("canonical")).where("trim(canonical) <> ''")
    texts = rows.groupBy(group_col, "canonical", "_t").count()
    return texts.groupBy(group_col, "canonical").agg(F.count("*").alias("texts"), F.sum("count").alias("rows")).where("texts > 1")


def mapped_report(strings: DataFrame, group_col: str = "file_in", text_col: str = "content") -> DataFrame:
    """(group_col, strings_total, strings_changed, chars_mapped): what the mapping does to each file.

    chars_mapped counts the characters whose prototype isn't themselves. Null contents count as no string.
    """

    @F.pandas_udf(T.LongType())
    def mapped(s: pd.Series) -> pd.Series:
        table = prototypes()
        return s.map(lambda x: 0 if x is None or x.isascii() else sum(ord(c) in table for c in x)).astype("int64")

    rows = strings.select(F.col(group_col), F.col(text_col).alias("_t"), canonical_udf(F.col(text_col)).alias("_c"), mapped(F.col(text_col)).alias("_n")).where("_t IS NOT NULL")
    return rows.groupBy(group_col).agg(F.count("*").alias("strings_total"), F.sum((F.col("_t") != F.col("_c")).cast("long")).alias("strings_changed"), F.sum("_n").alias("chars_mapped"))
