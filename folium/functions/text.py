"""Text cleaning as column expressions. Each takes and returns a Column; null stays null unless said otherwise.

Everything but canonical composition runs in the JVM. Character classes are spelled out, so that they mean the same in
every engine: WORD is a letter, number or underscore, WS a blank of any kind.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folium.functions import lexicon as lx

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
BREAKS = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; text that is composed already passes through."""
    return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x))


@functools.lru_cache(maxsize=1)
def fold_map() -> tuple[str, str]:
    """(from, to) for translate: characters that lose their marks and leave a single character."""
    a, b = [], []
    for cp in range(0xC0, sys.maxunicode + 1):
        c = chr(cp)
        if 0xAC00 <= cp <= 0xD7A3 or not unicodedata.decomposition(c) or unicodedata.decomposition(c).startswith("<"):
            continue
        d = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(d) == 1 and d != c:
            a.append(c)
            b.append(d)
    return "".join(a), "".join(b)


def strip(c: Column) -> Column:
    """Blanks of any kind off both ends."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def map_glyphs(c: Column) -> tuple[Column, Column]:
    """(mapped, how many characters were mapped): odd blanks, unseen characters, typographic quotes and dashes."""
    keys = lx.TO_BLANK + "".join(lx.QUOTES) + lx.TO_NOTHING
    to = " " * len(lx.TO_BLANK) + "".join(lx.QUOTES.values())
    n = F.length(c) - F.length(F.translate(c, keys + lx.ELLIPSIS, ""))
    return F.replace(F.translate(c, keys, to), F.lit(lx.ELLIPSIS), F.lit("...")), n


def drop_controls(c: Column) -> tuple[Column, Column]:
    """(kept, how many were dropped): controls but newline and tab, unassigned and private characters go; formats stay."""
    out = F.regexp_replace(c, r"[\p{Cc}\p{Cn}\p{Cs}\p{Co}&&[^\n\t]]", "")
    return out, F.length(c) - F.length(out)


def collapse_blanks(c: Column) -> Column:
    """Runs of blanks within a line become one blank; newlines stay, nothing is trimmed."""
    return F.regexp_replace(F.regexp_replace(c, r"[ \t\x{a0}\x{2000}-\x{200b}\x{202f}\x{2060}\x{feff}]+", " "), " {2,}", " ")


def clean(c: Column) -> Column:
    """struct(cleaned, removed, mapped, changed) of a string: composed, mapped, filtered, blanks collapsed."""
    mapped, n = map_glyphs(nfc(c))
    kept, dropped = drop_controls(mapped)
    out = collapse_blanks(kept)
    return F.when(c.isNotNull(), F.struct(out.alias("cleaned"), dropped.alias("removed"), n.alias("mapped"), (out != c).alias("changed")))


def scraper_clean(c: Column) -> Column:
    """Composed, all control and format characters but newline and tab dropped, blank runs and empty lines thinned, trimmed."""
    x = F.regexp_replace(nfc(c), r"[\p{C}&&[^\n\t]]", "")
    return strip(F.regexp_replace(F.regexp_replace(x, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def layout_clean(c: Column, legacy_micro: bool = False) -> Column:
    """Words divided at line ends joined, carriage returns dropped, lines trimmed, empty ones left out. Null gives "".

    legacy_micro also writes degrees for " oC" and a micro sign for every u, which corrupts words; it is off.
    """
    x = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("-\n"), F.lit("")), F.lit("\r"), F.lit(""))
    if legacy_micro:
        x = F.replace(F.replace(x, F.lit(" oC"), F.lit(" °C")), F.lit("u"), F.lit("µ"))
    lines = F.transform(F.split(x, BREAKS), strip)
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def normal_form(c: Column) -> Column:
    """Lower case, no accents, words separated by single blanks."""
    a, b = fold_map()
    x = F.regexp_replace(F.translate(F.lower(c), a, b), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(x, f"[^{WORD}]+", " "))


def safe_path(c: Column) -> Column:
    """A dotted path as part of an id: . [ blank - / become _, ] goes, _ off the ends."""
    return F.regexp_replace(F.translate(c, ".[ -/]", "_____"), "^_+|_+$", "")


def csv_value(c: Column, legacy_quotes: bool = False) -> Column:
    """Null as the empty string. legacy_quotes doubles quotes, though a CSV writer doubles them again."""
    x = F.coalesce(c.cast("string"), F.lit(""))
    return F.replace(x, F.lit('"'), F.lit('""')) if legacy_quotes else x


def slug(c: Column) -> Column:
    """Letters, digits, _ and - of ASCII, other runs as one -, none at the ends, 64 characters at most."""
    return F.left(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^a-zA-Z0-9_-]+", "-"), "^-+|-+$", ""), F.lit(64))


def file_name(c: Column) -> Column:
    """A title as a file name: everything but letters, numbers and -_. becomes -."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}\-_.]", "-")


def dedent(c: Column) -> Column:
    """A text trimmed before has no common indent: only lines of blanks change, to empty ones."""
    return F.regexp_replace(c, r"(?m)^[ \t]+$", "")


def document_name(date: Column, number: Column, url: Column, lang: Column) -> Column:
    """bopv_<date>_<number>_<lang>.json; without a number the end of the address stands for it."""
    tail = F.regexp_replace(F.right(url, F.lit(20)), r"[^\p{L}\p{N}_]", "_")
    return F.concat(F.lit("bopv_"), F.coalesce(date, F.lit("unknown-date")), F.lit("_"), F.coalesce(number, tail), F.lit("_"), lang, F.lit(".json"))


def round4(c: Column) -> Column:
    """Four decimals, halves up by the binary value, which is the same in every engine."""
    return F.floor(c * 1e4 + 0.5) / 1e4
