"""Text features that the trained models of this package share."""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache

import regex

from folium.llm.sentences import sentence_spans

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def fold(text: str) -> str:
    """Lower case without accents, so that capitals and unaccented texts give the same features."""
    t = text.lower()
    if t.isascii():
        return t
    return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")


def words(folded: str) -> list[str]:
    return WORD.findall(folded)


def segments(text: str | None) -> list[tuple[int, int]]:
    """Sentences of a paragraph, without the bare slashes or bullets that may join them; pieces without letters too."""
    out = []
    for a, b in sentence_spans(text):
        while a < b and not text[a].isalnum() and text[a] in "/|·•–—-* \t":
            a += 1
        if a < b:
            out.append((a, b))
    return out


@lru_cache(maxsize=200_000)
def subwords(word: str, buckets: int) -> tuple[int, ...]:
    """Buckets of a word and of its 4- and 5-letter pieces, its ends marked."""
    w = f"<{word}>"
    out = [zlib.crc32(w.encode())]
    for n in (4, 5):
        if len(w) > n:
            out += [zlib.crc32(w[k : k + n].encode()) for k in range(len(w) - n + 1)]
    return tuple(h % buckets for h in out)


def bag(folded: str, buckets: int) -> list[int]:
    """Buckets of all words and subwords of a text."""
    out: list[int] = []
    for w in WORD.findall(folded):
        out += subwords(w, buckets)
    return out
