"""Problem 10: sentence units of every document, in all its languages and scripts.

Method: the standard character-property rules of sentence breaking. Every character has a class (full stop, other
terminator, closer, opener, separator, upper, lower, caseless letter, digit); a terminator with its closers ends a
unit unless what follows continues it (a lower-case letter, a digit or letter without a blank, a comma). To these come
abbreviation lists by language, and a stack of open quotation marks and brackets: a terminator inside a quotation that
opened within a sentence ends nothing, and closing marks stay with their sentence. Scripts whose terminators need no
blank break at once; Thai, which writes none, breaks at blanks between its letters. Headings and list items on a line
of their own are units, found from the lines around them; any other line break is a blank.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Abbreviations by language. `title` stands before a name, `ref` before a number, `mid` within a sentence.
ABBREVIATIONS = {
    "es": {"title": "sr sra srta sres dr dra d dña prof profa ing lic excmo excma ilmo ilma sto sta gral", "ref": "pág págs pag núm núms num art arts apdo cap caps fig figs vol tomo pár tel secc ap p pp s ss nº", "mid": "ee p ej aprox av avda c ca cía dpto ud uds vs"},
    "eu": {"title": "jn and dk", "ref": "or orr zk art irud kap", "mid": "adib hau h d"},
    "en": {"title": "mr mrs ms dr prof st rev hon gen capt sgt", "ref": "no nos fig figs sec secs vol art arts ch p pp para eq ref app", "mid": "e g i eg ie cf vs approx ca u s dept inc ltd"},
    "fr": {"title": "m mm mme mmes mlle mlles dr pr me mgr", "ref": "art arts al p pp fig figs vol chap n no nos tél par éd", "mid": "cf p ex env c av bd vs"},
    "de": {"title": "hr fr dr prof ing dipl st", "ref": "nr art abs s bd kap abb tab ziff str tel", "mid": "z b d h u a o ä bzw ca vgl usf evtl ggf inkl"},
    "hi": {"title": "डॉ श्री प्रो", "ref": "सं", "mid": ""},
    "ar": {"title": "د أ", "ref": "ص", "mid": ""},
}
# Function words that tell which lists apply to a block of text.
FUNCTION_WORDS = {
    "es": "el la los las de del que en y un una se por con para según",
    "eu": "eta da du dute ez bat herriko herrian zuen ditu dira ere",
    "en": "the of and to in is with a an was for that",
    "fr": "le la les des du et un une est dans pour avec qui",
    "de": "der die das und den dem ein eine ist mit für von auf im",
}
# Months, before which a number with a full stop is an ordinal.
MONTHS = frozenset("januar februar märz april mai juni juli august september oktober november dezember jänner".split())
_WORDS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_ABBR = {k: {c: frozenset(w.split()) for c, w in v.items()} for k, v in ABBREVIATIONS.items()}
_NONE = {"title": frozenset(), "ref": frozenset(), "mid": frozenset()}

STOPS = ".．"
#: Terminators other than the full stop; those in GLUED need no blank after them.
GLUED = frozenset("。！？｡︒﹗﹖")
OTHERS = frozenset("!?…‼⁇⁈⁉।॥؟۔։።፧፨᙮᠃᠉။៕៖࠰꓿꘎꘏꣎꣏꤯꧈꧉꫰꫱꯫") | GLUED
CLOSERS = frozenset("\"'”’»›)]}」』）】》〉］｝〗〙〛›")
OPENERS = {"“": "”", "„": "“”", "‘": "’", "«": "»", "‹": "›", "(": ")", "[": "]", "{": "}", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉", "［": "］", "»": "«", "‚": "‘’"}
BLANKS = frozenset(" \t\n\r\x0b\x0c\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff\u200b")
BLANK_TEXT = "".join(BLANKS)
DASHES = frozenset("-–—―·•")


def _thai(c: str) -> bool:
    return "฀" <= c <= "໿" or "က" <= c <= "႟" and c not in "။၊" or "ក" <= c <= "៓"


def _tools():
    import regex

    global _RE
    if "_RE" not in globals():
        turns = sorted({*STOPS, *OTHERS, '"', *OPENERS, *"".join(OPENERS.values())})
        _RE = {
            "turn": regex.compile(f"[{regex.escape(''.join(turns))}]"),
            "turn_thai": regex.compile(f"[{regex.escape(''.join([*turns, *sorted(BLANKS)]))}]"),
            "thai": regex.compile("[฀-໿က-႟ក-៓]"),
            "item": regex.compile(r"[^\S\n]*(?:(?P<dash>[-–—•*▪‣◦·])[^\S\n]+|(?P<num>\d{1,3})(?P<nm>[.)])[^\S\n]+|(?P<let>\p{L})(?P<lm>[.)])[^\S\n]+|\((?P<par>\p{L}|\d{1,3}|[ivx]+)\)[^\S\n]+)\S"),
            "word": regex.compile(r"[\p{L}\p{M}]+"),
            "start": regex.compile(r"[^\S\n]*(?:\p{Lu}|\d|[¿¡(«\"“„‘'])"),
        }
    return _RE


def _languages(text: str, declared: str | None) -> tuple[str, ...]:
    words = {w.lower() for w in _tools()["word"].findall(text)}
    got = {k for k, ws in _WORDS.items() if not ws.isdisjoint(words)}
    if declared:
        got.add(declared[:2].lower())
    return tuple(k for k in _ABBR if k in got or k in ("hi", "ar"))


@functools.lru_cache(maxsize=256)
def _lists(languages: tuple[str, ...]) -> dict[str, frozenset[str]]:
    """The abbreviations of some languages together, by kind."""
    use = [_ABBR[k] for k in languages] or [_NONE]
    return {c: frozenset().union(*(u[c] for u in use)) for c in ("title", "ref", "mid")}


class _Block:
    """Breaks one stretch of running text."""

    def __init__(self, declared: str | None):
        self.declared = declared

    def abbreviations(self, text: str) -> dict[str, frozenset[str]]:
        return _lists(_languages(text, self.declared))

    def breaks(self, s: str) -> list[int]:
        """Positions after which a unit ends (the position of the first character that no longer belongs to it)."""
        n, out, abbr = len(s), [], None
        stack: list[tuple[str, bool]] = []  # closers wanted, whether opened at the start of a unit
        begin = True  # nothing but blanks and openers since the last break
        at, k = 0, 0  # at: where the unit began
        limit = 2000  # an opener that is never closed counts no longer than this many characters
        opened: list[int] = []
        tools = _tools()
        turn = tools["turn_thai" if tools["thai"].search(s) else "turn"]
        while k < n:
            m = turn.search(s, k)  # nothing happens between the characters that can open, close or end something
            if begin and s[k : m.start() if m else n].strip(BLANK_TEXT):
                begin = False
            if not m:
                break
            k = m.start()
            c = s[k]
            if stack and k - opened[-1] > limit:
                stack.clear()
                opened.clear()
            if c in BLANKS:
                if not stack and k and (_thai_before(s, k) or _thai_after(s, k)) and not begin:
                    j = k
                    while j < n and s[j] in BLANKS:
                        j += 1
                    if j < n and _thai_before(s, k) and (_thai(s[j]) or s[j].isupper() or not s[j].isalnum()) or j < n and _thai(s[j]) and _ends_thai(s, at, k):
                        out.append(k)
                        at, begin, k = j, True, j
                        continue
                k += 1
                continue
            if stack and c in stack[-1][0] and not (c in "'’" and 0 < k < n - 1 and s[k - 1].isalnum() and s[k + 1].isalnum()):
                stack.pop()
                opened.pop()
                k += 1
                continue
            if c == '"':
                stack.append(('"', begin))
                opened.append(k)
                k += 1
                continue
            if c in OPENERS and not (c in "‘‚" and 0 < k and s[k - 1].isalnum()) and c != "»":
                stack.append((OPENERS[c], begin))
                opened.append(k)
                k += 1
                continue
            if not (c in STOPS or c in OTHERS):
                begin = False
                k += 1
                continue
            # a run of terminators, then closers
            j, q = k, None
            while j < n and (s[j] in STOPS or s[j] in OTHERS):
                j += 1
            run, k0 = s[k:j], k
            deep = list(stack)
            e = j
            while e < n:
                x = s[e]
                if x in CLOSERS:
                    if deep and x in deep[-1][0]:
                        q = deep.pop()
                        e += 1
                        continue
                    if x in "'\"" and not (deep and x in deep[-1][0]):
                        break
                    e += 1
                    continue
                if x in BLANKS and x != "\n" and deep and e + 1 < n and s[e + 1] in deep[-1][0] and s[e + 1] in "»›":
                    e += 1  # French sets a blank before the closing mark
                    continue
                break
            f = e
            while f < n and s[f] in BLANKS:
                f += 1
            nxt = s[f] if f < n else ""
            begin = False
            if deep and nxt:
                k = e  # still inside a quotation or bracket
                stack, opened = deep, opened[: len(deep)]
                continue
            stack, opened = deep, opened[: len(deep)]
            k = e
            if not nxt:
                break
            if f == e and not any(x in GLUED for x in run) and not _joined(s, k0, e):
                continue  # no blank: 3.5, www.x, v1.2
            if run in (".", "．") and q is None:
                if abbr is None:
                    abbr = self.abbreviations(s)
                if self.suppressed(s, j - 1, f, abbr):
                    continue
            g = f
            while g < n and (s[g] in DASHES or s[g] in BLANKS):
                g += 1
            head = s[g] if g < n else ""
            if head.islower() or nxt in ",;:、，；：)]}»”" or (head and head in ",;:"):
                if not (g == f + 1 and s[f] in "•·"):
                    continue
            if q is not None and not q[1]:  # the quotation or bracket opened within the sentence
                if not (head.isupper() or head.isdigit() or head in "¿¡(«\"“„‘" or not head):
                    continue
                if head.isdigit() and s[e - 1] in ")]}":
                    pass
            out.append(e)
            at, begin, k = f, True, f
        return out

    def suppressed(self, s: str, dot: int, f: int, abbr: dict) -> bool:
        """Whether the full stop at dot, followed by s[f], ends an abbreviation, an initial or an ordinal."""
        b = dot
        while b and (s[b - 1].isalnum() or s[b - 1] in "ऀ-ॿ" or "ऀ" <= s[b - 1] <= "ॿ"):
            b -= 1
        w, nxt = s[b:dot], s[f]
        low = w.lower()
        if not w:
            return False
        if w.isdigit():
            g = f
            while g < len(s) and s[g].isalpha():
                g += 1
            return s[f:g].lower() in MONTHS and (self.declared or "de")[:2] != "xx"
        if low in abbr["title"] and (not w[0].islower() or low in ("jn", "and")):
            return True
        if low in abbr["ref"] and (nxt.isdigit() or nxt in "IVXLCM" or nxt.islower() or nxt in "¿#§"):
            return True
        if low in abbr["mid"] and (nxt.isdigit() or nxt.islower() or self._short(s, f)):
            return True
        if len(w) == 1 and w.isupper():
            prev = b - 1
            while prev >= 0 and s[prev] in BLANKS:
                prev -= 1
            if prev >= 0 and s[prev] == "." and b - 1 == prev:  # U.S. before an upper-case word
                return self._country(s, f)
            return nxt.isupper()
        return False

    @staticmethod
    def _short(s: str, f: int) -> bool:
        """The next word is one or two letters with a full stop, as in z. B. or EE. UU."""
        g = f
        while g < len(s) and s[g].isalpha():
            g += 1
        return 0 < g - f <= 2 and g < len(s) and s[g] == "."

    @staticmethod
    def _country(s: str, f: int) -> bool:
        g = f
        while g < len(s) and s[g].isalpha():
            g += 1
        return s[f:g] in {"Government", "Congress", "Senate", "Army", "Navy", "Treasury", "Patent"}


def _joined(s: str, k: int, e: int) -> bool:
    """Two sentences set without a blank: letters, the terminator at k, and a capitalised or caseless word at e."""
    b = k
    while b and s[b - 1].isalpha():
        b -= 1
    prev, nxt = s[k - 1] if k else "", s[e]
    if nxt in "¿¡":
        return True
    if nxt.isalpha() and not nxt.isupper() and not nxt.islower():
        return True
    if nxt.isupper():
        after = s[e + 1] if e + 1 < len(s) else ""
        return (k - b >= 2 and prev.islower() or not prev.isalpha()) and (after.islower() or after == " ")
    if nxt.isdigit() and k - b >= 4 and prev.islower():
        g = e
        while g < len(s) and (s[g].isdigit() or s[g] in ".,"):
            g += 1
        return g + 1 < len(s) and s[g] in BLANKS and s[g + 1].islower()
    return False


def _thai_before(s: str, k: int) -> bool:
    """A Thai letter stands before s[k], digits and such aside."""
    j = k - 1
    while j >= 0 and (s[j].isdigit() or s[j] in ".,:%)"):
        j -= 1
    return j >= 0 and _thai(s[j])


def _thai_after(s: str, k: int) -> bool:
    j = k
    while j < len(s) and s[j] in BLANKS:
        j += 1
    return j < len(s) and _thai(s[j])


def _ends_thai(s: str, a: int, b: int) -> bool:
    return any(_thai(c) for c in s[a:b])


def sentence_spans(text: str | None, lang: str | None = None, heading_chars: int = 90) -> list[tuple[int, int]]:
    """(start, end) of each unit of text in code points, in order. None for a null, empty or blank text."""
    if not text or not text.strip():
        return []
    tools = _tools()
    spans: list[tuple[int, int]] = []
    block = _Block(lang)
    lines, pos = [], 0
    for line in text.split("\n"):
        lines.append((pos, pos + len(line)))
        pos += len(line) + 1
    blank = [not text[a:b].strip() for a, b in lines]
    n = len(lines)

    def add(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            spans.append((a, b))

    def ended(i: int) -> bool:
        """Line i ends a unit, as far as one can see from its last characters."""
        t = text[lines[i][0] : lines[i][1]].rstrip()
        while t and (t[-1] in CLOSERS or t[-1] in BLANKS):
            t = t[:-1]
        return bool(t) and (t[-1] in STOPS or t[-1] in OTHERS)

    def mark(i: int):
        m = tools["item"].match(text, lines[i][0], lines[i][1])
        if not m:
            return None
        if m["dash"]:
            return ("dash", m["dash"], 0)
        if m["num"]:
            return ("num", m["nm"], int(m["num"]))
        if m["let"]:
            return ("let", m["lm"], ord(m["let"]))
        return ("par", "()", 0)

    run: list[int] = []  # lines of running text that wait to be broken

    def flush() -> None:
        if not run:
            return
        a, b = lines[run[0]][0], lines[run[-1]][1]
        run.clear()
        last = 0
        part = text[a:b]
        for e in block.breaks(part):
            add(a + last, a + e)
            last = e
        add(a + last, b)

    before = None  # mark of the list item on the line before
    i = 0
    while i < n:
        if blank[i]:
            flush()
            before = None
            i += 1
            continue
        a, b = lines[i]
        fresh = not run or ended(run[-1]) or _thai_before(text, lines[run[-1]][0] + len(text[lines[run[-1]][0] : lines[run[-1]][1]].rstrip()))
        m = mark(i)
        if m and fresh:
            follow = mark(i + 1) if i + 1 < n and not blank[i + 1] else None
            same = before is not None and before[:2] == m[:2]
            next_same = follow is not None and follow[:2] == m[:2]
            if m[0] == "num":
                ok = same and m[2] == before[2] + 1 or next_same and follow[2] == m[2] + 1 or m[2] == 1
                ok = ok and text[a:b].strip() != "" and not _heading_number(text[a:b])
            elif m[0] == "let":
                ok = m[1] == ")" or same and m[2] == before[2] + 1 or next_same and follow[2] == m[2] + 1
            else:
                ok = True
            if ok:
                flush()
                add(a, b)
                before = m
                i += 1
                continue
        if fresh and (i + 1 == n or blank[i + 1] or not ended(i)) and not ended(i) and b - a <= heading_chars and _heading(text, lines, blank, i, tools):
            flush()
            add(a, b)
            before = None
            i += 1
            continue
        before = None
        run.append(i)
        i += 1
    flush()
    return spans


def _heading_number(line: str) -> bool:
    """A numbered heading in capitals, as in `8. ANNEX`."""
    t = line.strip().rstrip("0123456789")
    letters = [c for c in t if c.isalpha()]
    return len(letters) > 3 and all(c.isupper() for c in letters)


def _heading(text: str, lines: list[tuple[int, int]], blank: list[bool], i: int, tools: dict) -> bool:
    """Line i, without a terminator, stands alone: nothing follows in its block, or what follows begins anew."""
    if any(_thai(c) for c in text[lines[i][0] : lines[i][1]]):
        return False
    if i + 1 == len(lines) or blank[i + 1]:
        return True
    line = text[lines[i][0] : lines[i][1]]
    letters = [c for c in line if c.isalpha()]
    if letters and all(c.isupper() for c in letters) and len(letters) > 3:
        return True
    return False


def split_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(id_col, ord int, start_pos int, end_pos int, sentence string): the units of every text in order.

    Positions are code points of the text. Null, empty and blank texts have no row; a null or wrong language only
    means that the lists of the languages seen in the text apply. Repeated rows give repeated units. One pass, no
    shuffle; texts are handled a few at a time, so very long ones need no more than their own size.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                b = batch.slice(k, 128)
                rows, order, start, end, text_out = [], [], [], [], []
                langs = b.column(2).to_pylist()
                for r, t in enumerate(b.column(1).to_pylist()):
                    for o, (x, y) in enumerate(sentence_spans(t, langs[r])):
                        rows.append(r)
                        order.append(o)
                        start.append(x)
                        end.append(y)
                        text_out.append(t[x:y])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(order, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(text_out, pa.string())], names=[id_col, "ord", "start_pos", "end_pos", "sentence"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("ord", T.IntegerType()), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType()), T.StructField("sentence", T.StringType())])
    from pyspark.sql import functions as F

    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    return docs.select(id_col, F.col(text_col).alias("_t"), lang.alias("_l")).mapInArrow(run, schema)
