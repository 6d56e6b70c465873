"""Problem 3: text read from scanned pages, repaired into continuous paragraphs.

Method: averaged perceptrons. A character editor gives each character of a word an operation: keep, delete, replace by
other characters, insert after it, and, where a word is divided over two lines, join with or without the hyphen. It is
trained on words of the collection itself, clean and with shapes confused as a scanner confuses them (SHAPES), and on
words divided at line ends. What it proposes for a word, best sequences first, is then held against the collection's own
word counts: a proposal stands if its word is so much more frequent than the one read that this can be a misreading of it.
A second perceptron judges lines at block edges by their place on the page, role, repetition over the pages of their
file, form and words, and takes out running headers and page numbers.

Words are judged once per distinct form, by joins with the counts; no list of words is collected. The editor is trained
on the max_words most frequent words, the line judge on a bounded sample of lines by hash; all counts cover everything.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.llm.features import fold
from folium.session import cut

# Shapes that scanners confuse, as printed and as read.
SHAPES = (
    "m rn", "rn m", "d cl", "cl d", "n ri", "u ii", "e c", "t f", "h b", "q g", "a @", "i !", "o 0", "O 0", "l 1", "i 1", "I 1", "s 5", "S 5", "b 6", "z 2", "Z 2", "g 9", "B 8",
    "á ä", "á à", "í ì", "í ï", "é è", "é ë", "ó ò", "ó ö", "ó 6", "ú ù", "ú ü", "ñ n", "ri n", "ii u", "li h", "h li", "ll U", "ñ fi", "c e", "f t", "b h", "vv w", "w vv", "l I", "I l",
    "0 O", "0 o", "1 l", "1 I", "2 Z", "5 S", "8 B", "6 b", "9 g", "7 T",
)
#: Marks that divide a word at the end of a line, as characters of a class.
MARKS = "-\u00ad\u2010\u2011\u00ac"
LEAD = "\"'«“„‘([{<¿¡—–•*·~-"
TRAIL = "\"'»”’)]}>,.;:?…—–•*·~"
TOKEN = regex.compile(r"\S+")
DIGITS = regex.compile(r"\p{Nd}")
NUMERIC = regex.compile(r"[\p{Nd}.,:/%×+\-]*")


def core(token: str) -> tuple[str, int]:
    """A token without the punctuation around it, and where it begins."""
    a, b = 0, len(token)
    while a < b and token[a] in LEAD:
        a += 1
    while b > a and (token[b - 1] in TRAIL or token[b - 1] == "!" and token.startswith("¡")):
        b -= 1
    return token[a:b], a


def word_key(w: str) -> str:
    """What counts as one word: lower case, every digit as 9."""
    return DIGITS.sub("9", w.lower())


class Perceptron:
    """Multi-class averaged perceptron over string features."""

    def __init__(self) -> None:
        self.w: dict[str, dict[str, float]] = defaultdict(dict)

    def score(self, feats: list[str], labels: list[str]) -> dict[str, float]:
        out = dict.fromkeys(labels, 0.0)
        for f in feats:
            row = self.w.get(f)
            if row:
                for lab, v in row.items():
                    if lab in out:
                        out[lab] += v
        return out

    @staticmethod
    def fit(rows: list[tuple[list[str], list[str], str]], epochs: int = 4, seed: int = 3) -> Perceptron:
        """rows: (features, labels to choose from, right label)."""
        p, total, stamp, now = Perceptron(), defaultdict(float), defaultdict(int), 0
        rng = random.Random(seed)
        order = list(range(len(rows)))

        def bump(f: str, lab: str, d: float) -> None:
            row = p.w[f]
            old = row.get(lab, 0.0)
            total[f, lab] += (now - stamp[f, lab]) * old
            stamp[f, lab] = now
            row[lab] = old + d

        for _ in range(epochs):
            rng.shuffle(order)
            for k in order:
                feats, labels, right = rows[k]
                s = p.score(feats, labels)
                got = max(labels, key=lambda x: (s[x], x))
                now += 1
                if got != right:
                    for f in feats:
                        bump(f, right, 1.0)
                        bump(f, got, -1.0)
        mean = Perceptron()
        for f, row in p.w.items():
            new = {}
            for lab, v in row.items():
                t = (total[f, lab] + (now - stamp[f, lab]) * v) / max(now, 1)
                if abs(t) > 1e-3:
                    new[lab] = t
            if new:
                mean.w[f] = new
        mean.w = dict(mean.w)
        return mean


KEEP, DROP, JOIN, HYPHEN = "keep", "delete", "join", "join-"


def char_features(s: str, i: int) -> list[str]:
    p = "^^^" + s + "$$$"
    k = i + 3
    c = p[k]
    low = "".join("9" if x.isdigit() else x.lower() for x in p[k - 3 : k + 4])
    kinds = "".join("d" if x.isdigit() else "U" if x.isupper() else "a" if x.isalpha() else x for x in p[k - 2 : k + 3])
    return [f"c{c}", f"-1{p[k - 1 : k + 1]}", f"+1{p[k : k + 2]}", f"3{low[2:5]}", f"L{low[1:4]}", f"R{low[3:6]}", f"5{low[1:6]}", f"K{c}{kinds}", f"S{c}{''.join(sorted(set(kinds)))}", f"LL{low[0:4]}", f"RR{low[3:7]}"]


def operations(clean: str, rng: random.Random, rules: dict[str, list[str]], n: int) -> tuple[str, list[str]] | None:
    """clean with n shapes confused, and the operation that restores it for each character read."""
    places = [(i, a) for a in rules for i in range(len(clean)) if clean.startswith(a, i)]
    rng.shuffle(places)
    use: list[tuple[int, str, str]] = []
    for i, a in places:
        if all(i + len(a) <= x or x + len(b) <= i for x, b, _ in use):
            use.append((i, a, rng.choice(rules[a])))
            if len(use) == n:
                break
    if not use:
        return None
    read, ops, at = "", [], 0
    for i, a, b in sorted(use):
        read += clean[at:i]
        ops += [KEEP] * (i - at)
        read += b
        ops += [f"replace {a}"] + [DROP] * (len(b) - 1)
        at = i + len(a)
    read += clean[at:]
    ops += [KEEP] * (len(clean) - at)
    return read, ops


@dataclass
class Editor:
    """The trained character editor: options[c] are the operations ever right for a character read as c."""

    model: Perceptron
    options: dict[str, list[str]]

    def proposals(self, s: str, edits: int = 2, beam: int = 40) -> list[tuple[str, float, int]]:
        """(string, gain, edits): what s may stand for, other than itself; gain is the score against keeping all.

        All single edits are there; of those of more edits the `beam` best are followed.
        """
        states: dict[tuple[str, int, bool], float] = {("", 0, False): 0.0}
        for i, c in enumerate(s):
            opts = self.options.get(c)
            nxt: dict[tuple[str, int, bool], float] = {}
            if not opts:
                for (t, n, _), v in states.items():
                    nxt[t + c, n, False] = v
                states = nxt
                continue
            sc = self.model.score(char_features(s, i), opts)
            base = sc[KEEP]
            for (t, n, open_), v in states.items():
                for o in opts:
                    if o == KEEP:
                        key, gain = (t + c, n, False), 0.0
                    elif o == DROP:
                        if not open_:
                            continue
                        key, gain = (t, n, False), sc[o] - base
                    else:
                        if n >= edits:
                            continue
                        key, gain = (t + o[8:], n + 1, True), sc[o] - base
                    if v + gain > nxt.get(key, -1e9):
                        nxt[key] = v + gain
            if sum(k[1] > 1 for k in nxt) > beam:
                few = sorted((x for x in nxt.items() if x[0][1] > 1), key=lambda x: -x[1])[:beam]
                nxt = {k: v for k, v in nxt.items() if k[1] < 2} | dict(few)
            states = nxt
        out: dict[str, tuple[float, int]] = {}
        for (t, n, _), v in states.items():
            if n and t != s and t and (t not in out or n < out[t][1] or n == out[t][1] and v > out[t][0]):
                out[t] = (v, n)
        return sorted(((t, v, n) for t, (v, n) in out.items()), key=lambda x: (x[2], -x[1], x[0]))

    def joins(self, left: str, right: str) -> list[tuple[str, float]]:
        """A word divided at a line end: joined without and with a hyphen, the better first."""
        sc = self.model.score(join_features(left, right), [JOIN, HYPHEN])
        d = sc[JOIN] - sc[HYPHEN]
        both = [(left + right, d / 2), (f"{left}-{right}", -d / 2)]
        return both if d >= 0 else both[::-1]


def join_features(left: str, right: str) -> list[str]:
    a, b = left.lower(), right.lower()
    return [f"jl{a[-1:]}", f"jr{b[:1]}", f"j2{a[-2:]}|{b[:2]}", f"jL{a}", f"jR{b}", f"ja{a[-3:]}", f"jb{b[:3]}", "jup" if right[:1].isupper() else "jlow", "jd" if right[:1].isdigit() else "ja"]


def train_editor(words: list[tuple[str, int]], seed: int = 5, variants: int = 3, epochs: int = 4) -> Editor:
    """From frequent words with their counts, and figures made up in the forms that occur."""
    rng = random.Random(seed)
    rules: dict[str, list[str]] = defaultdict(list)
    for r in SHAPES:
        a, b = r.split()
        rules[a].append(b)
    letters = {a: [b for b in bs] for a, bs in rules.items() if not a[0].isdigit()}
    digits = {a: bs for a, bs in rules.items() if a[0].isdigit()}
    rows: list[tuple[str, list[str]]] = []
    joins: list[tuple[list[str], str]] = []
    for w, _ in words:
        has = any(c.isdigit() for c in w)
        if has:
            w = "".join(str(rng.randrange(10)) if c == "9" else c for c in w)
        rows.append((w, [KEEP] * len(w)))
        for k in range(variants * (3 if has else 1)):
            got = operations(w, rng, digits if has else letters, 1 if k % 3 else rng.choice((1, 2)))
            if got:
                rows.append(got)
        if not has and len(w) > 4:
            parts = w.split("-")
            if len(parts) == 2 and all(parts):
                joins.append((join_features(*parts), HYPHEN))
            elif "-" not in w:
                k = rng.randrange(2, len(w) - 1)
                joins.append((join_features(w[:k], w[k:]), JOIN))
    options: dict[str, set[str]] = defaultdict(lambda: {KEEP})
    for s, ops in rows:
        for c, o in zip(s, ops, strict=True):
            options[c].add(o)
    opts = {c: sorted(o) for c, o in options.items() if len(o) > 1}
    data = [(char_features(s, i), opts[c], o) for s, ops in rows for i, (c, o) in enumerate(zip(s, ops, strict=True)) if c in opts]
    data += [(f, [JOIN, HYPHEN], lab) for f, lab in joins]
    return Editor(Perceptron.fit(data, epochs), opts)


# ------------------------------------------------------------------ lines and furniture

NUMBER_LINE = r"^[^\p{L}\p{N}]*(?:(?:p|pp|pág|pag|págs|page|seite|orr|or|orrialdea|página|nº|n)\.?\s*)?(\p{Nd}{1,5}|[ivxlcdm]{1,7})(?:\s*(?:/|de|of|sur|von|\|)\s*\p{Nd}{1,5})?\s*(?:\.?\s*(?:or|orr|orrialdea)\.?)?[^\p{L}\p{N}]*$"
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def roman(s: str) -> int | None:
    n = 0
    for a, b in zip(s, [*s[1:], ""], strict=True):
        v = ROMAN.get(a)
        if v is None:
            return None
        n += -v if b and ROMAN.get(b, 0) > v else v
    return n


def to_roman(n: int) -> str:
    out = ""
    for v, r in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += r * (n // v)
        n %= v
    return out


def line_key(s: str) -> str:
    """What header lines of one file have in common: letters only, look-alike shapes as one, without figures."""
    t = regex.sub(r"(?<![\p{L}\p{N}])\p{N}+(?![\p{L}\p{N}])", " ", fold(s))
    for a, b in (("fi", "n"), ("rn", "m"), ("cl", "d"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("0", "o"), ("1", "l"), ("5", "s"), ("@", "a"), ("!", "l")):
        t = t.replace(a, b)
    t = t.translate(str.maketrans("cfbgi", "ethql"))
    return "".join(c for c in t if c.isalpha())


def number_form(s: str) -> tuple[str, int] | None:
    """(form, number) of a line that only numbers a page; the form tells styles apart."""
    m = _NUMBER.match(s.strip().lower())
    if not m or not s.strip():
        return None
    t = s.strip().lower()
    n = int(m[1]) if m[1][0].isdigit() else roman(m[1])
    if n is None or not m[1][0].isdigit() and (n > 399 or to_roman(n) != m[1]):
        return None
    tail, lead = t[m.end(1) :], t[: m.start(1)]
    if tail and not any(c.isalnum() for c in tail) and tail[0] in ".),;:" and not (lead and lead[0] in "([.-–—" + tail[0]):
        return None  # the end of a sentence
    form = t[: m.start(1) - 0] + ("#" if m[1][0].isdigit() else "i") + DIGITS.sub("9", t[m.end(1) :])
    return regex.sub(r"9+", "9", form.replace(" ", "")), n


_NUMBER = regex.compile(NUMBER_LINE)


def unique_blocks(blocks: DataFrame) -> DataFrame:
    """(block_id, file, page, block_type, role, content): each block once, those with text."""
    return blocks.dropDuplicates(["block_id"]).select("block_id", "file", "page", "block_type", "role", "content").where("content IS NOT NULL AND trim(content) <> ''")


def placed_blocks(blocks: DataFrame, chunk: int = 4096) -> DataFrame:
    """blocks with page_key (the page, or half a page after the last known one where it is null), top and bottom ranks.

    The last known page before a block and the places on a page are carried over chunks of block_ids, so a file or a page
    of any size is spread over tasks. A null file is one file.
    """
    b = blocks.select("block_id", "file", "page").withColumn("_c", F.floor(F.col("block_id") / chunk))  # the texts are joined once, at the end
    spread = b.groupBy("file", "_c").agg(F.max_by("page", F.when(F.col("page").isNotNull(), F.col("block_id"))).alias("last"))
    carry = spread.select("file", "_c", F.last("last", ignorenulls=True).over(Window.partitionBy("file").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    w = Window.partitionBy("file", "_c").orderBy("block_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = carry.toDF("_f", "_d", "before")
    b = b.withColumn("_seen", F.last("page", ignorenulls=True).over(w)).join(carry, F.col("file").eqNullSafe(F.col("_f")) & (F.col("_c") == F.col("_d")), "left").drop("_f", "_d")
    b = b.withColumn("page_key", F.coalesce(F.col("page").cast("double"), F.coalesce("_seen", "before", F.lit(0)) + 0.5)).drop("_seen", "before")
    # places on the page, counted within a chunk and over the chunks before and after
    part = Window.partitionBy("file", "page_key", "_c")
    b = b.withColumns({"_up": F.row_number().over(part.orderBy("block_id")), "_n": F.count("*").over(part)})
    page = Window.partitionBy("file", "page_key")
    sizes = b.where("_up = 1").select("file", "page_key", "_c", "_n")
    before = F.coalesce(F.sum("_n").over(page.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("file").alias("_f"), F.col("page_key").alias("_p"), F.col("_c").alias("_d"), before.alias("_before"), F.sum("_n").over(page).alias("_all"))
    b = b.join(sizes, F.col("file").eqNullSafe(F.col("_f")) & (F.col("page_key") == F.col("_p")) & (F.col("_c") == F.col("_d")))
    top = F.col("_before") + F.col("_up")
    places = b.select(F.col("block_id").alias("_id"), "page_key", top.cast("int").alias("top"), (F.col("_all") - top + 1).cast("int").alias("bottom"))
    return blocks.join(places, F.col("block_id").eqNullSafe(F.col("_id"))).drop("_id")


EDGE = "goes_on boolean, block_id long, file string, page int, page_key double, role string, block_type string, top int, bottom int, line_no int, place string, text string, key string, form string, number int"


def edge_lines(placed: DataFrame) -> DataFrame:
    """First and last line of every block but tables, with what tells furniture: see EDGE. place: only, first, last.

    key is how the line begins, since running headers may end in a figure or the section's name. A line of more than
    LONGEST characters is no furniture.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            d = b.to_pydict()
            for k in range(b.num_rows):
                lines = d["content"][k].split("\n")
                real = [i for i, x in enumerate(lines) if x.strip()]
                edge = set()
                if real:
                    # the outermost lines, and the one within where the outermost only numbers the page
                    edge = {real[0], real[-1]}
                    if len(real) > 1 and number_form(lines[real[0]]):
                        edge.add(real[1])
                    if len(real) > 1 and number_form(lines[real[-1]]):
                        edge.add(real[-2])
                    if len(real) > 1 and len(lines[real[0]].strip()) <= 90 and number_form(lines[real[1]]):
                        edge.add(real[1])
                for i in sorted(edge):
                    t = lines[i].strip()
                    if len(t) > LONGEST:
                        continue
                    f = number_form(t)
                    nxt = lines[i + 1].lstrip()[:1] if i + 1 < len(lines) else ""
                    out.append([nxt.islower() or nxt.isdigit() and t[-1:].islower() and not t[-1:] == ".", *[d[c][k] for c in ("block_id", "file", "page", "page_key", "role", "block_type", "top", "bottom")], i + 1, "only" if len(real) == 1 else "first" if i in real[:2] and i != real[-1] else "last", t, line_key(t)[:14], f[0] if f else None, f[1] if f else None])
            kinds = [pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=[x.split()[0] for x in EDGE.split(", ")])

    cols = placed.where(F.coalesce("block_type", F.lit("")) != "table").select(F.col("block_id").cast("long"), "file", F.col("page").cast("int"), "page_key", "role", "block_type", "top", "bottom", "content")
    return cols.mapInArrow(run, EDGE)


def with_evidence(edges: DataFrame) -> DataFrame:
    """edges with same_pages (pages of the file where such a line stands at an edge) and in_step (numbered as its page)."""
    head = edges.where("length(key) >= 3 AND top <= 3 AND place <> 'last'").groupBy("file", "key").agg(F.count_distinct("page_key").alias("same_pages"))
    pages = edges.groupBy("file").agg(F.count_distinct("page_key").alias("pages"))
    offset = (F.col("number") - F.col("page")).alias("off")
    steps = edges.where("form IS NOT NULL AND page IS NOT NULL").groupBy("file", "form", offset).agg(F.count_distinct("page_key").alias("n"))
    best = steps.groupBy("file").agg(F.max_by(F.struct("form", "off", "n"), F.struct("n", F.col("form"), -F.col("off"))).alias("best"))
    e = edges.join(head, ["file", "key"], "left").join(best, "file", "left").join(pages, "file", "left")
    near = F.when(F.col("page").isNotNull(), F.col("number") - F.col("page") == F.col("best.off")).otherwise(F.abs(F.col("number") - F.col("best.off") - F.col("page_key") - 0.5) <= 3)
    e = e.withColumn("in_step", F.coalesce(near & (F.col("form") == F.col("best.form")), F.lit(False)))
    return e.withColumns({"same_pages": F.coalesce("same_pages", F.lit(0)), "steps": F.coalesce("best.n", F.lit(0)), "share": F.coalesce(F.coalesce("same_pages", F.lit(0)) / F.col("pages"), F.lit(0.0))}).drop("best")


#: By how much the judge must prefer `header` for a line that only few pages of its file have.
SURE = 10.0
LABELS = ["text", "header", "page_number", "heading"]


def line_features(r: dict) -> list[str]:
    t = r["text"]
    low = fold(t)
    n = r["same_pages"]
    letters = [c for c in t if c.isalpha()]
    same = "0" if n == 0 else "1" if n == 1 else "2" if n == 2 else "3+"
    top = min(r["top"], 3)
    bot = min(r["bottom"], 3)
    end = t[-1:] if t[-1:] in ".,;:" else "no"
    shape = "up" if letters and all(c.isupper() for c in letters) else "title" if t[:1].isupper() else "low" if t[:1].islower() else "sym"
    num = "none" if r["form"] is None else "step" if r["in_step"] else "off"
    size = "s" if len(t) <= 12 else "m" if len(t) <= 70 else "l"
    share = "few" if r["share"] < 0.3 else "half" if r["share"] < 0.7 else "most"
    page1 = "p1" if (r["page"] or 2) == 1 else "p+"
    out = ["bias", f"pl{r['place']}", f"same{same}", f"top{top}", f"bot{bot}", f"end{end}", f"sh{shape}", f"num{num}", f"sz{size}", page1]
    out += [f"same{same}|top{top}|end{end}", f"num{num}|pl{r['place']}|steps{min(r['steps'], 3)}", f"num{num}|top{top}|bot{bot}", f"same{same}|pl{r['place']}|{shape}", f"sz{size}|end{end}|{shape}", f"same{same}|num{num}", f"same{same}|end{end}|sz{size}"]
    out += [f"share{share}|same{same}", f"share{share}|pl{r['place']}|end{end}"]
    out += [f"w{w}" for w in map(line_key, low.split()[:3]) if w]
    if r["place"] == "first":
        out.append(f"on{r['goes_on']}")
        out.append(f"on{r['goes_on']}|{shape}|end{end}")
    if "    " in t or " · " in t or " | " in t or " — " in t:
        out.append("gap")
    return out


def train_line_judge(evidence: DataFrame, max_lines: int = 6000) -> Perceptron:
    """From lines whose role tells what they are, and text lines of some length, a bounded sample of each by hash."""
    say = F.when(F.col("role") == "pageHeader", "header").when(F.col("role") == "pageNumber", "page_number").when(F.col("role").isin("sectionHeading", "title"), "heading")
    # a line of text: wrapped within its block or ended by a full stop, and neither repeated nor numbering
    plain = (F.length("text") > 30) & F.col("form").isNull() & (F.col("same_pages") <= 1) & F.col("place").isin("first", "last") & ((F.col("place") == "last") | F.col("text").rlike(r"[\p{Ll},]$"))
    odd = F.col("form").isNotNull() & ~F.col("in_step") & (F.col("steps") >= 3) & (F.col("place") == "last") & (F.length("text") > 1) & F.lit(False)
    lab = F.coalesce(F.when(F.col("place") == "only", say), F.when(F.coalesce("role", F.lit("")) == "", F.when(plain | odd, "text")))
    rows = evidence.withColumn("lab", lab).where("lab IS NOT NULL").withColumn("h", F.xxhash64("block_id", "line_no"))
    got = []
    for x in LABELS:
        got += rows.where(F.col("lab") == x).orderBy("h").limit(max_lines // 4).collect()
    data = []
    for r in got:
        d = r.asDict()
        data.append((line_features(d), LABELS, d["lab"]))
        # headers and numbers also stand on the first or last line of a block of text
        if d["lab"] in ("header", "page_number"):
            for place in ("first", "last") if d["lab"] == "page_number" else ("first",):
                data.append((line_features(d | {"place": place, "goes_on": False}), LABELS, d["lab"]))
    return Perceptron.fit(data, 5) if data else Perceptron()


def furniture(evidence: DataFrame, judge: Perceptron) -> DataFrame:
    """(block_id, line_no, kind): headers and page numbers. A number out of step or a lone line must be told by its role."""
    sent = evidence.sparkSession.sparkContext.broadcast(judge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for b in batches:
            out = []
            for r in b.to_pylist():
                s = p.score(line_features(r), LABELS)
                lab = max(LABELS, key=lambda x: (s[x], x == "text"))
                role = r["role"] or ""
                if lab == "page_number" and (r["form"] is None or not (r["in_step"] or role == "pageNumber")):
                    lab = "text"
                if lab == "header" and (r["form"] is not None or r["place"] == "first" and r["goes_on"]):
                    lab = "text"
                if r["form"] is not None and r["in_step"] and r["steps"] >= 2:
                    lab = "page_number"
                if lab == "header" and (r["same_pages"] < 2 and role != "pageHeader" and r["place"] != "only" and s["header"] - s["text"] < 1.0):
                    lab = "text"
                if lab == "header" and r["place"] == "first" and not role and r["share"] < 0.3 and s["header"] - s["text"] < SURE:
                    lab = "text"
                if role == "sectionHeading":
                    lab = "heading"
                if lab in ("header", "page_number"):
                    out.append((r["block_id"], r["line_no"], lab))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.string())], names=["block_id", "line_no", "kind"])

    return evidence.select("block_id", "line_no", "goes_on", "role", "place", "text", "form", "number", "top", "bottom", "same_pages", "share", "in_step", "steps", "page").mapInArrow(run, "block_id long, line_no int, kind string")


# ------------------------------------------------------------------ words

WORDS = "block_id long, line_no int, kind string, word string, rest string"


def block_words(blocks: DataFrame) -> DataFrame:
    """WORDS: each word of each line (kind word), and each word divided over two lines (kind hyphen, rest its second part).

    blocks: block_id, content, skip (line numbers of furniture). Figures without a letter are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                out = []
                for bid, content, skip in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    skip = set(skip or ())
                    lines = [x.rstrip() for x in content.split("\n")]
                    eaten = False
                    for i, line in enumerate(lines):
                        if i + 1 in skip:
                            continue
                        toks = TOKEN.findall(line)
                        if eaten and toks:
                            toks = toks[1:]
                        eaten = False
                        if toks and toks[-1][-1] in MARKS and len(toks[-1]) > 1:
                            j = i + 1
                            nxt = TOKEN.findall(lines[j]) if j < len(lines) and j + 1 not in skip else []
                            left = toks[-1][:-1].lstrip(LEAD)
                            right = core("x" + nxt[0])[0][1:] if nxt else ""
                            if left and right and left[-1].isalnum() and not NUMERIC.fullmatch(right):
                                out.append((bid, i + 1, "hyphen", left, right))
                                toks = toks[:-1]
                                eaten = True
                        for t in toks:
                            w, _ = core(t)
                            if w and not NUMERIC.fullmatch(w):
                                out.append((bid, i + 1, "word", w, None))
                            elif w:
                                out.append((bid, i + 1, "figure", word_key(w), None))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], names=["block_id", "line_no", "kind", "word", "rest"])

    return blocks.select("block_id", "content", "skip").mapInArrow(run, WORDS)


#: Longer words are judged by single edits only; tokens longer than LONGEST are no words of a language.
LONG, LONGEST = 60, 200


def proposals(types: DataFrame, editor: Editor) -> DataFrame:
    """(word, cand, key, gain, edits, n_word): what the editor proposes for each distinct word, all single edits included."""
    sent = types.sparkSession.sparkContext.broadcast(editor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                w, c, k, g, d, n = [], [], [], [], [], []
                for word, cnt in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if len(word) > LONGEST:
                        continue
                    got = e.proposals(word, 2 if len(word) <= LONG else 1)
                    if not word[0].isalpha():  # a figure or sign has no case
                        got += [(x[0].upper() + x[1:], y, z) for x, y, z in got if x[0].islower() and len(x) > 1]
                    for x, y, z in got:
                        d.append(z)
                        w.append(word)
                        c.append(x)
                        k.append(word_key(x))
                        g.append(y)
                        n.append(cnt)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(c, pa.string()), pa.array(k, pa.string()), pa.array(g, pa.float64()), pa.array(d, pa.int32()), pa.array(n, pa.int64())], names=["word", "cand", "key", "gain", "edits", "n_word"])

    return types.select("word", "n").mapInArrow(run, "word string, cand string, key string, gain double, edits int, n_word long")


@dataclass
class Repair:
    """What was found: lines to drop, words to mend, divided words to join."""

    lines: DataFrame
    chars: DataFrame
    hyphens: DataFrame
    blocks: DataFrame

    def found(self) -> DataFrame:
        """(block_id, line_no, kind, fixed): all of it, one form."""
        a = self.lines.select("block_id", "line_no", "kind", F.lit("").alias("fixed"))
        b = self.chars.select("block_id", "line_no", F.lit("char").alias("kind"), "fixed")
        c = self.hyphens.select("block_id", "line_no", F.lit("hyphen").alias("kind"), "fixed")
        return a.unionByName(b).unionByName(c).distinct()


def find_noise(blocks: DataFrame, *, ratio: float = 10.0, least: int = 4, max_words: int = 4000, max_lines: int = 6000) -> Repair:
    """Everything that is wrong with the blocks: see Repair.

    Rows delivered twice count once. Null, empty and blank contents have nothing to find; a null page or file only
    weakens the evidence about lines. A word is misread if a proposal's word occurs at least `ratio` times as often, for
    each edit once more, and at least `least` times; two edits also need a word of eight letters.
    """
    once = cut(unique_blocks(blocks))
    evidence = cut(with_evidence(edge_lines(placed_blocks(once))))
    lines = cut(furniture(evidence, train_line_judge(evidence, max_lines)))
    skip = lines.groupBy("block_id").agg(F.collect_set("line_no").alias("skip"))  # at most two a block
    # read off the blocks anew wherever they are needed: cheaper than keeping a row for each word of the collection
    words = block_words(cut(once.join(skip, "block_id", "left")))
    counts = words.where("kind <> 'hyphen'").groupBy("word").agg(F.count("*").alias("n"))
    keyed = counts.select("word", "n", F.regexp_replace(F.lower("word"), r"\p{Nd}", "9").alias("key"))
    keys = keyed.groupBy("key").agg(F.sum("n").alias("n_key"))
    types = cut(keyed.join(keys, "key"))
    best = types.groupBy("key").agg(F.max("n_key").alias("n"), F.max_by("word", F.struct("n", "word")).alias("word")).orderBy(F.desc("n"), "word").limit(max_words).collect()
    editor = train_editor([(r["key"] if DIGITS.search(r["word"]) else r["word"], r["n"]) for r in best if r["n"] >= least])
    lexicon = types.select("key", "n_key").distinct()
    exact = types.select(F.col("word").alias("cand"), F.col("n").alias("n_exact"))

    def choose(props: DataFrame, by: list[str]) -> DataFrame:
        got = props.join(lexicon.withColumnRenamed("n_key", "n_cand"), "key").join(exact, "cand", "left")
        score = F.struct((F.log("n_cand") + F.col("gain") * 0.25 - 4.0 * F.col("edits")).alias("s"), F.coalesce("n_exact", F.lit(0)).alias("x"), F.col("cand").alias("cand"), F.col("n_cand").alias("n"))
        return got, score

    kind = types.where(~F.col("word").rlike(r"^[\p{Nd}.,:/%×+\-]*$"))
    got, score = choose(proposals(kind.select("word", F.col("n_key").alias("n")), editor), ["word"])
    word, cand = F.col("word"), F.col("cand")
    # letters and figures or signs mixed within a word are hardly ever right; everything else must be far rarer than the proposal
    odd = word.rlike(r"\p{L}") & word.rlike(r"[\p{Nd}@!]")
    figure = cand.rlike(r"^[\p{Nd}.,:/%×+\-]*$")
    enough = F.when(figure, F.when(word.rlike(r"\p{Nd}"), F.col("n_cand") >= F.col("n_word")).otherwise((F.length("word") == 1) & (F.col("n_cand") >= 300 * F.col("n_word"))))
    enough = enough.when(odd, F.col("n_cand") >= F.col("n_word"))
    enough = enough.otherwise((F.col("n_cand") >= least) & (F.col("n_cand") >= F.pow(F.lit(ratio), F.col("edits")) * F.col("n_word")) & ((F.col("edits") == 1) | (F.length("word") >= 4 * F.col("edits"))))
    got = got.where(enough)
    mended = cut(got.groupBy("word").agg(F.max(score).alias("b")).select("word", F.col("b.cand").alias("fixed")))
    chars = words.where("kind = 'word'").join(mended, "word").select("block_id", "line_no", "word", "fixed")
    hyphens = join_divided(words.where("kind = 'hyphen'"), editor, lexicon, exact)
    return Repair(lines, chars, hyphens, once)


def join_divided(parts: DataFrame, editor: Editor, lexicon: DataFrame, exact: DataFrame) -> DataFrame:
    """(block_id, line_no, word, rest, fixed): each divided word whole.

    Of the editor's two ways to join, and of what it proposes to mend in either, the one that the collection knows
    best; if it knows none, the editor's own choice.
    """
    sent = parts.sparkSession.sparkContext.broadcast(editor)
    distinct = parts.select("word", "rest").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = sent.value
        for b in batches:
            w, r, c, k, g = [], [], [], [], []
            for left, right in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for n, (x, y) in enumerate(e.joins(left, right)):
                    more = [(z, min(v, 0.0) - 8.0) for z, v, _ in e.proposals(x, 1)] if len(x) <= LONGEST else []
                    for z, v in [(x, max(y, -2.0)), *more]:
                        w.append(left)
                        r.append(right)
                        c.append(z)
                        k.append(word_key(z))
                        g.append(v - 0.01 * n)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(r, pa.string()), pa.array(c, pa.string()), pa.array(k, pa.string()), pa.array(g, pa.float64())], names=["word", "rest", "cand", "key", "gain"])

    props = distinct.mapInArrow(run, "word string, rest string, cand string, key string, gain double")
    got = props.join(lexicon.withColumnRenamed("n_key", "n_cand"), "key", "left").join(exact, "cand", "left")
    known = F.coalesce("n_cand", F.lit(0))
    score = F.struct((F.log(known + 0.05) + F.col("gain") * 0.5).alias("s"), F.coalesce("n_exact", F.lit(0)).alias("x"), F.col("cand").alias("cand"))
    best = got.groupBy("word", "rest").agg(F.max(score).alias("b")).select("word", "rest", F.col("b.cand").alias("fixed"))
    return parts.select("block_id", "line_no", "word", "rest").join(best, ["word", "rest"])


def paragraphs(r: Repair) -> DataFrame:
    """(block_id, text): each block as one continuous text, repaired; a block of furniture alone gives an empty text."""
    fix = r.chars.groupBy("block_id").agg(F.collect_set(F.struct("line_no", "word", "fixed")).alias("c"))
    hyp = r.hyphens.groupBy("block_id").agg(F.collect_set(F.struct("line_no", "word", "rest", "fixed")).alias("h"))
    drop = r.lines.groupBy("block_id").agg(F.collect_set("line_no").alias("d"))
    all_ = r.blocks.select("block_id", "content").join(fix, "block_id", "left").join(hyp, "block_id", "left").join(drop, "block_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                words = {(x["line_no"], x["word"]): x["fixed"] for x in row["c"] or ()}
                ends = {x["line_no"]: x for x in row["h"] or ()}
                gone = set(row["d"] or ())
                text: list[str] = []
                carry: str | None = None
                for i, line in enumerate(row["content"].split("\n"), 1):
                    if i in gone:
                        continue
                    toks = TOKEN.findall(line)
                    if carry is not None and toks:
                        w = core("x" + toks[0])[0][1:]
                        toks[0] = toks[0].replace(w, carry, 1) if w else carry + toks[0]
                        carry = None
                        text.append(toks.pop(0))
                    if i in ends and toks:
                        carry = ends[i]["fixed"]
                        last = toks.pop()
                        pre = last[: len(last) - len(last.lstrip(LEAD))]
                        carry = pre + carry
                    for t in toks:
                        w, a = core(t)
                        f = words.get((i, w))
                        text.append(t if f is None else t[:a] + f + t[a + len(w) :])
                if carry is not None:
                    text.append(carry)
                out.append((row["block_id"], " ".join(text)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["block_id", "text"])

    return all_.mapInArrow(run, "block_id long, text string")
