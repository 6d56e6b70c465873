"""Problem 1: which sentences of two pages translate each other.

Method: the sentences of the target page are emissions of a hidden Markov model whose states are the sentences of the
source page, spans of two neighbouring ones (for sentences joined in the target), and a null state for sentences
without a counterpart. Jumps between states have learned chances, so a sentence that stands elsewhere costs a longer
jump; a state that emits twice is a sentence divided in the target. What a state emits is judged by a word translation
table with a null word, learned by expectation maximisation from the pages themselves: the first round aligns by
figures, names and shared beginnings of words, each later one by the table of the round before.

Figures and names translate to themselves. Where both sentences hold one that the other lacks they contradict each
other; a figure that only one of them holds is an addition.

The table is trained on all page pairs and holds pairs of at least `least` weight and 0.001 chance. It stays in Spark: a
small one is sent to every task, of a larger one each block of pages gets what its own words need. All page pairs are
decoded, each within one row that holds no more than its two pages; long ones with their scores in tiles.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.llm.features import fold
from folium.session import cut, lowest

TOKEN = regex.compile(r"\p{N}+(?:[.,:  ]\p{N}+)*|\p{L}[\p{L}\p{M}]*")
CUTS = regex.compile(r"[,;:()\[\]«»–—]")
NULL = "∅"
JUMPS = 6
#: What a contradiction costs, in log-likelihood.
CLASH = 40.0
#: What a word costs that lacks a counterpart it nearly always has, if the other side lacks one too; twice at most.
LONE = 15.0
#: A clause that lacks its counterpart at least so often may come and go.
LOOSE = 0.04
#: Pages of more sentences are scored in tiles.
LONG = 1000


def clauses(text: str, names: frozenset[str] | set[str] = frozenset()) -> list[list[str]]:
    """The tokens of text, divided at commas, colons, semicolons and brackets."""
    out: list[list[str]] = [[]]
    last = 0
    for m in TOKEN.finditer(text):
        if out[-1] and CUTS.search(text, last, m.start()):
            out.append([])
        out[-1] += tokens(m.group(), names)
        last = m.end()
    return out


def pattern(clause: list[str]) -> str:
    """A clause with its figures and names left open."""
    return " ".join(w[0] if _special(w) else w for w in clause)


def tokens(text: str, names: frozenset[str] | set[str] = frozenset()) -> list[str]:
    """Words folded; figures as #digits (a full hour as its hour), names as @name."""
    out = []
    for w in TOKEN.findall(text):
        if w[0].isnumeric():
            if ":" in w and w.endswith(":00"):
                w = w[:-3]
            out.append("#" + "".join(c for c in w if c.isnumeric()))
        elif w in names:
            out.append("@" + fold(w))
        else:
            out.append(fold(w))
    return out


def page_names(texts: list[str]) -> set[str]:
    """Words that stand capitalised within a sentence, all-capital ones and codes aside."""
    out: set[str] = set()
    for t in texts:
        for k, w in enumerate(TOKEN.findall(t)):
            if k and len(w) > 2 and w[0].isupper() and w[1:].islower():
                out.add(w)
    return out


class Table:
    """t(e|s) and t(s|e) of word pairs, in rows of arrays by source word."""

    def __init__(self, entries: list[tuple[str, str, float, float]] = ()):
        """entries: (s, e, t(e|s), t(s|e))."""
        self.source: dict[str, int] = {}
        self.target: dict[str, int] = {}
        s = np.array([self.source.setdefault(x[0], len(self.source)) for x in entries], dtype=np.int32)
        e = np.array([self.target.setdefault(x[1], len(self.target)) for x in entries], dtype=np.int32)
        order = np.argsort(s, kind="stable")
        self.e, self.f, self.b = e[order], np.array([x[2] for x in entries])[order], np.array([x[3] for x in entries])[order]
        self.at = np.searchsorted(s[order], np.arange(len(self.source) + 1))
        self.column = np.full(len(self.target), -1, dtype=np.int32)  # scratch: which of the wanted words a target word is

    def part(self, ws: Iterable[str], es: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """(len(ws), len(es)): both chances; 0 for pairs that aren't held. ws and es are each distinct."""
        ws, es = list(ws), list(es)
        f, b = np.zeros((len(ws), len(es))), np.zeros((len(ws), len(es)))
        rows = [(k, n) for k, w in enumerate(ws) if (n := self.source.get(w)) is not None]
        cols = [(k, n) for k, e in enumerate(es) if (n := self.target.get(e)) is not None]
        if rows and cols:
            a, n = np.array(rows).T
            c, m = np.array(cols).T
            size = self.at[n + 1] - self.at[n]
            flat = np.arange(size.sum()) + np.repeat(self.at[n] - np.r_[0, np.cumsum(size)[:-1]], size)
            self.column[m] = c
            to = self.column[self.e[flat]]
            self.column[m] = -1
            here = to >= 0
            row, to, flat = np.repeat(a, size)[here], to[here], flat[here]
            f[row, to], b[row, to] = self.f[flat], self.b[flat]
        return f, b


@dataclass
class Model:
    """table: chances of word pairs; null[e] = t(e|null); bg_*: shares of the words; jump: log chance by distance."""

    table: Table = field(default_factory=Table)
    null: dict[str, float] = field(default_factory=dict)
    bg_e: dict[str, float] = field(default_factory=dict)
    bg_s: dict[str, float] = field(default_factory=dict)
    jump: np.ndarray | None = None
    #: Clauses that come and go between the languages, and how often each word finds its counterpart.
    loose: frozenset[str] = frozenset()
    rate_s: dict[str, float] = field(default_factory=dict)
    rate_e: dict[str, float] = field(default_factory=dict)
    trained: bool = False


def default_jumps() -> np.ndarray:
    """Log chances of the jumps -JUMPS to JUMPS, before anything is learned: mostly one ahead."""
    p = np.array([0.01 * 0.7 ** (abs(d) - 1) if d < 0 else 0.12 if d == 0 else 0.6 if d == 1 else 0.12 * 0.5 ** (d - 2) for d in range(-JUMPS, JUMPS + 1)])
    return np.log(p / p.sum())


def _special(w: str) -> bool:
    return w[0] in "#@"


@dataclass
class Scores:
    """emit (states, J): log-likelihood ratio to the null state, of single sentences and then of spans."""

    emit: np.ndarray
    n_single: int


def marked(es: list[str], eu: list[str]) -> tuple[list[str], list[str]]:
    """The sentences of two pages as their tokens, with blanks between, and tabs between clauses."""
    names = page_names(es) | page_names(eu)
    return tuple(["\t".join(" ".join(c) for c in clauses(t, names)) for t in page] for page in (es, eu))


def parts_of(sentence: str) -> list[list[str]]:
    """The clauses of a marked sentence."""
    return [c.split(" ") if c else [] for c in sentence.split("\t")]


class Pages:
    """Two pages, marked, as word matrices."""

    def __init__(self, es: list[str], eu: list[str], m: Model, place: tuple[int, int, int, int] | None = None):
        """place: where es and eu begin in their pages and how long those are, if they are parts of them."""
        self.place = place or (0, len(es), 0, len(eu))
        self._divide(es, eu, m)
        self.sv = {w: k for k, w in enumerate(dict.fromkeys(w for s in self.S for w in s))}
        self.ev = {w: k for k, w in enumerate(dict.fromkeys(w for s in self.E for w in s))}
        self.M_s = self._counts(self.S, self.sv)
        self.M_e = self._counts(self.E, self.ev)
        self.K_s = self._counts([[w for c, q in zip(x, y, strict=True) if q not in m.loose for w in c] for x, y in zip(self.CS, self.QS, strict=True)], self.sv)
        self.K_e = self._counts([[w for c, q in zip(x, y, strict=True) if q not in m.loose for w in c] for x, y in zip(self.CE, self.QE, strict=True)], self.ev)
        self.sp_s = np.array([_special(w) for w in self.sv], dtype=bool)
        self.sp_e = np.array([_special(w) for w in self.ev], dtype=bool)
        self.same = np.zeros((len(self.sv), len(self.ev)), dtype=bool)
        for w, a in self.sv.items():
            b = self.ev.get(w)
            if b is not None:
                self.same[a, b] = True

    def _divide(self, es: list[str], eu: list[str], m: Model) -> None:
        """Clauses, their patterns, and the words of each sentence."""
        self.m = m
        self.CS, self.CE = [parts_of(t) for t in es], [parts_of(t) for t in eu]
        self.QS, self.QE = [[pattern(c) for c in x] for x in self.CS], [[pattern(c) for c in x] for x in self.CE]
        self.S, self.E = [[w for c in x for w in c] for x in self.CS], [[w for c in x for w in c] for x in self.CE]

    @staticmethod
    def _counts(rows: list[list[str]], vocab: dict[str, int]) -> np.ndarray:
        out = np.zeros((len(rows), len(vocab)))
        for i, r in enumerate(rows):
            for w in r:
                out[i, vocab[w]] += 1
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """t(e|s), t(s|e) over the pages' words, and t(e|null)."""
        m, ev = self.m, self.ev
        f, b = m.table.part(self.sv, ev)
        self.learned = f.copy()
        eq = self.same & (self.sp_s[:, None] | (not m.table.source))
        f[eq] = 0.9
        b[eq] = 0.9
        unknown = np.array([w not in m.table.source for w in self.sv])
        eq = self.same & unknown[:, None]
        f[eq] = 0.5
        b[eq] = 0.5
        n = np.zeros(len(ev))
        for e, k in ev.items():
            n[k] = m.null.get("#" if e[0] == "#" else "@" if e[0] == "@" else e, 1e-5)
        return f, b, n

    def conflicts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(I, J): figures and names in common, those only in the source, those only in the target; loose clauses aside."""
        a, b = np.minimum(self.M_s[:, self.sp_s], 1), np.minimum(self.M_e[:, self.sp_e], 1)
        eq = self.same[np.ix_(self.sp_s, self.sp_e)].astype(float)
        both = a @ eq @ b.T
        ka, kb = np.minimum(self.K_s[:, self.sp_s], 1), np.minimum(self.K_e[:, self.sp_e], 1)
        return both, ka.sum(1)[:, None] - ka @ eq @ b.T, kb.sum(1)[None, :] - a @ eq @ kb.T

    def scores(self) -> np.ndarray:
        """(I, J) log-likelihood ratio of the target sentence given the source sentence, both ways averaged."""
        m = self.m
        both, lone_s, lone_e = self.conflicts()
        clash = np.minimum(lone_s, lone_e)
        I, J = len(self.S), len(self.E)
        if not m.trained:
            pre_s = [{w[:5] for w in s if len(w) > 4} for s in self.S]
            pre_e = [{w[:5] for w in s if len(w) > 4} for s in self.E]
            cog = np.array([[len(x & y) for y in pre_e] for x in pre_s], dtype=float).reshape(I, J)
            i0, n_i, j0, n_j = self.place
            pos = np.abs((i0 + np.arange(I)[:, None] + 0.5) / max(n_i, 1) - (j0 + np.arange(J)[None, :] + 0.5) / max(n_j, 1))
            return 4 * both + 2 * cog - 6 * clash - 6 * pos - 1.5
        f, b, null = self.tables()
        n_s, n_e = np.maximum(self.M_s.sum(1), 1), np.maximum(self.M_e.sum(1), 1)
        bg_e = np.array([m.bg_e.get("#" if w[0] == "#" else "@" if w[0] == "@" else w, 2e-5) * (0.02 if _special(w) else 1) for w in self.ev])
        bg_s = np.array([m.bg_s.get("#" if w[0] == "#" else "@" if w[0] == "@" else w, 2e-5) * (0.02 if _special(w) else 1) for w in self.sv])
        self.P = ((self.M_s @ f) / (n_s + 1)[:, None] + null[None, :] / (n_s + 1)[:, None])
        lr_e = np.log((self.P + 3e-3 * bg_e) / bg_e)
        own_e = np.log(((self.M_s @ f) / (n_s + 1)[:, None] + 3e-3 * bg_e) / bg_e)  # the null word aside
        fwd = np.clip(lr_e, -5, 5) @ self.M_e.T
        Q = (self.M_e @ b.T) / (n_e + 1)[:, None]
        lr_s = np.clip(np.log((Q + 3e-3 * bg_s) / bg_s), -5, 5)
        bwd = lr_s @ self.M_s.T  # (J, I)
        self.fwd, self.bwd = fwd / n_e[None, :], (bwd.T / n_s[:, None])
        hit_e = ((own_e > 0.5).astype(float) @ self.M_e.T) / n_e[None, :]
        hit_s = (((lr_s > 0.5).astype(float)) @ self.M_s.T).T / n_s[:, None]
        self.hit_e, self.hit_s = hit_e, hit_s
        self.bg_e, self.lr_e, self.lr_s = bg_e, own_e, lr_s
        # words that nearly always find their counterpart and don't here, on both sides: another matter in the same words
        firm_s = np.array([not _special(w) and m.rate_s.get(w, 0.0) >= 0.8 for w in self.sv], dtype=float)
        firm_e = np.array([not _special(w) and m.rate_e.get(w, 0.0) >= 0.8 for w in self.ev], dtype=float)
        self.lone_s = ((lr_s <= 0) * firm_s[None, :]) @ np.minimum(self.K_s, 1).T  # (J, I)
        self.lone_e = ((own_e <= 0) * firm_e[None, :]) @ np.minimum(self.K_e, 1).T  # (I, J)
        return fwd - CLASH * clash - LONE * np.minimum(np.minimum(self.lone_s.T, self.lone_e), 2)

    def emissions(self) -> Scores:
        """Scores of all states. A span's words are each explained by the better of its two sentences."""
        one = self.scores()
        I = len(self.S)
        if I < 2:
            return Scores(one, I)
        if not self.m.trained:
            return Scores(np.concatenate([one, np.full((I - 1, len(self.E)), -50.0)]), I)
        both = np.maximum(self.P[:-1], self.P[1:]) * 0.5
        fwd = np.clip(np.log((both + 3e-3 * self.bg_e) / self.bg_e), -5, 5) @ self.M_e.T
        eq = self.same[np.ix_(self.sp_s, self.sp_e)].astype(float)
        a, k = np.minimum(self.M_s[:, self.sp_s], 1), np.minimum(self.K_s[:, self.sp_s], 1)
        ab, kab = np.maximum(a[:-1], a[1:]), np.maximum(k[:-1], k[1:])
        e, ke = np.minimum(self.M_e[:, self.sp_e], 1), np.minimum(self.K_e[:, self.sp_e], 1)
        clash = np.minimum(kab.sum(1)[:, None] - kab @ eq @ e.T, ke.sum(1)[None, :] - ab @ eq @ ke.T)
        span = fwd - CLASH * clash
        # joined sentences both give something of their own
        least = np.minimum(self.hit_s[:-1], self.hit_s[1:])
        span = np.where(least >= 0.45, span, -1e9)
        return Scores(np.concatenate([one, span]), I)

    def decode(self, null_per_word: float = 1.2) -> list[tuple[int, int, float]]:
        """(source, target, score) of the best state sequence, spans as a pair for each of their sentences."""
        I, J = len(self.S), len(self.E)
        if not I or not J:
            return []
        sc = self.emissions()
        emit, S = sc.emit, sc.emit.shape[0]
        n_e = np.maximum(self.M_e.sum(1), 1)
        null = null_per_word * n_e if self.m.trained else np.zeros(J)
        first = np.r_[np.arange(I), np.arange(S - I)]
        last = np.r_[np.arange(I), np.arange(1, S - I + 1)]
        jump = self.m.jump if self.m.jump is not None else default_jumps()
        d = first[None, :] - last[:, None]  # from state a's end to state b's beginning
        far = np.log(0.5) * np.minimum(np.maximum(np.abs(d) - JUMPS, 0), 4)
        trans = jump[np.clip(d, -JUMPS, JUMPS) + JUMPS] + far
        # null keeps the place: state S + a is null after a, state 2S null before anything
        best = np.full((J, 2 * S + 1), -np.inf)
        back = np.zeros((J, 2 * S + 1), dtype=np.int32)
        start = np.log(0.5) * np.minimum(first, 6)
        best[0, :S] = start + emit[:, 0]
        back[0] = -1
        best[0, 2 * S] = null[0] - 1.5
        for j in range(1, J):
            prev = np.maximum(best[j - 1, :S], best[j - 1, S : 2 * S])
            who = np.where(best[j - 1, :S] >= best[j - 1, S : 2 * S], np.arange(S), np.arange(S) + S)
            t = prev[:, None] + trans
            k = t.argmax(0)
            v = t[k, np.arange(S)]
            v0 = best[j - 1, 2 * S] + start
            use0 = v0 > v
            best[j, :S] = np.where(use0, v0, v) + emit[:, j]
            back[j, :S] = np.where(use0, 2 * S, who[k])
            best[j, S : 2 * S] = prev + null[j] - 1.5
            back[j, S : 2 * S] = who
            best[j, 2 * S] = best[j - 1, 2 * S] + null[j] - 1.5
            back[j, 2 * S] = 2 * S
        state = int(best[J - 1].argmax())
        out = []
        for j in range(J - 1, -1, -1):
            if state < S:
                sc_j = float(emit[state, j] / n_e[j])
                out += [(i, j, sc_j) for i in range(first[state], last[state] + 1)]
            state = int(back[j, state])
        return out[::-1]

    def hit(self, i: int, j: int) -> float:
        """The share of words explained, on the side where it's larger; after decoding by a trained model."""
        return max(self.hit_e[i, j], self.hit_s[i, j])

    def gain_e(self, src: list[int], j: int) -> tuple[np.ndarray, dict[str, int]]:
        """What sentences src of the source say for each word of the target, and the words' numbers."""
        return self.lr_e[src].max(0), self.ev

    def gain_s(self, i: int, js: list[int]) -> tuple[np.ndarray, dict[str, int]]:
        return self.lr_s[js].max(0), self.sv

    def counts(self, pairs: list[tuple[int, int, float]], out: Counter | None = None) -> Counter:
        """Expected counts, added to out: words of aligned sentences by the current table, words of the pages, jumps."""
        out = Counter() if out is None else out
        if self.place[2] == 0:  # the source stands beside each window of the target, and counts once
            for w, n in Counter(chain.from_iterable(self.S)).items():
                out["R", w[0] if _special(w) else w, ""] += n
        for w, n in Counter(chain.from_iterable(self.E)).items():
            out["B", "", w[0] if _special(w) else w] += n
        by: dict[int, list[int]] = defaultdict(list)
        for i, j, _ in pairs:
            by[j].append(i)
        null = self.m.null
        for j, src in by.items():
            ws = [w for i in src for w in self.S[i]]
            plain = list(dict.fromkeys(w for w in ws if not _special(w)))
            special = {w for w in ws if _special(w)}
            for e in self.E[j]:
                if _special(e) and e not in special:
                    out["L", NULL, e[0]] += 1
            es = [e for e in self.E[j] if not _special(e)]
            if self.m.trained and es:
                p = self.chances(plain, es)
                q = np.array([null.get(e, 1e-6) for e in es])
                z = p.sum(0) + q
                a, b = np.nonzero(p > 0.01 * z)
                for w, e, x in zip(a.tolist(), b.tolist(), (p[a, b] / z[b]).tolist(), strict=True):
                    out["L", plain[w], es[e]] += x
                for e, x in zip(es, (q / z).tolist(), strict=True):
                    out["L", NULL, e] += x
            else:
                for e in es:
                    for w in plain:
                        out["L", w, e] += 1 / (len(plain) + 1)
                    out["L", NULL, e] += 1 / (len(plain) + 1)
        if self.m.trained:
            for j, src in by.items():
                self._matches(out, self.CE[j], self.QE[j], [w for i in src for w in self.S[i]], *self.gain_e(src, j), "e")
            tgt: dict[int, list[int]] = defaultdict(list)
            for i, j, _ in pairs:
                tgt[i].append(j)
            for i, js in tgt.items():
                self._matches(out, self.CS[i], self.QS[i], [w for j in js for w in self.E[j]], *self.gain_s(i, js), "s")
        last = None
        for j in sorted(by):
            a, b = min(by[j]), max(by[j])
            if last is not None:
                out["J", "", str(int(np.clip(a - last, -JUMPS, JUMPS)))] += 1
            last = b
        return out

    def chances(self, ws: list[str], es: list[str]) -> np.ndarray:
        """t(e|w) of the learned table, a little where it has none."""
        return np.maximum(self.learned[[[self.sv[w]] for w in ws], [self.ev[e] for e in es]], 1e-6) if ws else np.zeros((0, len(es)))

    @staticmethod
    def _matches(out: Counter, parts: list[list[str]], patterns: list[str], other: list[str], lr: np.ndarray, vocab: dict[str, int], side: str) -> None:
        """How often words and clauses of an aligned sentence find a counterpart in the other one."""
        there, ok = set(other), (lr > 0.5).tolist()
        for c, q in zip(parts, patterns, strict=True):
            hits = [(w in there) if _special(w) else ok[vocab[w]] for w in c]
            for w, h in zip(c, hits, strict=True):
                if not _special(w):
                    out["W" + side, w, "1" if h else "0"] += 1
            special = [h for w, h in zip(c, hits, strict=True) if _special(w)]
            lost = not any(special) if special else sum(hits) < 0.34 * len(hits)
            out["C", q, "0" if lost else "1"] += 1


class LongPages(Pages):
    """Pages of any length, with the same result: scores are taken in tiles, and only states that can still win are kept.

    A state can still win if it's no further behind the best one than the jumps can differ. Memory is that of one strip
    of scores (all states, some targets), and of the few kept states of each target.
    """

    def __init__(self, es: list[str], eu: list[str], m: Model, place: tuple[int, int, int, int] | None = None, tile: int = 500, cells: int = 12_000_000):
        self.es, self.eu, self.place, self.tile, self.cells = es, eu, place or (0, len(es), 0, len(eu)), tile, cells
        self._divide(es, eu, m)

    def _part(self, src: list[int], js: list[int]) -> Pages:
        p = Pages([self.es[i] for i in src], [self.eu[j] for j in js], self.m)
        p.scores()
        return p

    def hit(self, i: int, j: int) -> float:
        return self._part([i], [j]).hit(0, 0)

    def gain_e(self, src: list[int], j: int) -> tuple[np.ndarray, dict[str, int]]:
        p = self._part(src, [j])
        return p.gain_e(list(range(len(src))), 0)

    def gain_s(self, i: int, js: list[int]) -> tuple[np.ndarray, dict[str, int]]:
        p = self._part([i], js)
        return p.gain_s(0, list(range(len(js))))

    def chances(self, ws: list[str], es: list[str]) -> np.ndarray:
        one = list(dict.fromkeys(es))
        at = {e: k for k, e in enumerate(one)}
        return np.maximum(self.m.table.part(ws, one)[0][:, [at[e] for e in es]], 1e-6)

    def strip(self, j0: int, j1: int) -> np.ndarray:
        """Scores of all states for targets j0 to j1. Tiles share a sentence, for the span over their border."""
        I = len(self.es)
        out = np.empty((max(2 * I - 1, 1), j1 - j0))
        for i0 in range(0, max(I - 1, 1), self.tile):
            i1 = min(i0 + self.tile + 1, I)
            place = (self.place[0] + i0, self.place[1], self.place[2] + j0, self.place[3])
            sc = Pages(self.es[i0:i1], self.eu[j0:j1], self.m, place).emissions()
            out[i0:i1] = sc.emit[: sc.n_single]
            out[I + i0 : I + i1 - 1] = sc.emit[sc.n_single :]
        return out

    def decode(self, null_per_word: float = 1.2) -> list[tuple[int, int, float]]:
        I, J = len(self.S), len(self.E)
        if not I or not J:
            return []
        S = max(2 * I - 1, 1)
        n_e = np.maximum([len(x) for x in self.E], 1)
        null = null_per_word * n_e if self.m.trained else np.zeros(J)
        first, last = np.r_[np.arange(I), np.arange(S - I)], np.r_[np.arange(I), np.arange(1, S - I + 1)]
        jump = self.m.jump if self.m.jump is not None else default_jumps()
        start = np.log(0.5) * np.minimum(first, 6)
        apart = np.max([*jump, 0.0]) - np.min([*(jump + 4 * np.log(0.5)), 6 * np.log(0.5)]) + 1e-6
        # no state that scores less than this behind the null state can win, whatever the jumps to and from it
        behind = -1.5 - apart - max([*jump, 0.0])
        strip = max(1, min(self.tile, self.cells // S))
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # states (as in Pages), whence, scores where they emit
        score = np.empty(0)
        for j in range(J):
            if j % strip == 0:
                emit = self.strip(j, min(j + strip, J))
            e = emit[:, j % strip]
            if not j:
                state, whence = np.r_[np.arange(S), 2 * S], np.full(S + 1, -1)
                score = np.r_[start + e, null[0] - 1.5]
            else:
                old = kept[-1][0]
                at = {int(s): k for k, s in enumerate(old)}
                real = old[old < 2 * S] % S
                places = np.unique(real)
                here = np.array([score[at[s]] if s in at else -np.inf for s in places.tolist()])
                gone = np.array([score[at[s + S]] if s + S in at else -np.inf for s in places.tolist()])
                prev, who = np.maximum(here, gone), np.where(here >= gone, places, places + S)
                can = np.flatnonzero(e >= null[j] + behind)
                v, k = np.full(len(can), -np.inf), np.full(len(can), 2 * S)
                for a in range(len(places)):
                    d = first[can] - last[places[a]]
                    t = prev[a] + jump[np.clip(d, -JUMPS, JUMPS) + JUMPS] + np.log(0.5) * np.minimum(np.maximum(np.abs(d) - JUMPS, 0), 4)
                    more = t > v
                    v[more], k[more] = t[more], who[a]
                none = score[at[2 * S]] if 2 * S in at else -np.inf
                use0 = none + start[can] > v
                v, k = np.where(use0, none + start[can], v), np.where(use0, 2 * S, k)
                state, whence = np.r_[can, places + S, 2 * S], np.r_[k, who, 2 * S]
                score = np.r_[v + e[can], prev + null[j] - 1.5, none + null[j] - 1.5]
            keep = score >= score.max() - apart
            state, whence, score = state[keep], whence[keep], score[keep]
            kept.append((state, whence, e[state[state < S]]))
        s, out = int(kept[-1][0][score.argmax()]), []
        for j in range(J - 1, -1, -1):
            state, whence, got = kept[j]
            k = int(np.searchsorted(state, s))
            if s < S:
                out += [(i, j, float(got[k] / n_e[j])) for i in range(first[s], last[s] + 1)]
            s = int(whence[k])
        return out[::-1]


def pages_of(es: list[str], eu: list[str], m: Model, at: int = 0, of: int | None = None) -> Pages:
    """Two marked pages; eu may be a window of a page of `of` sentences that begins at `at`."""
    place = (0, len(es), at, len(eu) if of is None else of)
    return (LongPages if max(len(es), len(eu)) > LONG else Pages)(es, eu, m, place)


def page_pairs(index: DataFrame, sentences: DataFrame, es_col: str = "url_es", eu_col: str = "url_eu", window: int = 1000) -> DataFrame:
    """(pair, es_ids, es, eu_ids, eu, at, of): the sentences of both pages of a bulletin in reading order.

    Pairs of pages listed more than once count once; pages that are null or paired with themselves have no pair. A
    sentence delivered more than once counts once; null and blank sentences are left out; blanks are made single.

    A target page of more than `window` sentences comes in several rows, so that its decoding is shared out: each has a
    window of the target, which begins at `at` of its `of` sentences, beside the whole source page. So each sentence of
    one page meets each of the other, however far away it stands.
    """
    pages = index.select(F.col(es_col).alias("u"), F.col(eu_col).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    pages = pages.select(F.xxhash64("u", "v").alias("pair"), "u", "v")
    text = F.trim(F.regexp_replace("content", r"(?U)[\s\x{200b}\x{feff}]+", " "))
    s = sentences.dropDuplicates(["sent_id"]).select("sent_id", "url", "language", "para_no", "sent_no", text.alias("t")).where("t <> ''")
    sides = pages.select("pair", "u", "v", F.explode(F.array(F.struct(F.col("u").alias("url"), F.lit("es").alias("language")), F.struct(F.col("v").alias("url"), F.lit("eu").alias("language")))).alias("x")).select("pair", "u", "v", "x.*")
    rows = sides.join(s, ["url", "language"])
    size = rows.groupBy("pair").agg(F.count(F.when(F.col("language") == "es", 1)).alias("n_es"), F.count(F.when(F.col("language") == "eu", 1)).alias("n_eu"))
    parts = F.ceil(F.col("n_eu") / window)
    rows = rows.join(size, "pair").where("n_es > 0 AND n_eu > 0")
    whole = rows.where(F.col("n_eu") <= window).withColumn("part", F.lit(0).cast("long"))
    long = rows.where(F.col("n_eu") > window)
    place = F.row_number().over(Window.partitionBy("pair", "language").orderBy("para_no", "sent_no", "sent_id")) - 1
    spread = F.when(F.col("language") == "eu", F.array(F.floor(F.col("at") / window))).otherwise(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))
    long = long.withColumn("at", place).withColumn("part", F.explode(spread)).drop("at")
    rows = whole.unionByName(long)
    one = F.struct("para_no", "sent_no", "sent_id", "t")
    got = rows.groupBy("pair", "u", "v", "part", "n_eu").agg(*[F.sort_array(F.collect_list(F.when(F.col("language") == lang, one))).alias(lang) for lang in ("es", "eu")])
    return got.where("size(es) > 0 AND size(eu) > 0").select("pair", F.col("es.sent_id").alias("es_ids"), F.col("es.t").alias("es"), F.col("eu.sent_id").alias("eu_ids"), F.col("eu.t").alias("eu"), (F.col("part") * window).alias("at"), F.col("n_eu").alias("of"))


def mark_pairs(pairs: DataFrame) -> DataFrame:
    """pairs with both pages marked, so that every round needs only to divide them at blanks and tabs."""
    names = ["pair", "es_ids", "es", "eu_ids", "eu", "at", "of"]
    pairs = pairs.select(*[F.col(c).cast("long") if c in ("pair", "at", "of") else F.col(c) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [marked(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True)]
            cols = [b.column(k) for k in range(7)]
            cols[2], cols[4] = (pa.array([g[k] for g in got], pa.list_(pa.string())) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return pairs.mapInArrow(run, pairs.schema)


STATS = "k string, s string, e string, c double, n_s double, n_e double"


@dataclass
class Statistics:
    """Counts of a round: rows (STATS) in Spark, as many as there are words and word pairs, and the few that all pages need.

    A table of at most max_entries rows goes to every task; a larger one is divided: pages are put into blocks, and each
    block gets the rows of its own words. Both give the same.
    """

    rows: DataFrame
    totals: dict[str, float]
    jump: np.ndarray
    size: int
    max_entries: int

    def model(self) -> Model:
        """The whole model on the driver."""
        return build_model(self.rows.collect(), self.totals, self.jump)

    def spread(self) -> bool:
        return self.size > self.max_entries


def build_model(rows: list, totals: dict[str, float], jump: np.ndarray) -> Model:
    """A model from rows of statistics, or from those of them that some pages need. The order of rows doesn't matter."""
    m = Model(trained=True, jump=jump)
    pairs: list[tuple[str, str, float, float]] = []
    found: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0.0])
    for k, s, e, c, n_s, n_e in rows:
        if k == "L":
            if s == NULL:
                m.null[e] = c / n_s
            else:
                pairs.append((s, e, c / n_s, c / n_e))
        elif k == "B":
            m.bg_e[e] = c / totals["B"]
        elif k == "R":
            m.bg_s[s] = c / totals["R"]
        elif k in ("Ws", "We", "C"):
            found[k, s][int(e)] += c
    m.table = Table(pairs)
    m.loose = frozenset(s for (k, s), (no, yes) in found.items() if k == "C" and no + yes >= 40 and no >= LOOSE * (no + yes))
    m.rate_s = {s: yes / (no + yes) for (k, s), (no, yes) in found.items() if k == "Ws" and no + yes >= 5}
    m.rate_e = {s: yes / (no + yes) for (k, s), (no, yes) in found.items() if k == "We" and no + yes >= 5}
    return m


def statistics(counts: DataFrame, least: float, max_entries: int) -> Statistics:
    """Counts by (k, s, e), pruned: entries below `least` or a chance of 1 in 1,000 given their word, other counts below 2."""
    got = cut(counts.groupBy("k", "s", "e").agg(F.sum("c").alias("c")).where((F.col("k") != "L") & (F.col("c") >= 2) | (F.col("k") == "L") & (F.col("c") >= least)))
    lex = got.where("k = 'L'")
    of_s = lex.groupBy("s").agg(F.sum("c").alias("n_s"))
    of_e = lex.where(F.col("s") != NULL).groupBy("e").agg(F.sum("c").alias("n_e"))
    kept = lex.join(of_s, "s").where(F.col("c") >= 1e-3 * F.col("n_s")).join(of_e, "e", "left").select("k", "s", "e", "c", "n_s", "n_e")
    nothing = F.lit(None).cast("double")
    rows = cut(kept.unionByName(got.where("k <> 'L'").withColumns({"n_s": nothing, "n_e": nothing})))
    few = rows.where("k <> 'J'").groupBy("k", F.lit("").alias("e")).agg(F.sum("c").alias("c"), F.count("*").alias("n"))
    few = few.unionByName(rows.where("k = 'J'").select("k", "e", "c", F.lit(0).cast("long").alias("n"))).collect()  # a row a kind and a jump
    jumps = np.exp(default_jumps()) * 20
    for r in few:
        if r["k"] == "J":
            jumps[int(r["e"]) + JUMPS] += r["c"]
    totals = {"B": 1.0, "R": 1.0} | {r["k"]: r["c"] for r in few if r["k"] in ("B", "R")}
    return Statistics(rows, totals, np.log(jumps / jumps.sum()), sum(r["n"] for r in few), max_entries)


def block_statistics(blocks: DataFrame, st: Statistics) -> DataFrame:
    """(block, STATS): the rows of st that the words and clauses of each block of marked pages need."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[tuple[int, str, str]] = set()
            for at, *pages in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                for side, page in zip("se", pages, strict=True):
                    for t in page:
                        for c in parts_of(t):
                            seen.add((at, "p", pattern(c)))
                            seen.update((at, side, w[0] if _special(w) else w) for w in c)
            rows = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["block", "side", "w"])

    vocab = cut(blocks.select("block", "es", "eu").mapInArrow(words, "block long, side string, w string").distinct())
    pair = (F.col("k") == "L") & (F.col("s") != NULL)
    side = F.when(F.col("k").isin("B", "We") | (F.col("k") == "L"), "e").when(F.col("k") == "C", "p").otherwise("s")
    word = F.when(F.col("k").isin("B", "L"), F.col("e")).otherwise(F.col("s"))
    cols = ["block", "k", "s", "e", "c", "n_s", "n_e"]
    single = st.rows.where(~pair & (F.col("k") != "J")).withColumns({"side": side, "w": word}).join(vocab, ["side", "w"]).select(*cols)
    src, tgt = vocab.where("side = 's'").select("block", F.col("w").alias("s")), vocab.where("side = 'e'").select("block", F.col("w").alias("e"))
    return single.unionByName(st.rows.where(pair).join(src, "s").join(tgt, ["block", "e"]).select(*cols))


def over_pages(data: DataFrame, st: Statistics | Model, work: Callable[[Iterator[dict], Model], Iterator[pa.RecordBatch]], schema: str, block: int = 2000) -> DataFrame:
    """What work gives for the rows of data, marked pages, with a model of st: one for all, or one for each block of pages.

    A block holds about `block` rows of ordinary pages; each row of a long page is a block of its own.
    """
    spark = data.sparkSession
    if isinstance(st, Model) or not st.spread():
        sent = spark.sparkContext.broadcast(st if isinstance(st, Model) else st.model())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from work((r for b in batches for r in b.to_pylist()), sent.value)

        return data.mapInArrow(run, schema)
    totals, jump = st.totals, st.jump
    n = -(-data.count() // block)
    own = F.xxhash64("pair", "at")
    data = data.withColumn("block", F.when(F.size("es") + F.size("eu") > 2 * LONG, own).otherwise(F.pmod(own, F.lit(n))))

    def one(pages: pa.Table, rows: pa.Table) -> pa.Table:
        m = build_model(list(zip(*(rows.column(c).to_pylist() for c in ("k", "s", "e", "c", "n_s", "n_e")), strict=True)), totals, jump)
        return pa.Table.from_batches(list(work(iter(pages.to_pylist()), m)))

    return data.groupBy("block").cogroup(block_statistics(data, st).groupBy("block")).applyInArrow(one, schema)


def _sum_counts(rows: Iterator[dict], m: Model) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def batch() -> pa.RecordBatch:
        keys = list(total)
        return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)), pa.array([float(total[k]) for k in keys], pa.float64())], names=["k", "s", "e", "c"])

    for r in rows:
        p = pages_of(r["es"], r["eu"], m, r["at"], r["of"])
        p.counts(p.decode(), total)
        if len(total) > 200_000:  # summed up by Spark, so a task may give its counts in parts
            yield batch()
            total.clear()
    yield batch()


def train(pairs: DataFrame, rounds: int = 5, max_train: int | None = None, least: float = 0.05, max_entries: int = 1_000_000) -> Statistics | Model:
    """What was learned in so many rounds over all page pairs, or over max_train of them (those of lowest hash).

    Table entries of less weight than `least`, or a chance below 1 in 1,000 given their source word, are left out, as are
    words, clauses and jumps that occur once; nothing else is. The table stays in Spark; see Statistics for max_entries.
    """
    spark = pairs.sparkSession
    if max_train is not None:
        pairs = lowest(pairs.withColumn("_h", F.xxhash64("pair", F.col("eu_ids")[0])), "_h", max_train)
    data = cut(mark_pairs(pairs).select("pair", "es", "eu", "at", "of").repartition(max(2, spark.sparkContext.defaultParallelism, pairs.rdd.getNumPartitions())))
    model: Statistics | Model = Model()
    for _ in range(rounds):
        model = statistics(over_pages(data, model, _sum_counts, "k string, s string, e string, c double"), least, max_entries)
    return model


def align(pairs: DataFrame, model: Statistics | Model, null_per_word: float = 1.2, least_hit: float = 0.5) -> DataFrame:
    """(pair, es_id, eu_id, score): aligned sentences; score is the mean log-likelihood ratio of the target's words.

    A pair is kept if at least least_hit of the words of one side are explained by the other.
    """

    def work(rows: Iterator[dict], m: Model) -> Iterator[pa.RecordBatch]:
        for few in iter(lambda: list(islice(rows, 64)), []):
            out = []
            for r in few:
                p = pages_of(r["es"], r["eu"], m, r["at"], r["of"])
                for i, j, s in p.decode(null_per_word):
                    if not m.trained or p.hit(i, j) >= least_hit:
                        out.append((r["pair"], r["es_ids"][i], r["eu_ids"][j], s))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["pair", "es_id", "eu_id", "score"])

    return over_pages(mark_pairs(pairs), model, work, "pair long, es_id long, eu_id long, score double")


def found_pairs(aligned: DataFrame) -> DataFrame:
    """(sent_id_a, sent_id_b): each pair of sentences once, the smaller id first."""
    return aligned.select(F.least("es_id", "eu_id").alias("sent_id_a"), F.greatest("es_id", "eu_id").alias("sent_id_b")).distinct()
