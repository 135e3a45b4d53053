"""Main text of pages by their line-block distribution, sharpened with what lines of either kind say across the corpus."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.truncation import NOTE

TAG = re.compile(r"<[^<>\n]{1,200}>")
MARK = re.compile(r"^\s*(?:[-*+>]+|#{1,6}|\d+[.)])\s+|[*_`~]{1,3}")
MARKED = re.compile(r"[*_`~]|^\s*[-+>#\d]")  # lines that may hold any of MARK
FENCE = re.compile(r"^\s*(?:```|~~~)")
LIST_SIGN = re.compile(r"\s[|·•/»›>:—-]{1,2}\s|\s{2,}")
WORD = re.compile(r"[^\W\d_]+|\d+|[|·•©→←↑»:?!]")
WIDE = re.compile(r"[ᄀ-ᇿ぀-ヿ㐀-鿿가-힣]")
DIGITS = re.compile(r"\d+")
BLANKS = re.compile(r"[^\S ]")  # blanks other than the space
WINDOW = 3  # lines a block sums over
SURGE = 150  # characters a block needs to be text
ROUNDS = 2
CHARS_A_CELL = 32  # characters of the pages for each cell of the word model's table: fewer features than cells
LEAST_BITS = 18
MOST_BITS = 21  # the table goes through the driver; a larger column's rarest features share cells, none is left out
KNOWN = 3e-4  # of the pages a line must stand behind the text of to be a known insert, and at least 6
SHORT = 120  # characters up to which a line's score is kept for its next occurrence
SEPARATORS = tuple(" " + c for c in "|·•/»›>:—-") + ("  ",)


def weight(line: str) -> int:
    """Length of a line's running text: without markup, East Asian characters twice; a row of links counts little."""
    t = TAG.sub("", line) if "<" in line else line
    t = (MARK.sub("", t) if MARKED.search(t) else t).strip()
    if not t:
        return 0
    # Plain substring searches spare most lines the expression.
    for x in SEPARATORS:
        if x in t:
            signs = len(LIST_SIGN.findall(t))
            break
    else:
        signs = len(LIST_SIGN.findall(t)) if BLANKS.search(t) else 0
    if signs >= 2 and len(t) / (signs + 1) < 25:
        return min(15, len(t) // (signs + 1))
    n = len(t) if t.isascii() else len(t) + len(WIDE.findall(t))
    # Titles and labels don't end like sentences.
    return n if n > 120 or t[-1] in ".!?。！？…:;)”\"’" else int(0.4 * n)


def fenced(lines: list[str]) -> list[bool]:
    out, inside = [], False
    for x in lines:
        f = bool(FENCE.match(x))
        out.append(inside or f)
        if f:
            inside = not inside
    return out


def surge_and_dive(sizes: list[int], code: list[bool]) -> tuple[int, int]:
    """First line of the text and first line after it, from the sums of ``WINDOW`` lines.

    The text begins where a block first surges over ``SURGE`` and ends where
    the last such block dives; inside the outermost blocks it begins and ends
    with a line of 50 characters or more. Code counts as text. (0, n) if
    nothing surges.
    """
    n = len(sizes)
    w = [max(s, 60) if c else s for s, c in zip(sizes, code)]
    sums = [sum(w[i : i + WINDOW]) for i in range(n)]
    up = [i for i in range(n) if sums[i] >= SURGE]
    if not up:
        return 0, n
    a = next((i for i in range(up[0], min(n, up[0] + WINDOW)) if w[i] >= 50), up[0])
    z = up[-1]
    last = max((i for i in range(z, min(n, z + WINDOW)) if w[i] >= 50), default=z)
    return a, last + 1


class Cells:
    """Cells of the features of lines: words, word pairs, first and last words, and short lines as such, which have a table of their own."""

    def __init__(self, bits: int):
        self.bits, self.mask = bits, (1 << bits) - 1
        self.known: dict[str, int] = {}

    def word(self, w: str) -> int:
        c = self.known.get(w)
        if c is None:
            if len(self.known) > 500_000:
                self.known.clear()
            c = self.known[w] = xxhash.xxh32_intdigest(w) & self.mask
        return c

    def of(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For lines together: cells of all their features, the line of each, and the cell of each line as such (-1 if it is long or empty)."""
        flat: list[int] = []
        counts, whole = [], []
        get, word = self.known.get, self.word
        for line in lines:
            t = DIGITS.sub("0", (TAG.sub("", line) if "<" in line else line).strip().lower())
            found = WORD.findall(t)
            ws = list(map(get, found))
            if None in ws:
                ws = [word(w) for w in found]
            flat += ws
            counts.append(len(ws))
            whole.append(word("=" + t) + self.mask + 1 if t and len(t) <= 80 else -1)
        n, own = np.array(counts, np.int64), np.array(whole, np.int64)
        w = np.array(flat, np.int64)
        at = np.repeat(np.arange(len(lines)), n)
        live = np.flatnonzero(n)
        first = np.concatenate([[0], np.cumsum(n)[:-1]])[live] if len(live) else live
        last = first + n[live] - 1
        same = np.flatnonzero(at[1:] == at[:-1])
        pairs = ((w[same] * 2654435761 + w[same + 1] * 2246822519) >> 7) & self.mask
        begins = (w[first] * 668265263 + 374761393 >> 7) & self.mask
        ends = (w[last] * 3266489917 + 668265263 >> 7) & self.mask
        short = np.flatnonzero(own >= 0)
        return np.concatenate([w, pairs, begins, ends, own[short]]), np.concatenate([at, at[same], live, live, short]), own


_CELLS: dict[int, Cells] = {}


def cells_of(bits: int) -> Cells:
    """The worker's cells: words once hashed serve its later tasks too."""
    return _CELLS.setdefault(bits, Cells(bits))


class Model:
    """Log odds of the table's cells: furniture against body; and the repeated lines that mostly stand behind texts."""

    def __init__(self, bits: int, odds: np.ndarray, known: np.ndarray):
        self.bits, self.odds, self.known = bits, odds, known

    def scores(self, cells: np.ndarray, line: np.ndarray, own: np.ndarray) -> list[float]:
        """The score of each line whose features are given as by ``Cells.of``."""
        k = np.bincount(line, minlength=len(own))
        s = np.bincount(line, self.odds[cells], len(own)) / np.sqrt(np.maximum(k, 1))
        s = np.clip(s, -6.0, 6.0)
        hit = np.flatnonzero(own >= 0)
        hit = hit[self.known[own[hit] - (1 << self.bits)]]
        s[hit] = np.maximum(s[hit], 4.0)
        return s.tolist()


class Judge:
    """Furniture flags of a page's lines."""

    def __init__(self, model: Model | None):
        self.model = model
        self.cells = cells_of(model.bits) if model else None
        self.seen: dict[str, float] = {}
        self.sizes: dict[str, int] = {}

    def scores(self, lines: list[str]) -> dict[str, float]:
        """Scores of different lines, those not seen before all at once."""
        out, new = {}, []
        for x in lines:
            s = self.seen.get(x)
            if s is None:
                new.append(x)
            else:
                out[x] = s
        if new:
            for x, s in zip(new, self.model.scores(*self.cells.of(new))):
                out[x] = s
                if len(x) <= SHORT:
                    self.seen[x] = s
            if len(self.seen) > 100_000:
                self.seen.clear()
        return out

    def size(self, line: str) -> int:
        n = self.sizes.get(line)
        if n is None:
            n = weight(line)
            if len(line) <= SHORT:
                if len(self.sizes) > 100_000:
                    self.sizes.clear()
                self.sizes[line] = n
        return n

    def blocks(self, text: str) -> tuple[list[str], list[bool], list[int], int, int]:
        """Lines, whether they are code, their sizes, and the bounds of the text."""
        lines = text.split("\n")
        code = fenced(lines) if "```" in text or "~~~" in text else [False] * len(lines)
        sizes = [self.size(x) for x in lines]
        a, z = surge_and_dive(sizes, code)
        return lines, code, sizes, a, z

    def first(self, text: str) -> list[tuple[str, int]]:
        """Lines with a seed label: 0 inside the text, 1 before it, 2 behind it, by the line-block distribution alone."""
        lines, code, _, a, z = self.blocks(text)
        live = [i for i, x in enumerate(lines) if x.strip()]
        head, tail = [i for i in live if i < a], [i for i in live if i >= z]
        out = [(lines[i], 0) for i in live if a <= i < z and not code[i]]
        # One or two short lines around a text may be its own heading or closing words.
        # The line next to the text stays without a label where there are more.
        for part, near, label in ((head, -1, 1), (tail, 0, 2)):
            for i in part:
                if not code[i] and (len(part) < 3 or i != part[near]):
                    out.append((lines[i], label if len(part) >= 3 else 0))
        return out

    def flags(self, text: str, scores: Callable | None = None) -> list[tuple[int, str, int, bool]]:
        """(number, line, label, code) of each line that is not blank: 0 text, 1 head, 2 insert or tail.

        The likeliest path through head, text, insert, text, tail: lines weigh
        in with their score, outside the block also with their place. ``scores``
        stands in for the method of that name.
        """
        lines, code, sizes, a, z = self.blocks(text)
        live = [i for i, x in enumerate(lines) if x.strip()]
        if not live:
            return []
        notes = {i for i in live if not code[i] and len(x := lines[i].strip()) > 3 and len(x) < 100 and NOTE.fullmatch(x)}
        score = (scores or self.scores)(list({lines[i] for i in live if not code[i]}))
        before = sum(1 for i in live if i < a)
        after = sum(1 for i in live if i >= z)
        # States: 0 head, 1 text, 2 insert, 3 tail. Costs of going from one to another.
        go = {0: ((0, 0.0), (1, 0.7)), 1: ((1, 0.0), (2, 2.6), (3, 1.2)), 2: ((2, 0.3), (1, 0.7), (3, 1.0)), 3: ((3, 0.0),)}
        best = {0: (0.3, None), 1: (0.5, None)}
        trail = []
        for k, i in enumerate(live):
            x = lines[i]
            if code[i]:
                s = -4.0
            elif i in notes:
                s = 9.0
            else:
                s = score[x]
            if sizes[i] > 160 and s < 4:
                s = min(s, 0.0) - 1.0
            near = 0.5 * min(3, before) if i < a else 0.0
            # The first line behind the text may be the author's closing words.
            far = 0.5 * min(3, after) if i >= z and k and live[k - 1] >= z else 0.0
            if a <= i < z:
                near = far = -0.5
            if not any(c.isalnum() for c in x):
                s = min(s, 0.0)
            closing = 0.8 if i >= z and k and live[k - 1] < z else 0.0
            gain = (s + near, closing, s, s + far)
            nxt: dict = {}
            if k == 0:
                for st, (c, _) in best.items():
                    nxt[st] = (gain[st] - c, None)
            else:
                for st, (v, _) in best.items():
                    for to, c in go[st]:
                        w = v - c + gain[to]
                        if to not in nxt or w > nxt[to][0]:
                            nxt[to] = (w, st)
            trail.append({st: p for st, (_, p) in nxt.items()})
            best = nxt
        ends = {st: v for st, (v, _) in best.items() if st in (1, 3)} or {st: v for st, (v, _) in best.items()}
        st = max(ends, key=ends.get)
        path = []
        for t in reversed(trail):
            path.append(st)
            st = t[st]
        path.reverse()
        return [(i, lines[i], (1, 0, 2, 2)[p], code[i]) for i, p in zip(live, path)]


class _Learn:
    """Adds up table cells by label: words and lines of bodies, then those of furniture; sums below zero."""

    def __init__(self, bits: int, model):
        self.bits, self.model = bits, model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = self.model.value if self.model is not None else None
        judge = Judge(model)
        of = cells_of(self.bits).of
        size = 2 << self.bits
        flat = np.zeros(2 * size + size // 2, np.int64)  # body, furniture, whole lines behind or between the text
        sums = [0, 0, 0]
        page: list = []

        def features(lines: list[str]) -> dict[str, float] | None:
            """Features of a page's different lines, kept for its counts; their scores by the model before."""
            page[:] = lines, of(lines)
            return dict(zip(lines, model.scores(*page[1]))) if model else None

        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                if model is None:
                    got = judge.first(t)
                    features(list({x for x, _ in got}))
                else:
                    got = [(x, f) for _, x, f, c in judge.flags(t, features) if not c]
                sums[2] += 1
                if not got:
                    continue
                lines, (cells, line, own) = page
                at = {x: j for j, x in enumerate(lines)}
                n = np.zeros((3, len(lines)), np.int64)
                for x, f in got:
                    n[f, at[x]] += 1
                # A line has a cell once, however often it repeats the word; every occurrence of the line counts.
                key = np.unique(line << (self.bits + 1) | cells)
                cell, j = key & (size - 1), key >> (self.bits + 1)
                for k, own_n in enumerate((n[0], n[1] + n[2])):
                    m = own_n[j]
                    hit = np.flatnonzero(m)
                    np.add.at(flat, cell[hit] + k * size, m[hit])
                hit = np.flatnonzero((own >= 0) & (n[2] > 0))
                np.add.at(flat, own[hit] - size // 2 + 2 * size, n[2][hit])
                sums[1] += int(n[1:].sum())
                sums[0] += int(n[0].sum())
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, [-1, -2, -3]]), pa.int64()), pa.array(np.concatenate([flat[at], sums]), pa.int64())], names=["k", "n"])


def learn(df: DataFrame, text: str, id_col: str | None = None, rounds: int = ROUNDS, fit_pages: int | None = None, bits: int | None = None) -> Model:
    """The word model: a classifier of lines, fitted on all pages.

    Labels come from the pages' line blocks, then from the model before.
    ``bits`` sizes its table, by default from the characters of the pages, up
    to ``MOST_BITS``: what the driver gathers is at most a row for each cell.
    With ``fit_pages`` only about as many pages are taken, those whose hash
    falls below a threshold; no query does that.
    """
    spark = df.sparkSession
    # Copies of a page are told apart by their id, so that a hot page is drawn at the rate of the others.
    own = F.col(id_col) if id_col else F.monotonically_increasing_id()
    t = df.select(F.col(text).cast("string").alias("t"), own.alias("i")).where("t <> ''")
    if fit_pages is not None and (pages := t.count()) > fit_pages:
        spot = F.pmod(F.xxhash64("t", "i"), F.lit(1 << 40))
        t = t.where(spot < F.lit(int((1 << 40) * (fit_pages / pages))))
    if bits is None:
        chars = t.agg(F.sum(F.length("t"))).first()[0] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, chars) / CHARS_A_CELL))))
    model, cells = None, 2 << bits
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model) if model is not None else None
        got = t.select("t").mapInArrow(_Learn(bits, shared), "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        k, n = got.column("k").to_numpy(), got.column("n").to_numpy()
        body, rest, seen = (int(n[k == -i].sum()) for i in (1, 2, 3))
        flat = np.zeros(2 * cells + cells // 2)
        flat[k[k >= 0]] = n[k >= 0]
        text_cells, furniture, behind = flat[:cells], flat[cells : 2 * cells], flat[2 * cells :]
        # Shares of lines that have the cell, where any has; smoothing that fades with evidence.
        least = 0.5
        live = np.flatnonzero((text_cells > 0) | (furniture > 0))
        good, bad = text_cells[live], furniture[live]
        p = (bad + least) / (rest + 2 * least)
        q = (good + least * max(1.0, body / max(1, rest))) / (body + 2 * least * max(1.0, body / max(1, rest)))
        odds = np.zeros(cells, np.float32)
        odds[live] = np.clip((np.log(p) - np.log(q)) * ((good + bad) / (good + bad + 1.0)), -4, 4)
        # A menu's words may head a section; what often stands behind texts is no heading.
        known = (behind >= max(6.0, KNOWN * seen)) & (behind > text_cells[cells // 2 :])
        model = Model(bits, odds, known)
    return model


class _Mark:
    def __init__(self, model, body: bool):
        self.model, self.body = model, body

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(self.model.value)
        for b in batches:
            ids, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if self.body:
                    ids.append(i)
                    out.append(None if t is None else "\n".join(x for _, x, f, _ in judge.flags(t) if not f))
                elif t:
                    for n, _, f, _ in judge.flags(t):
                        if f:
                            ids.append(i)
                            out.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string() if self.body else pa.int64())], names=["id", "body" if self.body else "line_no"])


def furniture_lines(df: DataFrame, id_col: str, text: str, model: Model | None = None) -> DataFrame:
    """``id``, ``line_no`` of every line that is not the author's: see ``main_text``."""
    shared = df.sparkSession.sparkContext.broadcast(model or learn(df, text, id_col))
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(_Mark(shared, False), "id bigint, line_no bigint")


def main_text(df: DataFrame, id_col: str, text: str, model: Model | None = None) -> DataFrame:
    """``id``, ``body``: the author's lines of every page.

    Text lengths of lines, markup stripped, are summed over sliding windows;
    the first surge and the last dive of these sums bound the text. What
    stands outside and inside such bounds in all pages of the corpus
    gives log odds to words, word pairs and lines (``learn``) in a table that
    is broadcast; they settle the lines near the bounds and find inserts between
    them. Code between fences is body.

    Null text gives a null body, empty text an empty one; lines are numbered
    from 0 with blank ones; blank lines are left out of the body. Repeated
    rows are treated alike. An empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model or learn(df, text, id_col))
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(_Mark(shared, True), "id bigint, body string")
