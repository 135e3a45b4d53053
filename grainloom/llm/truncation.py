"""Texts cut off by field limits: censored length fits combined with evidence of the ending."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.session import cut

# What platforms and crawlers put after a cut.
NOTE = re.compile(
    r"(?:\s*(?:…|\.\.\.|\[…\]|\[\.\.\.\]|\(…\)))?\s*(?:[\[(](?:content |text )?(?:truncated|continued|cut off|more|gekürzt|tronqué|truncado|자세히|계속|続き)[\])]|\[\+\s*\d+\s*(?:chars|characters|more)?\]"
    r"|read more(?: »)?|continue reading(?: →)?|see more|show more|weiterlesen|lire la suite|leer más|seguir leyendo|ler mais|continue lendo|continuar leyendo|계속 읽기|더 보기|더보기|続きを読む|もっと見る|(?<=…)\s*more)\s*\Z"
    r"|\s*(?:…|\.\.\.|\[…\]|\[\.\.\.\]|\(…\))\s*\Z",
    re.I,
)
FENCE = re.compile(r"^\s*(?:```|~~~)")
LAST = re.compile(r"([^\W_]+)\s*\Z")
WORDS = re.compile(r"[^\W_]+")
DIGITS = re.compile(r"\d+")
URL = re.compile(r"\S+://\S+\s*\Z")
END = ".!?。！？"
CLOSERS = "\"'”’»)]}）」』`*_:;…"
CLASSES = 6  # how a line ends: word, sentence end, closed quote or bracket, open punctuation, other
BUCKETS = 4
MOST = 0.95  # of the values at a limit; some whole texts are fitted to it


def end_class(s: str) -> int:
    """0 word, 1 sentence end, 2 closing sign, 3 sign that asks for more, 4 other, 5 nothing."""
    t = s.rstrip()
    if not t:
        return 5
    c = t[-1]
    if c in "/=&" and URL.search(t):
        return 4
    if c.isalnum():
        return 0
    if c in END:
        return 1
    if c in CLOSERS:
        return 2
    if c in ",，、-–—([{“‘«「『&/|+=<":
        return 3
    return 4


def bucket(n: int) -> int:
    return 0 if n < 25 else 1 if n < 60 else 2 if n < 140 else 3


def strip_note(s: str) -> tuple[str, bool]:
    m = NOTE.search(s[-80:])
    if m and m.end() > m.start():
        at = len(s) - min(80, len(s)) + m.start()
        return s[:at].rstrip(), True
    return s, False


def cut_at(line: str) -> int:
    """A place inside a line, the same for the same line: a cut that might have been."""
    return 1 + xxhash.xxh32_intdigest(line) % max(1, len(line) - 1)


def signed(s: str) -> int:
    h = xxhash.xxh64_intdigest(s)
    return h - 2**64 if h >= 2**63 else h


class _Tally:
    """Table cells of words anywhere (w), at line ends (e), word beginnings (p); sums below zero; hashes of last lines (l) with that of the text before as ``x``."""

    def __init__(self, bits: int, single: bool):
        self.mask, self.single = (1 << bits) - 1, single

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ends, finals = Counter(), Counter(), set()
        sums = np.zeros(3, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                t = t.lower()
                words.update(WORDS.findall(t))
                sums[1] += len(t)
                lines = [x for x in strip_note(t)[0].split("\n") if x.strip()]
                if lines and not self.single and len(lines[-1]) >= 12:
                    # Copies of one text say nothing about each other: a line counts once for each text it follows.
                    before = DIGITS.sub("0", "\n".join(x.strip() for x in lines[:-1]))
                    finals.add((signed("l" + DIGITS.sub("0", lines[-1].strip())), signed(before)))
                for i, x in enumerate(lines):
                    if i == len(lines) - 1 and not self.single and len(x) >= 60:
                        continue  # only this line may be cut
                    m = LAST.search(x[-60:])
                    if m:
                        ends[m.group(1)] += 1
                        sums[2] += 1
            if len(words) + len(ends) + len(finals) > 400_000:
                yield self._out(words, ends, finals, sums)
                words, ends, finals, sums = Counter(), Counter(), set(), np.zeros(3, np.int64)
        yield self._out(words, ends, finals, sums)

    def _out(self, words, ends, finals, sums) -> pa.RecordBatch:
        begin = Counter()
        for w, n in words.items():
            for i in range(1, min(len(w), 16) + 1):
                begin[w[:i]] += n
        cells: Counter = Counter()
        for tag, c in (("w", words), ("e", ends), ("p", begin)):
            for k, n in c.items():
                h = xxhash.xxh64_intdigest(tag + k)
                a, z = h & self.mask, (h >> 32) & self.mask
                cells[a] += n
                if a != z:
                    cells[z] += n
        sums[0] = sum(words.values())
        ks = list(cells) + [-1, -2, -3]
        ns = [*cells.values(), *sums.tolist(), *[1] * len(finals)]
        xs = [None] * len(ks) + [x for _, x in finals]
        ks += [k for k, _ in finals]
        return pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(ns, pa.int64()), pa.array(xs, pa.int64())], names=["k", "n", "x"])


class Counts:
    """Looked-up counts; ``words``, ``chars``, ``ends`` are totals."""

    def __init__(self, cells, words, chars, ends):
        self.cells, self.words, self.chars, self.ends, self.mask = cells, words, chars, ends, len(cells) - 1

    def of(self, tag: str, w: str) -> int:
        h = xxhash.xxh64_intdigest(tag + w)
        return int(min(self.cells[h & self.mask], self.cells[(h >> 32) & self.mask]))


def tally(df: DataFrame, text: str, single: bool, bits: int) -> Counts:
    got = df.select(F.col(text).cast("string")).mapInArrow(_Tally(bits, single), "k bigint, n bigint, x bigint")
    if not single:
        mask = (1 << bits) - 1
        one = got.groupBy("k", "x").agg(F.sum("n").alias("n"))
        at = F.array_distinct(F.array(F.col("k").bitwiseAND(mask), F.shiftrightunsigned("k", 32).bitwiseAND(mask)))
        got = one.select(F.explode(F.when(F.col("x").isNull(), F.array("k")).otherwise(at)).alias("k"), F.when(F.col("x").isNull(), F.col("n")).otherwise(1).alias("n"))
    got = got.groupBy("k").agg(F.sum("n").alias("n")).where("k < 0 OR n > 1")
    t = got.select("k", F.least("n", F.when(F.col("k") < 0, F.col("n")).otherwise(F.lit(2_000_000_000))).alias("n")).toArrow()
    k, n = t.column("k").to_numpy(), t.column("n").to_numpy()
    cells = np.zeros(1 << bits, np.int32)
    cells[k[k >= 0]] = n[k >= 0]
    sums = dict(zip(k[k < 0].tolist(), n[k < 0].tolist()))
    return Counts(cells, *(max(1, sums.get(-i, 0)) for i in (1, 2, 3)))


class _Features:
    """A row of ending features per text; and, as rows of kind 1 and 2, tallies of whole line ends and of mock cuts."""

    def __init__(self, counts, single: bool):
        self.counts, self.single = counts, single

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = self.counts.value
        seen: dict[str, tuple] = {}

        def of(word):
            got = seen.get(word)
            if got is None:
                if len(seen) > 200_000:
                    seen.clear()
                got = seen[word] = (c.of("w", word), c.of("e", word), c.of("p", word))
            return got

        tallies: Counter = Counter()
        for b in batches:
            out: list[tuple] = []
            for i, source, text in zip(*[x.to_pylist() for x in b.columns]):
                if not text or not text.strip():
                    continue
                body, note = strip_note(text.rstrip())
                low = body.lower()
                lines = low.split("\n")
                full = [x for x in lines if x.strip()]
                last = full[-1] if full else ""
                torn = body.endswith("\ufffd")  # half a character
                fences = sum(1 for x in full if FENCE.match(x))
                quote = body.count("“") > body.count("”") or body[:1] in "\"'" and body.count(body[0]) % 2 == 1 if self.single else False
                brackets = self.single and (body.count("(") > body.count(")") or body.count("[") > body.count("]"))
                cls, bu = end_class(last), bucket(len(last))
                m = LAST.search(last[-60:])
                w, e, p = of(m.group(1)) if m else (0, 0, 0)
                again = c.of("l", DIGITS.sub("0", last.strip())) if not self.single and len(last) >= 12 else 0
                out.append((0, i, source, len(body), len(body.encode()), note, bool(fences % 2), bool(quote or brackets or torn), cls, bu, w, e, p, again >= 4, again))
                for k, x in enumerate(full):
                    if k < len(full) - 1 or self.single:
                        kc = end_class(x)
                        r = LAST.search(x[-60:]) if kc == 0 else None
                        tallies[1, bucket(len(x)), kc, bool(r) and sum(of(r.group(1))[::2]) < 6] += 1
                    if len(x) > 12:
                        y = x[: cut_at(x)]
                        kc = end_class(y)
                        r = LAST.search(y[-60:]) if kc == 0 else None
                        tallies[2, bucket(len(y)), kc, bool(r) and sum(of(r.group(1))[::2]) < 6] += 1
            yield self._out(out)
        yield self._out([(kind, None, None, 0, 0, False, False, False, k, bu, n, 0, 0, rare, 0) for (kind, bu, k, rare), n in tallies.items()])

    @staticmethod
    def _out(rows) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        names = ("kind", "id", "source", "chars", "bytes", "note", "fence", "open", "cls", "bucket", "w", "e", "p", "rare", "again")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


FEATURES = "kind int, id bigint, source string, chars bigint, bytes bigint, note boolean, fence boolean, open boolean, cls int, bucket int, w bigint, e bigint, p bigint, rare boolean, again bigint"


def fit_limits(h: pd.DataFrame, steep: float = 4.0) -> list[tuple[int, float]]:
    """(limit, share of the values at it that were cut) of a histogram with ``n`` (length) and ``count``.

    A log-normal is fitted by maximum likelihood with the values at candidate
    limits taken as right-censored to the degree of the current posterior
    (expectation and maximisation by turns). Candidates are lengths that
    occur ``steep`` times as often as those around them, and more often than
    chance allows.
    """
    from statistics import NormalDist

    g = h.groupby("n")["count"].sum()
    g = g[g.index > 0].sort_index()
    if g.empty:
        return []
    n, c = g.index.to_numpy(float), g.to_numpy(float)
    reach = np.maximum(4, n * 0.02)
    sums = np.concatenate([[0.0], np.cumsum(c)])
    lo, hi = np.searchsorted(n, n - reach), np.searchsorted(n, n + reach, "right")
    around = (sums[hi] - sums[lo] - c) / (2 * reach)
    # Beyond what chance heaps up on one of many lengths.
    cand = (c > around + 4 * np.sqrt(around + 0.3) + 2) & (c > steep * (around + 0.3))
    if not cand.any():
        return []
    x = np.log(n)
    share = np.where(cand, 0.8, 0.0)
    mu, sd = np.average(x, weights=c), max(0.05, math.sqrt(np.cov(x, fweights=c.astype(int)) if c.sum() > 1 else 0.05))
    cdf = np.vectorize(NormalDist().cdf)
    for _ in range(25):
        z = (x - mu) / sd
        tail = np.clip(1 - cdf(z), 1e-9, 1)
        pdf = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
        hazard = np.clip(pdf / tail, 0, 50)
        # A censored value stands for the mean and spread of what lies beyond it.
        ex = mu + sd * hazard
        ex2 = sd * sd * (1 + z * hazard - hazard**2) + ex**2
        first = (1 - share) * x + share * ex
        second = (1 - share) * x * x + share * ex2
        mu = np.average(first, weights=c)
        sd = max(0.05, math.sqrt(max(1e-4, np.average(second, weights=c) - mu * mu)))
        whole = np.maximum(pdf / (sd * n) * c.sum(), around)
        share = np.where(cand, np.clip((c - whole) / c, 0.0, MOST), 0.0)
    return [(int(a), float(s)) for a, s in zip(n, share) if s > 0.2]


def _limits(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = fit_limits(pdf)
    one = lambda c: np.array([str(pdf[c].iloc[0])] * len(rows), dtype=object)
    return pd.DataFrame({"source": one("source"), "unit": one("unit"), "n": np.array([r[0] for r in rows], dtype="int64"), "posterior": np.array([r[1] for r in rows], dtype="float64")})


def truncated(df: DataFrame, id_col: str, source: str | Column, text: str, *, single_line: bool = False, bits: int = 23, base: float = 0.1) -> DataFrame:
    """``id``, ``source``, ``chars``, ``limit_share``, ``evidence``, ``score``, ``cut`` of every non-empty value.

    ``limit_share`` is the censoring posterior of the value's length (in
    characters or bytes) under its source's fit or that of all sources;
    ``evidence`` the log likelihood ratio of its ending: how lines end that are
    certainly whole (all but the last) against how they would end if cut
    anywhere, in the kind of sign, in the last word (its counts anywhere, at
    ends and as a beginning), open code fences and quotes, and notes put
    after a cut. ``cut`` when their sum is above zero.

    Null, empty and blank values give no row. ``source`` is trimmed and
    lower-cased; null is a source of its own. Whole texts are read. Repeated
    rows are judged each. The word table has a fixed size (``bits``).
    """
    src = F.coalesce(F.lower(F.trim(F.col(source) if isinstance(source, str) else source)), F.lit("(none)"))
    d = df.select(F.col(id_col).cast("bigint").alias("id"), src.alias("source"), F.col(text).cast("string").alias("t")).where("trim(t) <> ''")
    counts = tally(d, "t", single_line, bits)
    shared = d.sparkSession.sparkContext.broadcast(counts)
    f = cut(d.mapInArrow(_Features(shared, single_line), FEATURES))
    rows = f.where("kind = 0")
    # At most 2 * buckets * classes * 2 rows come back.
    stat = {}
    for r in f.where("kind > 0").groupBy("kind", "bucket", "cls", "rare").agg(F.sum("w").alias("n")).collect():
        stat[r["kind"], r["bucket"], r["cls"], bool(r["rare"])] = r["n"]
    ratio = {}
    mock = Counter()
    for (k, b, c, rare), n in stat.items():
        if k == 2:
            mock[c, rare] += n
    made = sum(mock.values()) or 1
    for b in range(BUCKETS):
        total = sum(n for (k, b2, _, _), n in stat.items() if k == 1 and b2 == b)
        for c in range(CLASSES):
            for rare in (False, True):
                p_cut = (mock[c, rare] + 0.5) / (made + 6)
                p_whole = (stat.get((1, b, c, rare), 0) + 0.5) / (total + 6)
                ratio[b, c, rare] = max(-6.0, min(6.0, math.log(p_cut / p_whole)))
    sources = rows.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("n")))).alias("x")).groupBy("source", "x.unit", "x.n").agg(F.count("*").alias("count"))
    per = sources.unionByName(sources.groupBy("unit", "n").agg(F.sum("count").alias("count")).withColumn("source", F.lit("*")))
    heap = F.max("count").over(Window.partitionBy("source", "unit"))
    limits = cut(per.withColumn("_heap", heap).where("_heap >= 4").drop("_heap").groupBy("source", "unit").applyInPandas(_limits, "source string, unit string, n bigint, posterior double"))

    def limit(unit: str, own: bool, name: str) -> DataFrame:
        at = limits.where((F.col("unit") == unit) & ((F.col("source") != "*") if own else (F.col("source") == "*")))
        return at.select(*(["source"] if own else []), F.col("n").alias(unit), F.col("posterior").alias(name))

    for i, unit in enumerate(("chars", "bytes")):
        rows = rows.join(limit(unit, True, f"o{i}"), ["source", unit], "left").join(limit(unit, False, f"a{i}"), [unit], "left")
    # A cut before a blank loses the blank when the value is trimmed.
    rows = rows.withColumn("_more", F.col("chars") + 1).join(limit("chars", False, "a2").withColumnRenamed("chars", "_more"), ["_more"], "left")
    share = F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in ("o0", "o1", "a0", "a1")], F.coalesce(0.6 * F.col("a2"), F.lit(0.0)))
    table = F.create_map(*[x for (b, c, rare), v in ratio.items() for x in (F.lit(f"{b}{c}{int(rare)}"), F.lit(v))])
    uncommon = (F.col("cls") == 0) & (F.col("w") + F.col("p") < 6)
    sign = table[F.concat(F.col("bucket"), F.col("cls"), uncommon.cast("int"))]
    # The last word: what share of cuts would end in it, whole or begun, against what share of ends do.
    # Words that only ever stand at an end can't be reached by a cut; ends that cuts made are taken off.
    inner = F.greatest(F.col("w") - F.col("e"), F.lit(0))
    by_cut = (2 * inner + F.greatest(F.col("p") - F.col("w"), F.lit(0)) + 0.3) / F.lit(float(counts.chars))
    made_by_cuts = 1 + by_cut * F.lit(2 * base * counts.ends if single_line else 0.0)
    by_end = (F.greatest(F.col("e") - made_by_cuts, F.lit(0.0)) + 0.1) / F.lit(float(counts.ends))
    word = F.when((F.col("cls") == 0) & ~uncommon, F.greatest(F.lit(-7.0), F.least(F.lit(7.0), F.log(by_cut / by_end)))).otherwise(0.0)
    # The same last line behind several different texts is a line of their site or a closing word.
    known = F.when(F.col("again") >= 4, -F.least(F.lit(7.0), 2 * F.log(F.col("again") / 2.0))).otherwise(0.0)
    ending = F.coalesce(sign, F.lit(0.0)) + word + known + F.when(F.col("note"), 12.0).otherwise(0.0) + F.when(F.col("fence"), 5.0).otherwise(0.0) + F.when(F.col("open"), 5.0).otherwise(0.0)
    prior = F.greatest(F.col("share"), F.lit(base))
    rows = rows.withColumn("share", share).withColumn("evidence", ending).withColumn("score", F.log(prior / (1 - prior)) + F.col("evidence"))
    return rows.select("id", "source", "chars", F.col("share").alias("limit_share"), "evidence", "score", (F.col("score") > 0).alias("cut"), "note", "cls", "bucket", "w", "e", "p", "fence", "open")
