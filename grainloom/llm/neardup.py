"""Near-duplicate short texts: Hamming fingerprints in sharded BK-trees."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from grainloom.llm.graph import components
from grainloom.session import cut, merge_join

# Letters of other scripts that look like a Latin one.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "υ": "u", "κ": "k", "τ": "t", "ɡ": "g", "ı": "i",
}
# Query parameters that only tell where a visitor came from.
VISIT_PARAMETERS = ("utm_[a-z_]+", "fbclid", "gclid", "gclsrc", "dclid", "msclkid", "yclid", "twclid", "ttclid", "igshid", "igsh", "mc_cid", "mc_eid", "_hsenc", "_hsmi", "mkt_tok", "ref", "ref_src", "ref_url", "referrer", "source", "src", "via", "from", "cmpid", "spm", "share", "trk", "s_cid", "_ga", "_gl", "wbraid", "gbraid")

MIN_NAME = 4  # letters a naming word has
SHORTER, LONGER = 0.8, 0.6  # of the words of the shorter and the longer title that one story pairs off
# Scripts in which one sign more or less is another word, not a slip.
NO_SLIPS = "[ᄀ-ᇿ぀-ヿ㐀-鿿가-힣]"


def page_key(url: Column) -> Column:
    """The page a URL leads to: no scheme, ``www.``, host case, default port, trailing slash, fragment or visit parameters.

    Other parameters stay, in sorted order. Null and blank URLs give null.
    """
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, r"^//", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    drop = r"^(?i)(" + "|".join(VISIT_PARAMETERS) + r")(=.*)?$"
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(drop)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.length(F.trim(url)) > 0, F.concat(host, path, tail))


def plain_title(s: str | None) -> str:
    """Lower-case words of a title: compatibility forms, look-alike letters and punctuation folded."""
    if not s:
        return ""
    s = unicodedata.normalize("NFKC", s).lower()
    if not s.isascii():
        mixed = "".join(LOOKALIKES.get(c, c) for c in s)
        # A look-alike is folded inside words that also have Latin letters; other scripts stay.
        s = " ".join(m if re.search("[a-z]", w) else w for w, m in zip(s.split(), mixed.split()))
        s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)) if not re.search(r"[　-퟿]", s) else s
    return " ".join(re.findall(r"[^\W_]+(?:[.,]\d+)*", s))


@F.pandas_udf(StringType())
def _plain(s: pd.Series) -> pd.Series:
    return s.map(plain_title)


def slips(w: str) -> set[str]:
    """The word and all words with one letter fewer: two words one slip apart share one of them."""
    return {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}


def least_paired(m: int, n: int) -> int:
    """Words that titles of ``m`` and ``n`` words, m <= n, must pair off to tell one story."""
    return max(math.ceil(SHORTER * m - 1e-9), math.ceil(LONGER * n - 1e-9), min(2, m))


def most_slips(m: int) -> int:
    return max(2, m // 4)


def radius(m: int, n: int) -> int:
    """The greatest Hamming distance of fingerprints of one story: every unpaired word flips a bit, every slip two."""
    return m + n - 2 * least_paired(m, n) + 2 * min(most_slips(m), least_paired(m, n))


def close(a: str, b: str) -> bool:
    """Equal, or one letter changed, lost, added or swapped with its neighbour; digits and East Asian words must agree."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1 or min(la, lb) < 2 or any(c.isdigit() for c in a + b) or not (a + b).isascii() and re.search(NO_SLIPS, a + b):
        return False
    i = 0
    while i < min(la, lb) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(la, lb) - i and a[la - 1 - j] == b[lb - 1 - j]:
        j += 1
    ra, rb = a[i : la - j], b[i : lb - j]
    return len(ra) <= 1 and len(rb) <= 1 or (len(ra) == 2 and len(rb) == 2 and ra == rb[::-1])


def two_slips(a: str, b: str) -> bool:
    """Whether one slip on either side makes the words close."""
    return any(close(x, y) for x in slips(a) for y in slips(b) if abs(len(x) - len(y)) <= 1)


def numbers(words: list[str]) -> list[str]:
    return sorted(w for w in words if any(c.isdigit() for c in w))


def same_story(a: list[str], b: list[str], rare_a: set[str], rare_b: set[str]) -> bool:
    """Whether two titles tell one story: the same numbers, the same named things, few other edits.

    Words are paired off, equal ones first, then those a slip apart. The
    titles agree if the numbers are the same, ``least_paired`` words are
    paired, not more than ``most_slips`` of them by a slip, and not both sides
    have an unpaired rare word (one named thing in place of another).
    """
    if len(a) > len(b) or len(a) == len(b) and a > b:
        a, b, rare_a, rare_b = b, a, rare_b, rare_a
    if numbers(a) != numbers(b):
        return False
    left = list(b)
    rest = []
    for w in a:
        if w in left:
            left.remove(w)
        else:
            rest.append(w)
    need = least_paired(len(a), len(b))
    if len(a) - len(rest) + min(len(rest), most_slips(len(a))) < need:
        return False
    alone = []
    for w in rest:
        m = next((x for x in left if close(w, x)), None)
        if m is None:
            alone.append(w)
        else:
            left.remove(m)
    if len(a) - len(alone) < need or len(rest) - len(alone) > most_slips(len(a)):
        return False
    named_a, named_b = [w for w in alone if w in rare_a], [w for w in left if w in rare_b]
    if not (named_a and named_b):
        return True
    # One long name with two slips, everything else paired.
    return len(alone) == len(left) == 1 and min(len(alone[0]), len(left[0])) >= 7 and two_slips(alone[0], left[0])


def fingerprint(words: list[str]) -> int:
    """64 bits; each word flips one. The Hamming distance is at most the number of words in which two texts differ."""
    f = 0
    for w in words:
        f ^= 1 << (xxhash.xxh32_intdigest(w) & 63)
    return f


class BKTree:
    """Burkhard-Keller tree over integers under Hamming distance, children keyed by the distance to their parent."""

    __slots__ = ("root", "visited")

    def __init__(self):
        self.root = None  # (fingerprint, payloads, {distance: node})
        self.visited = 0

    def add(self, f: int, payload) -> None:
        if self.root is None:
            self.root = (f, [payload], {})
            return
        node = self.root
        while True:
            d = (f ^ node[0]).bit_count()
            if d == 0:
                node[1].append(payload)
                return
            nxt = node[2].get(d)
            if nxt is None:
                node[2][d] = (f, [payload], {})
                return
            node = nxt

    def near(self, f: int, radius: int) -> Iterator:
        """All payloads within ``radius``: only edges d with |d - distance| <= radius are followed."""
        if self.root is None:
            return
        todo = [self.root]
        while todo:
            g, own, kids = todo.pop()
            self.visited += 1
            d = (f ^ g).bit_count()
            if d <= radius:
                yield from own
            for k, node in kids.items():
                if d - radius <= k <= d + radius:
                    todo.append(node)


class _Shards:
    """Per run of equal (block, shard pair): trees by title length, asked by the titles that query the block; verified links out."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, run, links = None, [], []
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(8)]
            for block, i, j, *row in zip(*cols):
                if (block, i, j) != now:
                    if len(run) > 1:
                        links += self.links(run, now[1] != now[2])
                    now, run = (block, i, j), []
                run.append(row)
            if len(links) > 10_000:
                yield self._out(links)
                links = []
        if len(run) > 1:
            links += self.links(run, now[1] != now[2])
        if links:
            yield self._out(links)

    @staticmethod
    def links(run: list, apart: bool) -> list[tuple[int, int]]:
        """Links of a run's rows (shard, asks, node, title, rare words); only across shards if ``apart``."""
        trees: dict[tuple[int, int], BKTree] = {}
        shards = sorted({r[0] for r in run})
        rows = []
        for shard, asks, node, t, rare in run:
            words = t.split(" ")
            rows.append((shard, asks, node, words, set(rare), fingerprint(words)))
            tree = trees.setdefault((shard, len(words)), BKTree())
            tree.add(rows[-1][5], rows[-1])
        up: dict[int, int] = {}

        def root(x):
            while x in up:
                x = up[x]
            return x

        out = []
        for shard, asks, node, words, rare, fp in rows:
            if not asks:
                continue
            m = len(words)
            for n in range(m, int(m / LONGER + 1e-9) + 1):
                for other in shards:
                    if apart and other == shard or (other, n) not in trees:
                        continue
                    for _, _, x, w, r, _ in trees[other, n].near(fp, radius(m, n)):
                        # Linked already inside this run: the components are the same without it.
                        a, b = root(node), root(x)
                        if a != b and same_story(words, w, rare, r):
                            up[a] = b
                            out.append((node, x))
        return out

    @staticmethod
    def _out(links):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])


def _slip_heads(vocabulary: DataFrame) -> DataFrame:
    """``w``, ``heads``, ``top``: of every word, the words a slip apart that more titles have, and the most titles one of them has.

    Words meet under themselves and under each form with a letter fewer; as
    many share one as an alphabet allows, however large the vocabulary is.
    """
    v = vocabulary.where((F.length("w") >= 2) & ~F.col("w").rlike(r"\d") & ~F.col("w").rlike(NO_SLIPS))
    fewer = F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.concat(F.substring(F.col("w"), F.lit(1), i - 1), F.substring(F.col("w"), i + 1, F.length("w"))))
    s = v.select("w", "n", F.explode(F.array_distinct(F.array_append(fewer, F.col("w")))).alias("s")).withColumn("s", F.xxhash64("s"))
    a, b = s.select("s", F.col("w").alias("w"), F.col("n").alias("n")), s.select("s", F.col("w").alias("h"), F.col("n").alias("hn"))
    more = (F.col("hn") > F.col("n")) | (F.col("hn") == F.col("n")) & (F.col("h") < F.col("w"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    far = F.levenshtein("w", "h")
    near = (far <= 1) | (far == 2) & (letters(F.col("w")) == letters(F.col("h")))
    p = merge_join(a, b, "s").where(more).select("w", "h", "hn").distinct().where(near)
    return p.groupBy("w").agg(F.collect_list("h").alias("heads"), F.max("hn").alias("top"))


def near_titles(df: DataFrame, id_col: str, title: str, *, rare_share: float = 2e-4, rare_least: int = 40, block_rows: int = 2000, levels: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between rows whose titles tell one story, enough to connect each story.

    Equal plain titles are one class; only class representatives (the least
    id) are compared, and no link that ``same_story`` finds between two
    classes is lost:

    * At most u = m - 0.8 m of the m words of the shorter title stay unpaired,
      so among any u + 1 of its words one is paired. A title asks under its
      u + 1 rarest words; every title is there to be found under all of its
      words, always under its numbers too. A word stands for itself and for
      the more frequent words a slip apart, and is as rare as the commonest of
      them: misspelt common words are not rare.
    * Where a word's block has more than ``block_rows`` titles it is divided by
      a second word in the same manner (again u + 1 of the asking title's
      other words), and so on, up to ``levels`` words. What is still larger is
      cut into shards that are compared shard by shard.
    * In a block, titles stand in BK-trees by their number of words, under
      fingerprints in which each word flips one of 64 bits. The radius follows
      from both lengths: no pair that ``same_story`` accepts is further apart.
      What a tree returns is checked word by word.

    Links that would join classes already joined in a block are not emitted.
    Null or empty titles take part in no link. Repeated rows fall in one
    class. Ids must be unique. Other columns are ignored.
    """
    members, put = title_blocks(df, id_col, title, rare_share, rare_least, block_rows, levels)
    put = put.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "shard", "node")
    return members.unionByName(put.mapInArrow(_Shards(), "a bigint, b bigint").distinct())


def title_blocks(df: DataFrame, id_col: str, title: str, rare_share: float, rare_least: int, block_rows: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Links of equal titles to the least id of their class, and the blocks in which classes are compared: see ``near_titles``."""
    d = cut(df.select(F.col(id_col).cast("bigint").alias("id"), _plain(F.col(title)).alias("t")).where("t <> ''"))
    classes = cut(d.groupBy("t").agg(F.min("id").alias("node")))
    members = merge_join(d, classes, "t").where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    rare_at = max(float(rare_least), rare_share * classes.count())
    words = classes.select("node", F.explode(F.array_distinct(F.split("t", " "))).alias("w"))
    vocabulary = cut(words.groupBy("w").agg(F.count("*").alias("n")))
    known = merge_join(vocabulary, _slip_heads(vocabulary), "w", "left").select("w", F.greatest("n", F.coalesce("top", "n")).alias("n"), F.transform(F.array_prepend(F.coalesce("heads", F.array().cast("array<string>")), F.col("w")), lambda x: F.xxhash64(x)).alias("keys"))
    # A title's words, rarest first; those with digits are its numbers.
    per = merge_join(words.where(~F.col("w").rlike(r"\d")), known, "w").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "w", "keys"))).alias("ws"))
    split = F.split("t", " ")
    nums = F.array_join(F.array_sort(F.filter(split, lambda x: x.rlike(r"\d"))), " ")
    m = F.size(split)
    ws = F.coalesce("ws", F.array().cast("array<struct<n:bigint,w:string,keys:array<bigint>>>"))
    per = cut(merge_join(classes, per, "node", "left").select(
        "node", "t", nums.alias("nums"), (m - F.ceil(F.lit(SHORTER) * m - 1e-9)).cast("int").alias("u"), ws.alias("ws"),
        F.filter(F.array_distinct(split), lambda x: F.size(F.filter(split, lambda y: y == x)) > 1).alias("again"),
    ))
    rare = F.transform(F.filter("ws", lambda x: (x["n"] <= rare_at) & (F.length(x["w"]) >= MIN_NAME)), lambda x: x["w"])

    def keyed(rows: DataFrame, left, end) -> DataFrame:
        """Block rows: one a word of ``left`` and key of it; the first u + 1 words ask. Where ``end`` holds, one more without a word."""
        none = F.struct(F.lit(2**62).cast("bigint").alias("n"), F.lit("").alias("w"), F.array(F.lit(0).cast("bigint")).alias("keys"))
        ws = F.when(end, F.array_append(left, none)).otherwise(left)
        r = rows.select("key", "node", "asks", "used", "u", F.posexplode(ws).alias("rank", "x"))
        r = r.select("key", "node", (F.col("asks") & (F.col("rank") <= F.col("u"))).alias("asks"), F.array_append("used", F.col("x.w")).alias("used"), F.explode("x.keys").alias("k"))
        return r.select(F.xxhash64("key", "k").alias("key"), "node", "asks", "used")

    start = per.select(F.xxhash64("nums").alias("key"), "node", F.lit(True).alias("asks"), F.array().cast("array<string>").alias("used"), "u", "ws", (F.col("nums") != "").alias("end"))
    rows = keyed(start, F.col("ws"), F.col("end"))
    ready = None
    for level in range(1, levels + 1):
        # A title may come under one key by two of its words; it is there once.
        rows = rows.groupBy("key", "node").agg(F.max("asks").alias("asks"), F.min("used").alias("used")) if level == levels else rows
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.count_if("asks").alias("asking")).where("size > 1 AND asking > 0").select("key", "size")
        rows = cut(merge_join(rows, sizes, "key"))
        small = rows if level == levels else rows.where(F.col("size") <= block_rows)
        small = small.select("key", "node", "asks", "size")
        ready = small if ready is None else ready.unionByName(small)
        rows = rows.where(F.col("size") > block_rows)
        if level == levels or not rows.head(1):
            break
        rows = merge_join(rows.select("key", "node", "asks", "used"), per.select("node", "u", "ws", "again"), "node")
        rows = keyed(rows, F.filter("ws", lambda x: ~F.array_contains("used", x["w"]) | F.array_contains("again", x["w"])), F.lit(True))
    s = F.ceil(F.col("size") / block_rows).cast("int")
    put = merge_join(ready, per.select("node", "t", rare.alias("rare")), "node").withColumn("s", s).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda o: F.struct(F.least(o, F.col("shard")).alias("i"), F.greatest(o, F.col("shard")).alias("j")))
    return members, put.withColumn("ij", F.explode(pairs)).select(F.col("key").alias("block"), F.col("ij.i").alias("i"), F.col("ij.j").alias("j"), "shard", "asks", "node", "t", "rare")


def same_pages(df: DataFrame, id_col: str, url: str) -> DataFrame:
    """Links ``a``, ``b`` from every row to the least id of its page; rows without a URL have none."""
    d = cut(df.select(F.col(id_col).cast("bigint").alias("id"), page_key(F.col(url)).alias("page")).where("page IS NOT NULL"))
    least = d.groupBy("page").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return merge_join(d, least, "page").where("id <> b").select(F.col("id").alias("a"), "b")


def stories(df: DataFrame, id_col: str = "id", title: str = "title_en", url: str = "url", **options) -> DataFrame:
    """``id``, ``story``: rows linked by title or page, closed under links; rows without a link are left out."""
    return components(near_titles(df, id_col, title, **options).unionByName(same_pages(df, id_col, url))).select(F.col("node").alias("id"), F.col("root").alias("story"))
