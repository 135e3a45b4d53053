"""Top-n and near-duplicates against brute force, with nulls, ties, repeats, empty tables and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from grainloom import session
from grainloom.llm import graph, neardup, queries, topn


def test_top_n_against_sort(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", None, ""]), rnd.choice([1, 2, 3, None]), "x") for i in range(800)]
    rows += [(900 + i, "hot", i % 7, "x") for i in range(600)] + [(2000, "single", 1, None)]
    df = spark.createDataFrame(rows, "id int, g string, s int, _group string").repartition(7)
    got = topn.top_n(df, [F.col("g")], [F.col("s").desc_nulls_last(), F.col("id")], 5)
    assert got.columns == df.columns
    have = {}
    for r in got.collect():
        have.setdefault(r["g"], []).append(r["id"])
    for g in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        assert sorted(have[g]) == sorted(r[0] for r in own[:5])
    assert topn.top_n(df.limit(0), [F.col("g")], [F.col("id")], 3).count() == 0


def test_first_n_across_batches():
    import pyarrow as pa

    run = topn._FirstN(3, "k")
    b = [pa.RecordBatch.from_pydict({"k": k, "v": v}) for k, v in (([1, 1], [0, 1]), ([1, 1, 2], [2, 3, 4]), ([], []), ([2, 2, 2], [5, 6, 7]))]
    b[2] = b[0].slice(0, 0)
    assert [x for o in run(iter(b)) for x in o.column("v").to_pylist()] == [0, 1, 2, 4, 5, 6]


def test_groups_that_share_a_hash_stay_apart():
    import pyarrow as pa

    run = topn._FirstN(2, "k", ["g", "x"])
    nan = float("nan")
    cols = {"k": [7] * 9, "g": [None, None, None, "a", "a", "b", "b", "b", "b"], "x": [1.0] * 3 + [nan, nan] + [nan, nan, nan, 2.0], "v": list(range(9))}
    whole = pa.RecordBatch.from_pydict(cols)
    for cut in (9, 4, 6, 1):
        out = run(iter([whole.slice(0, cut), whole.slice(cut)]))
        assert [x for o in out for x in o.column("v").to_pylist()] == [0, 1, 3, 4, 5, 6, 8]


def test_bk_tree_finds_all_within_radius():
    rnd = random.Random(4)
    fs = [rnd.getrandbits(64) for _ in range(300)]
    fs += [f ^ (1 << rnd.randrange(64)) for f in fs[:50]] + fs[:10]
    t = neardup.BKTree()
    for i, f in enumerate(fs):
        t.add(f, i)
    for f in fs[:60]:
        assert sorted(t.near(f, 5)) == [i for i, g in enumerate(fs) if (f ^ g).bit_count() <= 5]
    assert list(neardup.BKTree().near(1, 3)) == []


def test_slips():
    assert neardup.close("typed", "ytped") and neardup.close("behind", "beind") and neardup.close("and", "annd") and neardup.close("and", "rnd")
    assert not neardup.close("2024", "2025") and not neardup.close("part", "cast") and neardup.close("a", "a") and not neardup.close("a", "b")


def test_page_key(spark):
    same = ["http://www.Site.example/a/b/?utm_source=x&id=7#top", "https://site.example/a/b?id=7&fbclid=q", "site.example/a/b/?id=7"]
    other = ["https://site.example/a/b?id=8", "https://site.example/a/B?id=7", "https://site.example/a?id=7"]
    df = spark.createDataFrame([(u,) for u in [*same, *other, None, " "]], "u string")
    got = [r[0] for r in df.select(neardup.page_key(F.col("u"))).collect()]
    assert len(set(got[:3])) == 1 and len(set(got[:6])) == 4 and got[6:] == [None, None]


def _stories(spark, rows, **k):
    df = spark.createDataFrame(rows, "id bigint, title_en string, url string").selectExpr("*", "1 as node", "2 as t")
    out = {}
    for r in neardup.stories(df, **k).collect():
        out.setdefault(r["story"], set()).add(r["id"])
    return sorted(map(sorted, out.values()))


def test_stories(spark):
    rows = [
        (1, "Running Kagomedri on Bosetaflu without a typed queue", "https://a.example/1"), (2, "Show HN: running kagomedri on bosetaflu without a ytped queue", "https://b.example/2"),
        (3, "RUNNING KAGOMEDRI ON BOSETAFLU WITHOUT A TYPED QUEUE [repost]", "https://c.example/3"), (4, "Without a typed queue: Running Kagomedi on Bosetaflu", None),
        (5, "Running Kagomedri on Traliposa without a typed queue", "https://d.example/5"), (6, "Kagomedri 1.4 brings warm caches", "https://e.example/6"), (7, "Kagomedri 2.4 brings warm caches", "https://f.example/7"),
        (8, "Nothing alike at all", "http://www.e.example/6/?ref=x"), (9, None, None), (10, "", ""), (11, None, "https://g.example"), (12, "Rυnning Kagomedri on Bosetaflu without a typed queue", "https://h.example"),
    ]
    want = [[1, 2, 3, 4, 12], [6, 8]]
    assert _stories(spark, rows) == want
    # Blocks of one row each: no pair is lost.
    assert _stories(spark, rows, block_rows=1) == want and _stories(spark, rows, block_rows=1, levels=1) == want
    assert _stories(spark, []) == []
    assert neardup.stories(spark.createDataFrame([], "id bigint, title_en string, url string")).count() == 0


def slipped(r, w):
    i = r.randrange(len(w))
    return r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("aeiou") + w[i + 1 :], w[:i] + "x" + w[i:], w[: i + 1][::-1] + w[i + 1 :] if i == 1 else w])


def made_titles(r, n):
    """Titles of few templates and names: many blocks are hot, many words are slips of others."""
    names = ["".join(r.choice(["ka", "go", "me", "dri", "bo", "se", "ta", "flu", "ri"]) for _ in range(3)) for _ in range(40)]
    forms = ["running {} on {} without a typed queue", "why we moved from {} to {}", "{} {} brings warm caches", "the lazy webhook behind {} and {} in one large old shop of ours", "{} notes"]
    out = []
    for _ in range(n):
        ws = r.choice(forms).format(*r.choices(names, k=2)).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            i = r.randrange(len(ws))
            k = r.randrange(5)
            if k < 2:
                ws[i] = slipped(r, ws[i]) or "a"
            elif k == 2 and len(ws) > 2:
                del ws[i]
            elif k == 3:
                ws.insert(i, r.choice(["repost", "video", "the", "2024", "show"]))
            else:
                ws = ws[i:] + ws[:i]
        out.append(" ".join(ws))
    return out


def brute_stories(titles, rare_at):
    """Classes of titles linked by ``same_story``, every pair compared."""
    words = {w for t in titles for w in t.split()}
    count = {w: sum(w in t.split() for t in set(titles)) for w in words}
    common = {w: max(count[x] for x in words if neardup.close(w, x)) for w in words}
    rare = lambda ws: {w for w in ws if common[w] <= rare_at and len(w) >= neardup.MIN_NAME and not any(c.isdigit() for c in w)}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    ts = sorted(set(titles))
    for i, a in enumerate(ts):
        for b in ts[i + 1 :]:
            x, y = a.split(), b.split()
            if neardup.same_story(x, y, rare(x), rare(y)):
                assert (neardup.fingerprint(x) ^ neardup.fingerprint(y)).bit_count() <= neardup.radius(*sorted((len(x), len(y))))
                up[find(a)] = find(b)
    out = {}
    for i, t in enumerate(titles):
        out.setdefault(find(t), []).append(i)
    return sorted(v for v in out.values() if len(v) > 1)


@pytest.mark.parametrize("block_rows,levels,rare", [(2000, 4, 40), (6, 3, 4), (3, 1, 8), (1, 4, 3)])
def test_no_link_is_lost(spark, block_rows, levels, rare):
    titles = made_titles(random.Random(block_rows), 260)
    titles += ["kagomeri of twelve words and then some more words to be long enough here now", "kagomeri of twelve words and then some more wrods to be lnog enough here yes", "42 1000", "42 1000 foo", "42 1000 bar", "안녕 세계", "안영 세계", "a a a a b", "a a a a c"]
    rows = [(i, t, None) for i, t in enumerate(titles)]
    assert _stories(spark, rows, block_rows=block_rows, levels=levels, rare_least=rare) == brute_stories(titles, rare)


def test_no_join_goes_through_the_driver(spark, sf, monkeypatch):
    """Tables small enough to be broadcast are small by an estimate only; the driver must not gather them."""
    plans = []

    def cut(df):
        out = session.cut(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    for m in (neardup, graph, queries):
        monkeypatch.setattr(m, "cut", cut)
    df = queries.p5_found(spark, sf)
    assert df.collect()
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 8 and any("SortMergeJoin" in x for x in plans)
    assert not any("Broadcast" in x for x in plans)


def test_hot_class_of_exact_copies(spark):
    rows = [(i, "The very same title for Everyone here", None) for i in range(500)] + [(1000, "The very same title for Evryone here", None)]
    got = _stories(spark, rows)
    assert len(got) == 1 and len(got[0]) == 501


def test_components_against_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    want = {x: find(x) for x in up}
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
