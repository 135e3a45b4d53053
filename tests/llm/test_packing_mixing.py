"""Containers and mixtures: nothing lost, nothing split without need, targets met."""

import os
import random

import pytest
from pyspark.sql import functions as F

from grainloom.llm import mixing, packing, tokens


def sizes(spark, n=3000, seed=10):
    r = random.Random(seed)
    rows = [(i, r.choices(["big", "mid", "small"], [6, 3, 1])[0], int(r.lognormvariate(5, 1)) + 1) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")


@pytest.mark.parametrize("task_tokens", [10**9, 40_000])
def test_packing_keeps_everything(spark, task_tokens):
    rows, df = sizes(spark)
    rows += [(9001, None, 5), (9002, "big", 0), (9003, "mid", 1000), (9004, "mid", 1001), (9005, "mid", 2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint").selectExpr("*", "1 as window", "'x' as container")
    p = packing.pack(df, [("a", 1000), ("b", 4000)], task_tokens=task_tokens).collect()
    size = {d: t for d, _, t in rows}
    for kind, cap in (("a", 1000), ("b", 4000)):
        own = [x for x in p if x["container"] == kind]
        fill, pieces, tops = {}, {}, {}
        for x in own:
            key = (x["part"], x["window"])
            fill[key] = fill.get(key, 0) + x["tokens"]
            tops[key] = x["window_tokens"]
            pieces.setdefault(x["doc_id"], []).append((x["piece"], x["tokens"]))
        assert fill == tops and max(fill.values()) <= cap
        assert {d: sum(t for _, t in v) for d, v in pieces.items()} == {d: t for d, t in size.items() if t}
        assert all(len(v) == 1 or size[d] > cap for d, v in pieces.items())
        assert all(len({n for n, _ in v}) == len(v) for v in pieces.values())
        assert sum(fill.values()) / (cap * len(fill)) > 0.97
    assert packing.pack(df.limit(0), [("a", 10)]).count() == 0


@pytest.mark.parametrize("low,high", [(600, 600), (400, 899)])
def test_sizes_that_fill_no_window_end_in_no_last_task(spark, low, high):
    """Where items can't fill windows, rounds end and no task is given more than its bound allows."""
    r = random.Random(2)
    rows = [(i, r.choice("abc"), r.randint(low, high)) for i in range(3000)]
    p = packing.pack(spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint"), [("x", 1000)], task_tokens=40_000).collect()
    assert sorted(x["doc_id"] for x in p) == list(range(3000))
    tasks = {}
    for x in p:
        tasks[x["part"]] = tasks.get(x["part"], 0) + x["tokens"]
    assert max(tasks.values()) < 2 * 40_000


def test_null_ids_and_many_sources(spark):
    """Items without an id are packed; sources beyond those with queues of their own share one and keep their names."""
    rows = [(None, "a", 30), (None, "b", 40)] * 50 + [(i, f"s{i % 90}", 10 + i % 70) for i in range(2000)]
    p = packing.pack(spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint"), [("x", 500)], task_tokens=20_000, own_queues=5).collect()
    assert sorted((x["doc_id"] is None, x["source"], x["tokens"]) for x in p) == sorted((d is None, s, n) for d, s, n in rows)
    assert sum(n for _, _, n in rows) / (500 * len({(x["part"], x["window"]) for x in p})) > 0.95


def next_fit(rows, capacity):
    out, full = [{}], 0
    for _, s, n in rows:
        if full + n > capacity:
            out.append({})
            full = 0
        out[-1][s] = out[-1].get(s, 0) + n
        full += n
    return out


def distance(windows, target):
    return sum(sum(abs(w.get(s, 0) / sum(w.values()) - t) for s, t in target.items()) for w in windows) / len(windows)


def test_mixture_beats_next_fit(spark):
    rows, df = sizes(spark, 6000)
    total = sum(n for _, _, n in rows)
    target = {s: sum(n for _, x, n in rows if x == s) / total for s in ("big", "mid", "small")}
    p = packing.pack(df, [("x", 4000)])
    got = {r["source"]: r for r in packing.mixture(p).collect()}
    assert set(got) == set(target) and all(abs(got[s]["target_share"] - t) < 0.01 for s, t in target.items())
    windows = {}
    for x in p.collect():
        w = windows.setdefault((x["part"], x["window"]), {})
        w[x["source"]] = w.get(x["source"], 0) + x["tokens"]
    assert abs(distance(windows.values(), target) - got["big"]["window_l1"]) < 0.01
    assert got["big"]["window_l1"] < 0.5 * distance(next_fit(rows, 4000), target)


def test_windows_follow_the_mixture():
    q = packing.Queues()
    for s, n in (("x", 600), ("y", 300), ("z", 100)):
        for i in range(n):
            q.put(s, 10, (s, i))
    w = list(packing.fill_windows(q, 1000, {"x": 0.6, "y": 0.3, "z": 0.1}, {}))
    assert len(w) == 10 and all(sum(n for s, n, _ in x if s == "x") in range(580, 621) for x in w)


def exact(rows, t):
    own = [r for r in rows if r[1] == t["source"] and r[2] > 0]
    have, goal = sum(r[2] for r in own), t["target_share"] * t["budget_tokens"]
    return min(goal, have * t["max_repeats"]), max((r[2] for r in own), default=0)


def test_mixing_meets_targets(spark):
    rows, df = sizes(spark)
    rows += [(9001, "big", 0), (9002, None, 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint").selectExpr("*", "1 as uses", "2 as b")
    total = sum(t for _, _, t in rows)
    for share in (0.1, 0.6, 2.5):
        ts = [{"source": s, "target_share": w, "max_repeats": m, "budget_tokens": int(total * share)} for s, w, m in (("big", 0.3, 1), ("mid", 0.4, 2), ("small", 0.25, 8), ("absent", 0.05, 3))]
        drawn, report = mixing.draw(df, ts)
        got = {r["source"]: r for r in mixing.shares(drawn, report).collect()}
        for t in ts:
            want, step = exact(rows, t)
            assert abs(got[t["source"]]["drawn_tokens"] - want) <= step / 2 + 1
            assert got[t["source"]]["most_uses"] <= t["max_repeats"]
    assert mixing.draw(df.limit(0), ts)[0].count() == 0 and mixing.draw(df, [])[0].count() == 0


def test_larger_budget_draws_a_superset(spark):
    _, df = sizes(spark)
    at = lambda n: {r["doc_id"] for r in mixing.draw(df, [{"source": "big", "target_share": 1.0, "max_repeats": 1, "budget_tokens": n}])[0].collect()}
    assert at(20_000) < at(60_000)


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "안녕하세요 " * 5000)], "id bigint, t string")
    n = {r["id"]: r["tokens"] for r in tokens.with_tokens(df, ["id"], "t").collect()}
    assert n[1] == 2 and n[2] == 0 and n[3] == 0 and n[4] > 5000
