"""Regular grids and rolling totals against plain loops."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from grainloom.operators import grid, rolling
from grainloom.operators.rolling import TwoStackQueue


def brute_grid(points):
    """Day grid of one key: {cell: (readings, increment, value)} by linear interpolation."""
    best = {}
    for t, v in points:
        best[t] = max(v, best.get(t, v))
    ts = sorted(best)
    out = {ts[0]: (1, 0.0, float(best[ts[0]]))} if ts else {}
    for a, b in zip(ts, ts[1:]):
        x, y = best[a], best[b]
        reset = y < 0.5 * x
        inc, start = (y, 0.0) if reset else (y - x, x)
        for d in range(a + 1, b + 1):
            out[d] = (int(d == b), inc / (b - a), float(y) if d == b else start + inc * (d - a) / (b - a))
    return out


def test_day_grid_against_loop(spark):
    rnd = random.Random(1)
    rows, want = [], {}
    for k in ("a", "b", None):
        pts, v = [], 100
        for t in sorted(rnd.sample(range(0, 3000), 40)):
            v = v + rnd.randint(-3, 20) if rnd.random() > 0.1 else rnd.randint(0, 10)
            pts.append((t, max(0, v)))
        pts += rnd.choices(pts, k=5)
        rows += [(k, t, v, "x") for t, v in pts]
        want |= {(k, c): w for c, w in brute_grid(pts).items()}
    rows += [("a", None, 5, "x"), ("b", 7, None, "x")]
    df = spark.createDataFrame(rows, "k string, at bigint, v int, cell string")  # a clashing name
    got = {(r["k"], r["cell"]): r for r in grid.regular_grid(df, ["k"], "at", "v").collect()}
    assert got.keys() == want.keys()
    for key, (n, inc, value) in want.items():
        r = got[key]
        assert r["readings"] == n and abs(r["increment"] - inc) < 1e-9 and abs(r["value"] - value) < 1e-9
        assert r["mark"] == ("observed" if n else "filled")


def test_wide_cells_keep_the_total(spark):
    df = spark.createDataFrame([("a", 5, 10), ("a", 12, 24), ("a", 31, 81), ("a", 33, 3)], "k string, at bigint, v int")
    g = grid.regular_grid(df, ["k"], "at", "v", cell=10).orderBy("cell").collect()
    assert [r["cell"] for r in g] == [1, 2, 3, 4]
    assert abs(sum(r["increment"] for r in g) - (14 + 57 + 3)) < 1e-9
    assert abs(g[0]["increment"] - 10) < 1e-9  # 5 of the 7 units to the second reading
    assert g[2]["readings"] == 0 and g[2]["mark"] == "filled"
    assert g[3]["resets"] == 1


def test_long_gaps_are_uncovered_and_empty_is_empty(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 12), ("a", 40, 50)], "k string, at bigint, v int")
    g = grid.regular_grid(df, ["k"], "at", "v", max_gap=10).collect()
    assert sum(r["mark"] == "uncovered" for r in g) == 36 and sum(r["mark"] == "filled" for r in g) == 1
    assert grid.regular_grid(df.limit(0), ["k"], "at", "v").count() == 0


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), max_size=60), st.integers(1, 9))
def test_two_stack_queue(xs, n):
    q, m = TwoStackQueue(lambda a, b: a + b, 0), TwoStackQueue(max, -1000)
    for i, x in enumerate(xs):
        q.push(x)
        m.push(x)
        if len(q) > n:
            q.pop()
            m.pop()
        win = xs[max(0, i - n + 1) : i + 1]
        assert q.value() == sum(win) and m.value() == max(win)


def test_rolling_against_loop(spark):
    rnd = random.Random(2)
    rows = [(e, d, float(rnd.randint(-5, 30))) for e in ("x", "y") for d in rnd.sample(range(900, 3300), 60)]
    rows += [("x", rows[0][1], 4.0), ("one", 5, 1.0), (None, 1, 1.0), ("y", None, 1.0), ("y", 3, None)]
    df = spark.createDataFrame(rows, "e string, d bigint, a double").selectExpr("*", "1 as day", "2 as sum_7")
    got = {(r["e"], r["day"]): r for r in rolling.rolling_totals(df, "e", "d", "a").collect()}
    by = {}
    for e, d, a in rows:
        if e is not None and d is not None and a is not None:
            by.setdefault(e, {}).setdefault(d, 0.0)
            by[e][d] += a
    n = 0
    for e, days in by.items():
        first = min(days)
        for d in range(first, max(days) + 1):
            r = got[e, d]
            n += 1
            for p in (7, 30):
                win = [days.get(x, 0.0) for x in range(max(first, d - p + 1), d + 1)]
                assert abs(r[f"sum_{p}"] - sum(win)) < 1e-6 and abs(r[f"avg_{p}"] - sum(win) / p) < 1e-6 and r[f"max_{p}"] == max(win)
            assert r["active"] == (d in days)
    assert n == len(got)


def test_rolling_until_and_empty(spark):
    df = spark.createDataFrame([("x", 10, 5.0), ("x", 50, 9.0)], "e string, d bigint, a double")
    r = rolling.rolling_totals(df, "e", "d", "a", (7,), until=20).orderBy("day").collect()
    assert [x["day"] for x in r] == list(range(10, 21)) and r[-1]["sum_7"] == 0.0 and r[6]["sum_7"] == 5.0
    assert rolling.rolling_totals(df.limit(0), "e", "d", "a").count() == 0
