"""Sources mixed to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.session import cut

BITS = 12  # of the hash that one histogram resolves
LEVELS = 5  # 60 bits in all: more than tells any two rows apart


def draw(sizes: DataFrame, targets: list[dict], seed: int = 0) -> tuple[DataFrame, list[dict]]:
    """Documents drawn towards target shares, and a report per target source.

    ``sizes``: ``doc_id``, ``source`` (normalised), ``tokens``. ``targets``:
    dicts of ``source``, ``target_share``, ``max_repeats``, ``budget_tokens``.
    Each source aims at T = share * budget tokens out of the A it has. Every
    document is used floor(T / A) times, and those whose hash falls below a
    threshold once more, never more than ``max_repeats`` times; a source that
    can't reach T under its cap gives all it may.

    The threshold is found without a sort: tokens are summed by source and the
    top 12 bits of the hash; the bucket in which the running sum passes the
    wanted rest is resolved by its next 12 bits, and so on. A histogram has at
    most 4096 rows for each target source. Which documents are drawn depends
    on id and seed alone: a larger budget draws a superset.

    Rows of no tokens and of sources without a target are not drawn. An empty
    table draws nothing. Repeated ids are drawn together.
    """
    names = [t["source"] for t in targets]
    h = F.xxhash64(F.col("doc_id"), F.lit(seed))
    top = lambda lv: F.shiftrightunsigned(h, 64 - BITS * (lv + 1)).bitwiseAND(F.lit((1 << BITS) - 1))
    d = cut(sizes.where(F.col("tokens") > 0).where(F.col("source").isin(names) if names else F.lit(False)).select("doc_id", "source", "tokens"))
    have = {n: 0 for n in names}
    plan: dict[str, list[int]] = {}  # prefix of hash pieces, all lower hashes drawn once more
    left: dict[str, float] = {}
    base: dict[str, int] = {}
    for lv in range(LEVELS):
        if lv == 0:
            part = d
        else:
            at = None
            for s in left:
                here = F.col("source") == F.lit(s)
                for i, v in enumerate(plan[s]):
                    here = here & (top(i) == v)
                at = here if at is None else at | here
            if at is None:
                break
            part = d.where(at)
        rows = part.groupBy("source", top(lv).alias("b")).agg(F.sum("tokens").alias("n")).collect()
        own = defaultdict(dict)
        for r in rows:
            own[r["source"]][r["b"]] = r["n"]
        if lv == 0:
            for t in targets:
                s = t["source"]
                have[s] = sum(own[s].values())
                goal = (t["target_share"] or 0.0) * (t["budget_tokens"] or 0)
                cap = t["max_repeats"] or 0
                k = int(goal // have[s]) if have[s] else 0
                base[s] = min(k, cap)
                if have[s] and k < cap and goal - k * have[s] > 0:
                    left[s], plan[s] = goal - k * have[s], []
        for s in list(left):
            run, bound = 0.0, None
            for b in sorted(own[s]):
                if run + own[s][b] > left[s]:
                    bound = b
                    break
                run += own[s][b]
            if bound is None:  # all of it fits
                plan[s] = [*plan[s], 1 << BITS]
                left.pop(s)
            else:
                left[s] -= run
                # At the end the last document goes in if that comes nearer to the goal.
                nearer = lv == LEVELS - 1 and own[s][bound] < 2 * left[s]
                plan[s] = [*plan[s], bound + nearer]
    uses = F.lit(0)
    for t in targets:
        s = t["source"]
        more = F.lit(False)
        for i in reversed(range(len(plan.get(s, [])))):
            v = plan[s][i]
            more = (top(i) < v) | ((top(i) == v) & more)
        uses = F.when(F.col("source") == s, F.lit(base.get(s, 0)) + more.cast("int")).otherwise(uses)
    drawn = d.withColumn("uses", uses.cast("int")).where("uses > 0")
    return drawn, [{**t, "available_tokens": have[t["source"]]} for t in targets]


def shares(drawn: DataFrame, report: list[dict]) -> DataFrame:
    """Per target source: available and drawn tokens, documents, share of the budget and of all that is drawn."""
    spark = drawn.sparkSession
    t = spark.createDataFrame([(r["source"], r["target_share"], r["max_repeats"], r["budget_tokens"], r["available_tokens"]) for r in report], "source string, target_share double, max_repeats int, budget_tokens bigint, available_tokens bigint")
    g = drawn.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("uses")).alias("drawn_tokens"), F.max("uses").alias("most_uses"))
    j = t.join(g, "source", "left").fillna(0, ["documents", "drawn_tokens", "most_uses"])
    every = g.agg(F.coalesce(F.sum("drawn_tokens"), F.lit(0))).first()[0]
    return j.withColumn("share_of_budget", F.col("drawn_tokens") / F.col("budget_tokens")).withColumn("actual_share", F.col("drawn_tokens") / F.lit(every or 1))
