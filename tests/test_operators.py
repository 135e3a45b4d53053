"""Upserts, mirrors, lookups, text functions and Arrow functions on small cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from grainloom.functions import numbers as N
from grainloom.functions import scoring as S
from grainloom.functions import text as T
from grainloom.functions import udfs as U
from grainloom.operators import relational as R
from grainloom.operators.similar import similar_titles
from grainloom.operators.timeseries import monotonic, star_rollup
from grainloom.plans import pipelines
from grainloom.streaming import streams


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, c, **v):
    d = spark.range(1).select(*[F.lit(x).alias(k) for k, x in v.items()]) if v else spark.range(1)
    return d.select(c).first()[0]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 0)], "k int, v string, w int")
    s = spark.createDataFrame([(2, "", 9), (3, "c", 1), (3, "d", 2), (None, "m", 7)], "k int, v string, w int")
    r = R.upsert(t, s, ["k"], order=[F.col("w").desc()], keep_if_blank=["v"])
    want = [(1, "a", 5), (2, "b", 9), (3, "d", 2), (None, "m", 7)]
    assert rows(r) == sorted(want, key=str)
    assert rows(R.upsert(r, s, ["k"], order=[F.col("w").desc()], keep_if_blank=["v"])) == sorted(want, key=str)


def test_mirror_and_its_guard(spark):
    t = spark.createDataFrame([("u1", "a", 1), ("u2", "b", 2)], "url string, d string, n int")
    s = spark.createDataFrame([("u2", "", 5), ("u3", "c", 6)], "url string, d string, n int")
    m = lambda x: R.snapshot_mirror(t, x, "url", refresh=["d", "n"], keep_if_blank=["d"])
    assert rows(m(s)) == [("u2", "b", 5), ("u3", "c", 6)]
    assert rows(m(s.limit(0))) == rows(t)


def test_children_fallback_lookup(spark):
    c = spark.createDataFrame([(1, "x"), (2, "y")], "p int, v string")
    assert rows(R.replace_children(c, spark.createDataFrame([(1,)], "p int"), c.limit(0), "p")) == [(2, "y")]
    assert rows(R.fallback_union(c, spark.createDataFrame([(2, "no"), (3, "z")], "p int, v string"), "p")) == [(1, "x"), (2, "y"), (3, "z")]
    d = spark.createDataFrame([("m1", None), (None, "e1"), ("m1", "e2"), ("zz", "zz")], "m string, e string")
    dim = spark.createDataFrame([(7, "m1", "e9"), (8, "m2", "e1"), (9, "m3", "e2")], "id int, model string, ext string")
    assert rows(R.two_pass_lookup(d, dim, [("m", "model"), ("e", "ext")], "id", "hit").select("hit")) == [(7,), (7,), (8,), (None,)]


def test_score_edges(spark):
    as_of = F.lit("2025-01-31 00:00:00").cast("timestamp_ntz")
    def score(src, stars, up, com, ts):
        d = spark.createDataFrame([(src, stars, up, com, ts)], "s string, st int, u int, c int, t string")
        return d.select(S.score(F.col("s"), F.col("st"), F.col("u"), F.col("c"), F.col("t").cast("timestamp_ntz"), as_of)).first()[0]
    assert score("github", 100, None, None, "2025-02-05 00:00:00") == 400  # the future sits on the plateau
    assert score("devto", 999, 10, 4, "2025-01-29 00:00:00") == 22
    assert score("reddit", 5, 7, 50, "2025-01-30 12:00:00") == 21
    assert score("devto", None, 1000, 0, "2025-01-10 00:00:00") == 1
    assert score("devto", None, None, None, "2025-01-30 00:00:00") == 1


@pytest.mark.parametrize("v,want", [("0", 0), ("0.774", 77.4), ("1", 100), ("1.0001", 1.0), ("36", 36), ("-0.5", -50), ("0.77445", 77.44), ("0.77455", 77.46), (None, None), ("x", None)])
def test_percentage(spark, v, want):
    got = one(spark, N.percentage(F.lit(v).cast("string")))
    assert got is None if want is None else float(got) == want


@pytest.mark.parametrize("v,want", [("1,234", 1234), ("1.2k", 1200), ("1K", 1000), ("", 0), ("n/a", 0), (None, 0)])
def test_star_count(spark, v, want):
    assert one(spark, N.star_count(F.lit(v).cast("string"))) == want


@pytest.mark.parametrize("v,want", [("—", None), ("NA", None), ("1,234.9", 1234), ("abc", None), ("inf", None), (" 7 ", 7)])
def test_lenient_int(spark, v, want):
    assert one(spark, N.lenient_int(F.lit(v))) == want


@pytest.mark.parametrize("s,want", [("Authorization: Bearer abc, x", "Authorization: Bearer ***REDACTED***, x"), ("TOKEN = q; r", "TOKEN = ***REDACTED***; r"), ("a?access_token=1 b=2", "a?access_token=***REDACTED*** b=2"), ("a?access_token=1&b=2", "a?access_token=***REDACTED***"), ("Api-Key: z", "Api-Key: ***REDACTED***"), ("cookie=c session : s", "cookie=***REDACTED*** session : ***REDACTED***")])
def test_redaction(spark, s, want):
    assert one(spark, T.redact(F.lit(s))) == want


def test_redaction_of_all_documents(spark, sf, tmp_path):
    """Every document has a row, those of all seven patterns and null texts included."""
    import hashlib
    import re

    from grainloom.plans import catalogue

    ends = {"bearer +": ",;", "token *[=:] *": ",;", "access_token=": "&", "api[_-]?key *[=:] *": ",;", "secret *[=:] *": ",;", "cookie *[=:] *": ",;", "session *[=:] *": ",;"}

    def digest(t):
        for begin, end in ends.items():
            t = re.sub("(" + begin.replace(" ", r"\s") + rf")[^\s{end}]+", r"\1***REDACTED***", t, flags=re.I | re.A)
        return hashlib.md5(t.encode()).hexdigest()

    made = ["Bearer a.b, c", "token=x; y", "u?access_token=1&b=2", "API_KEY : k", "apikey=k", "secret=s", "Cookie: c; d", "session=z", "plain", "", None, "cookie session bearer api-key"]
    spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for d in (str(tmp_path), sf):
        want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
        got = {r["doc_id"]: r["digest"] for r in catalogue.QUERIES["redact_documents"](spark, d).collect()}
        assert got == {i: None if t is None else digest(t) for i, t in want.items()}


def test_release_notes(spark):
    t = lambda a, b: one(spark, T.labels(F.lit(a), F.lit(b)))
    assert t("The author's address", "") == ["security", "feature"]  # substrings over-match on purpose
    assert t("", "") == ["misc"]
    w = lambda a, b: spark.range(1).select(T.type_scores(F.lit(a), F.lit(b)).alias("s")).select(T.types_of(F.col("s"))).first()[0]
    assert w("Fix bug", "## Fixes\nsecurity") == ["security", "fix"]
    assert w("perf", "latency") == ["perf"] and w("x", "y") == ["misc"] and w("", "new") == ["feature"]
    assert one(spark, T.impact(F.array(*map(F.lit, ("security", "breaking", "feature", "fix", "perf"))))) == 10
    assert one(spark, T.bullets(F.lit("- a -\n  - b\n---\nno\n-c\n- d\n- e\n- f"))) == ["a", "b", "", "c", "d"]
    assert one(spark, T.clean_tags(F.array(*map(F.lit, (" Go Lang", "go-lang", "", "X"))))) == ["go-lang", "x"]


def test_page_text(spark):
    p = lambda h, **k: one(spark, T.page_text(F.lit(h), **k))
    assert p("<body><nav>n</nav><main> a <b>b</b></main>c</body>") == "a\nb"
    assert p("<body><p>only</p><script>x</script></body>") == "only" and p("<p>none</p>") == ""
    assert p("<body>" + "x" * 30 + "</body>", limit=10) == "x" * 10 + "\n\n[Content truncated]"


def test_salvage():
    import json

    ok = lambda s: json.loads(U.salvage(s))
    assert ok('```json\n[{"a": 1,}]\n```') == [{"a": 1}]
    assert ok('{"articles": [{"a": "x\ny"}, {"b": 2}, {"c": "cut') == [{"a": "x\ny"}, {"b": 2}]
    assert ok('[{"a": "he said "hi" there"}]') == [{"a": 'he said "hi" there'}]
    assert U.salvage("garbage") is None and U.salvage(None) is None and U.salvage("[") is None


def test_sanitize_sign_pack():
    assert U.sanitized({"my_token": 1, "body": "abc", "x": ["token=1"], "deep": {"notes": " "}}) == {"my_token": "***REDACTED***", "body": "<redacted payload (3 chars)>", "x": ["token=***REDACTED***"], "deep": {"notes": ""}}
    assert U.signature('{"b":1,"a":2}', "k") == U.signature('{"a": 2, "b": 1}', "k") and len(U.signature("{}", "k")) == 64
    m = U.packed("h", "m", ["x" * 1000] * 3)
    assert len(m) == 3 and all(len(x) <= 1900 for x in m)


def test_rollup_is_monotonic(spark):
    day = lambda n: datetime.date(2025, 1, 1) + datetime.timedelta(n)
    df = spark.createDataFrame([("p", day(i), v) for i, v in ((0, 5), (3, 4), (40, 9), (45, 8), (170, 20), (175, 1))], "p string, d date, v int")
    got = star_rollup(df, "p", "d", "v", F.lit("2025-06-30").cast("date")).orderBy("d").collect()
    assert [(r["d"], r["v"]) for r in got] == [(day(3), 5), (day(45), 9), (day(170), 20), (day(175), 20)]
    assert monotonic(df.limit(0), "p", "d", "v").count() == 0


def test_similar_titles(spark):
    new = spark.createDataFrame([(1, "How we cut costs with Foo "), (2, "Something else entirely here"), (3, None), (4, "")], "id int, t string")
    old = spark.createDataFrame([(9, "how we cut cost with foo")], "id int, t string")
    assert rows(similar_titles(new, old, "id", "t")) == [(1,)]


def test_selectors():
    assert pipelines.stage_list("metrics, nope,metrics,events") == ["metrics", "events"] and pipelines.stage_list("") == ["events", "metrics"]
    assert pipelines.id_list("1, x,2") == [1, 2] and pipelines.id_list("x") is None and pipelines.id_list(None) is None
    with pytest.raises(ValueError):
        pipelines.run("medium")


def test_articles_pipeline(spark):
    row = lambda u, n, up: (f"T {u}", u, "devto", datetime.datetime(2025, 1, 30), "1", ["A b"], "x" * n, None, 3, up, None, "en")
    from grainloom.sources.payloads import ARTICLE

    kinds = "title_en string, url string, source string, published_at timestamp_ntz, external_id string, tags array<string>, content string, stars int, comments int, upvotes int, read_time string, language string"
    a = spark.createDataFrame([row("u1", 6000, 5), row("u1", 7000, 6), row("u2", 5999, 9), row("u3", 9000, 9), row("u4", 9000, 9)], kinds)
    assert tuple(a.columns) == ARTICLE
    enrich = lambda d: d.withColumn("is_technical", F.col("url") != "u4").withColumn("llm_tags", F.array().cast("array<string>"))
    out = pipelines.articles({"devto": a}, spark.createDataFrame([("u3",)], "url string"), enrich, F.lit("2025-01-31").cast("timestamp_ntz"))
    got = out["articles"].select("url", F.length("content").alias("n"), "score").collect()
    assert [tuple(r) for r in got] == [("u1", 6000, 11)]
    assert rows(out["article_tags"]) == [("u1", "a-b")]


def test_foreach_batch_upsert(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
    held = {"t": spark.createDataFrame([(1, "old"), (2, "b")], "k int, v string")}
    each = streams.upsert_batches(["k"], lambda: held["t"], lambda d: held.__setitem__("t", spark.createDataFrame(d.collect(), d.schema)))
    q = s.writeStream.foreachBatch(each).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert rows(held["t"]) == [(1, "a"), (2, "b")]
