"""Boilerplate, truncation and encoding repair on made-up corpora, with held-out accuracy and exact round trips."""

import random

import pandas as pd
import pytest

from grainloom.llm import boilerplate, encoding, truncation

SUBJECT = ["The river", "A baker", "Our train", "The clock", "One teacher", "The garden", "My neighbour", "The ferry"]
VERB = ["crosses", "paints", "repairs", "forgets", "measures", "carries", "opens", "follows"]
OBJECT = ["the old bridge", "a yellow door", "seven letters", "the market square", "its own shadow", "a broken lamp", "the north wall", "some warm bread"]


def sentence(r):
    return f"{r.choice(SUBJECT)} {r.choice(VERB)} {r.choice(OBJECT)} in {r.choice(['spring', 'summer', 'autumn', 'winter'])}."


def paragraph(r, n=4):
    return " ".join(sentence(r) for _ in range(n))


def page(r):
    head = r.sample(["Home", "About", "Pricing", "Blog", "Log in", "Careers", "Search"], 5)
    tail = r.sample(["Share this post", "Related posts", "Subscribe to our newsletter", "Terms and privacy", "All rights reserved", "Back to top"], 5)
    body = [paragraph(r) for _ in range(r.randint(3, 6))]
    body.insert(1, "Next steps")
    if r.random() < 0.5:
        body.insert(2, "Subscribe to our newsletter")
    lines = head + body + tail
    bad = [i for i, x in enumerate(lines) if i < 5 or i >= len(lines) - 5 or x.startswith("Subscribe")]
    return "\n".join(lines), bad


def test_boilerplate_accuracy(spark):
    r = random.Random(6)
    pages = [page(r) for _ in range(300)]
    feeds = ["\n".join(["Next steps", *(paragraph(r) for _ in range(4)), "Thanks for reading!"]) for _ in range(200)]
    rows = [(i, p[0]) for i, p in enumerate(pages)] + [(1000 + i, f) for i, f in enumerate(feeds)] + [(5000, None), (5001, ""), (5002, "\n\n"), (5003, paragraph(r, 3000))]
    df = spark.createDataFrame(rows, "id bigint, t string").selectExpr("*", "1 as line_no")
    got = {(x["id"], x["line_no"]) for x in boilerplate.furniture_lines(df, "id", "t").collect()}
    want = {(i, n) for i, p in enumerate(pages) for n in p[1]}
    both = len(got & want)
    assert both / len(got) > 0.97 and both / len(want) > 0.97
    body = {x["id"]: x["body"] for x in boilerplate.main_text(df, "id", "t").collect()}
    assert body[5000] is None and body[5001] == "" and body[5002] == "" and len(body[5003]) > 100_000
    assert boilerplate.furniture_lines(df.limit(0), "id", "t").count() == 0


def test_fit_on_a_bounded_draw_and_crowded_tables(spark):
    """A model fitted on some pages marks them all; the table is sized by the pages it is fitted on."""
    r = random.Random(16)
    pages = [page(r) for _ in range(900)]
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)] + [(5000 + i, pages[0][0]) for i in range(300)], "id bigint, t string")
    want = {(i, n) for i, p in enumerate(pages) for n in p[1]} | {(5000 + i, n) for i in range(300) for n in pages[0][1]}
    model = boilerplate.learn(df, "t", "id", fit_pages=250)
    assert model.bits == boilerplate.LEAST_BITS == boilerplate.learn(df, "t", "id").bits
    again = boilerplate.learn(df.repartition(3), "t", "id", fit_pages=250)
    assert (model.odds == again.odds).all()
    got = {(x["id"], x["line_no"]) for x in boilerplate.furniture_lines(df, "id", "t", model).collect()}
    both = len(got & want)
    assert both / len(got) > 0.97 and both / len(want) > 0.97


def test_fit_on_all_pages(spark):
    """However many pages there are, each line of each of them counts."""
    n = 20_000
    df = spark.range(n).selectExpr("id", "concat('Home\\nLog in\\nSearch\\n', repeat(concat('The old bridge of town ', id % 97, ' has a yellow door. '), 4), '\\nBack to top\\nShare ', id, '\\nTerms') AS t")
    model = boilerplate.learn(df, "t", "id", rounds=1, bits=14)
    whole = boilerplate.learn(df, "t", "id", rounds=1, bits=14, fit_pages=10 * n)
    assert (model.odds == whole.odds).all() and (model.known == whole.known).all()
    got = boilerplate._Learn(14, None)
    batch = df.select("t").toArrow().to_batches()
    counts = {k: c for o in got(iter(batch)) for k, c in zip(o.column("k").to_pylist(), o.column("n").to_pylist())}
    assert counts[-1] == n and counts[-3] == n and counts[-2] > 3 * n


def test_line_features_together_and_alone():
    of = boilerplate.Cells(16).of
    lines = ["Share this", "", "  ", "a 12 b 12", "x" * 90, "-", "Ω word Ω word " * 30]
    cells, at, own = of(lines)
    for i, x in enumerate(lines):
        c, _, o = of([x])
        assert sorted(cells[at == i]) == sorted(c) and own[i] == o[0]
    assert [len(v) for v in of([])] == [0, 0, 0]


def test_block_bounds():
    assert boilerplate.surge_and_dive([], []) == (0, 0)
    assert boilerplate.surge_and_dive([5, 5, 5], [False] * 3) == (0, 3)
    assert boilerplate.surge_and_dive([5, 5, 300, 200, 5, 5], [False] * 6) == (2, 4)
    assert boilerplate.weight("Home | About | Docs | Blog") < 20 and boilerplate.weight("") == 0


def test_truncation_accuracy(spark):
    r = random.Random(7)
    rows, want = [], set()
    for i in range(1500):
        t = "\n".join(paragraph(r, r.randint(1, 5)) for _ in range(r.randint(1, 6)))
        src = r.choice(["one", "two"])
        if src == "one" and len(t) > 600:
            t = t[:600]
            if t[-1] not in ".":
                want.add(i)
        elif r.random() < 0.05:
            t = t[: r.randint(20, len(t) - 5)].rstrip()
            if t[-1] != ".":
                want.add(i)
        elif r.random() < 0.03:
            t = t[: len(t) // 2] + " [+120 chars]"
            want.add(i)
        rows.append((i, src, t))
    rows += [(9001, "one", None), (9002, None, ""), (9003, "two", "  "), (9004, None, "A short note without end"), (9005, "two", paragraph(r, 4000))]
    df = spark.createDataFrame(rows, "id bigint, s string, t string").selectExpr("*", "1 as n", "2 as kind")
    res = {x["id"]: x for x in truncation.truncated(df, "id", "s", "t").collect()}
    got = {i for i, x in res.items() if x["cut"]} - {9004}
    assert not {9001, 9002, 9003} & res.keys() and not res[9005]["cut"]
    both = len(got & want)
    assert both / len(got) > 0.95 and both / len(want) > 0.95
    assert truncation.truncated(df.limit(0), "id", "s", "t").count() == 0


def test_censored_fit_finds_the_limit():
    r = random.Random(8)
    n = [int(r.lognormvariate(5, 0.6)) + 1 for _ in range(5000)]
    cut = [min(x, 200) for x in n]
    got = truncation.fit_limits(pd.Series(cut).value_counts().rename_axis("n").reset_index(name="count"))
    assert [x for x, _ in got] == [200] and got[0][1] > 0.9
    assert truncation.fit_limits(pd.Series(n).value_counts().rename_axis("n").reset_index(name="count")) == []
    assert truncation.fit_limits(pd.DataFrame({"n": [], "count": []})) == []


@pytest.mark.parametrize("s,body,note", [("abc… Read more", "abc", True), ("abc\n\n[Content truncated]", "abc", True), ("abc.", "abc.", False), ("ab [+12 chars]", "ab", True), ("abc...", "abc", True), ("", "", False)])
def test_notes(s, body, note):
    assert truncation.strip_note(s) == (body, note)


WORDS = {
    "fr": "les élèves préfèrent déjà les forêts près du château où la rivière brûlée s'arrête après midi".split(),
    "ko": "오늘 아침에 친구와 함께 공원에서 오래된 나무를 보고 집으로 돌아왔습니다".split(),
    "pt": "não há razão para a estação não abrir às três horas da manhã".split(),
}


def corpus(r):
    out = []
    for i in range(600):
        lang = r.choice(list(WORDS))
        out.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randint(5, 40))) + "."))
    return out


def test_encoding_round_trips(spark):
    r = random.Random(9)
    rows = corpus(r)
    want = {}
    pairs = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("cp1252", "cp850"), ("cp949", "cp1252")]
    for i in range(0, 300, 5):
        right, wrong = pairs[i // 5 % len(pairs)]
        t = rows[i][1]
        try:
            bad = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in t.encode(right))
        except UnicodeEncodeError:
            continue
        if bad != t:
            rows[i] = (i, bad)
            want[i] = t
    rows += [(9001, None), (9002, ""), (9003, "plain ascii"), (9004, "She quotes `forÃªts` as the sample."), (9005, 'He wrote "prÃ¨s" there.'), (9006, "les for�ts près du château"), (9007, " ".join(["élèves"] * 20000))]
    df = spark.createDataFrame(rows, "id bigint, t string").selectExpr("*", "1 as k", "'x' as restored")
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(df, "id", "t").collect()}
    assert set(want) | {9006} == set(got)
    assert sum(got[i] == t for i, t in want.items()) / len(want) > 0.95
    assert got[9006] == "les forêts près du château"
    assert encoding.repair_encoding(df.limit(0), "id", "t").count() == 0


MORE = {
    **WORDS,
    "ja": "今日は 天気が いいので 公園を 散歩しました 友達と コーヒーを 飲みながら 古い 木を 見て 家に 帰りました".split(),
    "zh": "我们 今天 早上 在公园 看见 一棵 很老的 大树 然后 跟朋友 喝咖啡 回家 写信".split(),
    "ru": "сегодня утром мы видели старое дерево в парке потом пили кофе с другом и вернулись домой".split(),
}


def misread(text, right, wrong, lost=False):
    """``text`` written in one encoding and read in another; bytes without a character stay as browsers read them, or leave a mark."""
    raw = text.encode(right)
    if wrong in encoding.SINGLE:
        return "".join(bytes([x]).decode(wrong, "ignore") or ("\ufffd" if lost else chr(x)) for x in raw)
    return raw.decode(wrong, "replace" if lost else "strict")


def test_every_channel_gives_the_original_back(spark):
    """Each kind of damage planted in a corpus of six languages is found, and restored as far as its bytes are there."""
    r = random.Random(12)
    rows = [(i, " ".join(r.choice(MORE[lang]) for _ in range(r.randint(6, 30))) + ".") for i in range(1500) for lang in [r.choice(list(MORE))]]
    cases, n = {}, 10_000
    fits = {"cp1252": "fr pt", "cp949": "ko", "cp932": "ja", "euc_jp": "ja", "gbk": "zh", "big5": "", "cp1251": "ru", "koi8_r": "ru", "mac_roman": "fr pt", "cp850": "fr pt", "utf-8": "fr ko pt ja zh ru"}
    for wrong, right in encoding.CHANNELS:
        for lang in fits[right].split():
            for lost in (False, True):
                for _ in range(4):
                    ws = [r.choice(MORE[lang]) for _ in range(12)]
                    k = r.randrange(1, 8)
                    try:
                        bad = [misread(w, right, wrong, lost) for w in ws[k : k + 4]]
                    except UnicodeError:
                        continue
                    if bad == ws[k : k + 4] or lost != any("\ufffd" in w for w in bad) or sum(w.count("\ufffd") for w in bad) > sum(map(len, bad)) / 4:
                        continue
                    n += 1
                    cases[n] = (wrong, right, lost, " ".join(ws))
                    rows.append((n, " ".join([*ws[:k], *bad, *ws[k + 4 :]])))
    assert len(cases) > 200 and {w for w, _, _, _ in cases.values()} == {w for w, _ in encoding.CHANNELS}
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(spark.createDataFrame(rows, "id bigint, t string"), "id", "t").collect()}
    assert all(i > 10_000 for i in got)
    assert len(got) / len(cases) > 0.98
    for lost, least in ((False, 0.95), (True, 0.8)):
        own = {i: c for i, c in cases.items() if c[2] == lost}
        assert sum(got.get(i) == c[3] for i, c in own.items()) / len(own) > least


def test_long_runs_with_lost_bytes(spark):
    """Blank-free runs of any length go through the lattice, words of any length are known by their letters."""
    r = random.Random(13)
    line = lambda n: "".join(r.choice(MORE["ja"]) for _ in range(n))
    rows = [(i, line(12)) for i in range(400)] + [(500 + i, "q" + "élanchéité" * 9 + " x") for i in range(5)]
    whole = line(40)
    raw = bytearray(whole.encode())
    at = [i for i in range(20, len(raw), 37) if raw[i] >= 128]
    bad = "".join("\ufffd" if i in at else bytes([x]).decode("cp1252", "ignore") or chr(x) for i, x in enumerate(raw))
    assert len(raw) > 400 and len(at) > 8
    rows += [(1000, bad), (1001, ("q" + "élanchéité" * 9).encode().decode("cp1252").replace("Ã©", "Ã\ufffd", 1) + " x")]
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(spark.createDataFrame(rows, "id bigint, t string"), "id", "t").collect()}
    assert set(got) == {1000, 1001}
    assert sum(a == b for a, b in zip(got[1000], whole)) / len(whole) > 0.9
    assert got[1001] == "q" + "élanchéité" * 9 + " x"


def test_dropped_control_characters(spark):
    """Bytes that a page dropped without a mark, in scripts whose first bytes are common letters too."""
    r = random.Random(14)
    rows = [(i, " ".join(r.choice(MORE[lang]) for _ in range(30))) for i in range(900) for lang in [r.choice(["ko", "ja", "ru", "fr"])]]
    want = {}
    for i in range(12):
        ws = [r.choice(MORE[["ko", "ja"][i % 2]]) for _ in range(14)]
        text = " ".join(ws)
        bad = "".join(bytes([x]).decode("cp1252", "ignore") for x in text.encode())
        if bad != "".join(bytes([x]).decode("cp1252", "ignore") or chr(x) for x in text.encode()):
            want[2000 + i] = text
            rows.append((2000 + i, bad))
    assert len(want) > 6
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(spark.createDataFrame(rows, "id bigint, t string"), "id", "t").collect()}
    assert set(got) == set(want)


def test_frequent_garbled_forms_are_found(spark):
    """A garbled form of Hangul and ideographs alone does not become sound by being frequent."""
    rows = [(i, "서버 로그 파일을 보고 로그 수준을 바꿉니다") for i in range(400)]
    rows += [(1000 + i, "서버 " + "로그".encode().decode("cp949") + " 파일을 보고 " + "로그".encode().decode("cp949") + " 수준을") for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(df, "id", "t").collect()}
    assert got == {1000 + i: "서버 로그 파일을 보고 로그 수준을" for i in range(5)}


def test_garbled_forms_beyond_any_clip(spark):
    """The ratio of right and garbled forms decides, however often both occur."""
    rows = [(i, "I don’t know. " * 10_000) for i in range(9)] + [(100, "I donâ€™t know. " * 7_000)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    got = {x["id"]: x["restored"] for x in encoding.repair_encoding(df, "id", "t").collect()}
    assert got == {100: "I don’t know. " * 7_000}


def test_copies_of_a_cut_page_do_not_vouch_for_each_other(spark):
    r = random.Random(10)
    text = lambda: "\n".join(paragraph(r, r.randint(1, 5)) for _ in range(r.randint(2, 6)))
    page = text()
    rows = [(i, "one", text()) for i in range(600)] + [(1000 + i, "one", page + "\nThe river crosses the old bridge, a yellow door,") for i in range(80)]
    rows += [(2000 + i, "one", text() + "\nSee the other pages of this site,") for i in range(80)]
    df = spark.createDataFrame(rows, "id bigint, s string, t string")
    got = {x["id"] for x in truncation.truncated(df, "id", "s", "t").where("cut").collect()}
    assert {1000 + i for i in range(80)} == got
