"""URLs, tags, dates, redaction, release notes and page text as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Secrets that are blotted out after what introduces them.
SECRETS = (
    r"(?i)(bearer\s+)[^\s,;]+", r"(?i)(token\s*[=:]\s*)[^\s,;]+", r"(?i)(access_token=)[^&\s]+", r"(?i)(api[_-]?key\s*[=:]\s*)[^\s,;]+",
    r"(?i)(secret\s*[=:]\s*)[^\s,;]+", r"(?i)(cookie\s*[=:]\s*)[^\s,;]+", r"(?i)(session\s*[=:]\s*)[^\s,;]+",
)
REDACTED = "***REDACTED***"
# Substrings that label a release, in order.
LABEL_WORDS = (
    ("security", ("security", "cve", "vulnerability", "exploit", "auth", "injection")),
    ("breaking", ("breaking", "incompatible", "removed", "deprecated", "migration")),
    ("feature", ("feat", "feature", "add", "new", "introduce", "support")),
    ("fix", ("fix", "bug", "patch", "correct", "resolve", "issue", "error")),
    ("perf", ("perf", "performance", "speed", "optim", "faster", "latency")),
)
# Expressions that weigh for an event type, and headings that weigh double, by priority.
TYPE_PATTERNS = (
    ("security", (r"\bsecurity\b", r"\bcve-\d{4}-\d+\b", r"\bvulnerability\b", r"\bexploit\b", r"\bxss\b", r"\bcsrf\b", r"\bauth(?:entication)?\s+bypass\b"), r"^#+\s*security"),
    ("breaking", (r"\bbreaking\s+changes?\b", r"\bbreaking-change\b", r"\bbackward(?:s)?\s+incompatible\b", r"\bincompatible\s+change\b", r"\bmigration\s+required\b", r"\bdeprecated\b", r"\bdeprecation\b"), r"^#+\s*breaking"),
    ("feature", (r"\bfeature(?:s)?\b", r"\bnew\b", r"\bintroduc(?:e|es|ed|ing)\b", r"\badd(?:s|ed|ing)?\b", r"\bsupport(?:s|ed|ing)?\b"), r"^#+\s*(?:feature|new)"),
    ("fix", (r"\bfix(?:es|ed|ing)?\b", r"\bbug(?:s|fix)?\b", r"\bhotfix\b", r"\bregression\b", r"\bresolve(?:s|d|ing)?\b", r"\bpatch(?:es|ed|ing)?\b"), r"^#+\s*(?:fix|bug)"),
    ("perf", (r"\bperf(?:ormance)?\b", r"\boptimi[sz](?:e|es|ed|ing|ation)\b", r"\bfaster\b", r"\blatency\b", r"\bthroughput\b", r"\bmemory\s+usage\b"), r"^#+\s*(?:perf|performance)"),
)
# Elements of a page that hold no content.
FURNITURE = ("script", "style", "nav", "header", "footer", "aside", "iframe", "noscript", "form", "button", "svg")


def lit_text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def host(url: Column) -> Column:
    """Lower-case host without ``www.``; port and user info stay; works without a scheme."""
    u = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(F.lower(F.regexp_extract(u, r"^/*([^/?#]*)", 1)), r"^www\.", "")


def netloc(url: Column) -> Column:
    """What stands between scheme and path, as written; "" without a scheme."""
    return F.regexp_extract(url, r"^[A-Za-z][^:/?#]*://([^/?#]*)", 1)


def plain_url(url: Column) -> Column:
    return F.regexp_replace(F.trim(url), r"/+$", "")


def slug(c: Column) -> Column:
    t = F.regexp_replace(F.lower(lit_text(c)), r"[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(t, r"^-+|-+$", ""), F.lit("")), F.lit("provider"))


def redact(c: Column) -> Column:
    for p in SECRETS:
        c = F.regexp_replace(c, p, "$1" + REDACTED.replace("$", r"\$"))
    return c


def redact_payload(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit("")).otherwise(F.concat(F.lit("<redacted payload ("), F.length(c).cast("string"), F.lit(" chars)>")))


def labels(title: Column, body: Column) -> Column:
    """Every label of which a substring occurs, else ``misc``."""
    t = F.lower(F.concat(lit_text(title), F.lit(" "), lit_text(body)))
    # Plain substring searches are far cheaper than an alternation.
    def of(x: Column) -> Column:
        has = lambda ws: reduce(lambda a, b: a | b, [x.contains(w) for w in ws])
        return F.array(*[F.when(has(ws), F.lit(n)) for n, ws in LABEL_WORDS])

    # A lambda's argument is evaluated once, a repeated expression every time.
    found = F.filter(F.transform(F.array(t), of)[0], lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("misc")))


def impact(types: Column, together: bool = False) -> Column:
    """1, and 4 for security, 3 breaking, 2 feature, 1 fix, 1 perf (fix or perf once if ``together``); at most 10."""
    has = lambda n: F.array_contains(types, n).cast("int")
    last = F.greatest(has("fix"), has("perf")) if together else has("fix") + has("perf")
    return F.least(F.lit(10), 1 + 4 * has("security") + 3 * has("breaking") + 2 * has("feature") + last)


def type_scores(title: Column, body: Column) -> Column:
    """Weighted matches of each event type, ranked: title twice, body, headings twice; best first, ties by priority.

    Put it into a column of its own before ``types_of``, or its expressions
    are evaluated once for every use.
    """
    t, b = lit_text(title), lit_text(body)
    scored = []
    for i, (name, ps, head) in enumerate(TYPE_PATTERNS):
        # One search for any of the expressions spares most texts the counting of each.
        any_of = "(?im)" + "|".join(ps)
        in_title = sum((F.regexp_count(t, F.lit("(?im)" + p)) for p in ps[1:]), F.regexp_count(t, F.lit("(?im)" + ps[0])))
        in_body = sum((F.regexp_count(b, F.lit("(?im)" + p)) for p in ps[1:]), F.regexp_count(b, F.lit("(?im)" + ps[0])))
        n = 2 * F.regexp_count(b, F.lit("(?im)" + head)) + 2 * F.when(t.rlike(any_of), in_title).otherwise(0) + F.when(b.rlike(any_of), in_body).otherwise(0)
        scored.append(F.struct((-n).alias("s"), F.lit(i).alias("i"), F.lit(name).alias("n")))
    return F.array_sort(F.array(*scored))


def types_of(ranked: Column) -> Column:
    """At most two event types of ranked scores.

    Types of a score of 2 or more, best first; security comes first as soon
    as it has any score; else the best type, else misc.
    """
    top = F.transform(F.slice(F.filter(ranked, lambda x: x["s"] <= -2), 1, 2), lambda x: x["n"])
    sec = F.exists(ranked, lambda x: (x["n"] == "security") & (x["s"] < 0))
    led = F.when(sec & ~F.array_contains(top, "security"), F.slice(F.concat(F.array(F.lit("security")), top), 1, 2)).otherwise(top)
    best = F.element_at(ranked, 1)
    return F.when(F.size(led) > 0, led).when(best["s"] < 0, F.array(best["n"])).otherwise(F.array(F.lit("misc")))


def release_summary(version: Column, types: Column) -> Column:
    return F.substring(F.concat(version, F.lit(": "), F.array_join(F.slice(types, 1, 3), ", ")), 1, 1000)


def bullets(notes: Column, n: int = 5) -> Column:
    lines = F.filter(F.split(lit_text(notes), r"\r\n|\r|\n"), lambda x: F.trim(x).startswith("-"))
    return F.slice(F.transform(lines, lambda x: F.trim(F.regexp_replace(F.trim(x), r"^[- ]+|[- ]+$", ""))), 1, n)


def event_id(project: Column, version: Column, day: Column) -> Column:
    p = project.cast("string")
    return F.concat(F.lit("evt-"), p, F.lit("-"), F.substring(F.sha1(F.concat_ws(":", p, version, day.cast("string"))), 1, 16))


def iso_day(c: Column, as_of: Column) -> Column:
    """The local day of an ISO text, not shifted by its offset; ``as_of`` if there is none."""
    return F.coalesce(F.substring(F.trim(c), 1, 10).try_cast("date"), as_of)


def strict_day(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def clean_tags(tags: Column, n: int = 5) -> Column:
    """Trimmed, lower-case, blanks to dashes; empty and repeated ones dropped; the first n."""
    t = F.transform(tags, lambda x: F.replace(F.lower(F.trim(x)), F.lit(" "), F.lit("-")))
    return F.slice(F.array_distinct(F.filter(t, lambda x: x.isNotNull() & (x != ""))), 1, n)


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(lit_text(c)), r"\s+"), lambda x: x != ""))


def read_time(words: Column) -> Column:
    m = F.greatest(F.lit(1), F.floor(words / 200))
    return F.when(words > 0, F.concat(m.cast("string"), F.lit(" min read")))


def strip_tags(html: Column) -> Column:
    """Element texts joined by line ends, trimmed, blank ones dropped."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"<[^>]+>", "\n")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def page_text(html: Column, limit: int = 15000) -> Column:
    """Text of the first article, else main, else body, without furniture; cut at ``limit`` with a note."""
    t = html
    for tag in FURNITURE:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    part = lambda tag: F.nullif(F.regexp_extract(t, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), F.lit(""))
    return limited(strip_tags(F.coalesce(part("article"), part("main"), part("body"), F.lit(""))), limit)


def limited(c: Column, limit: int = 15000) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("\n\n[Content truncated]"))).otherwise(c)


def best_text(texts: Column, least: int = 300) -> Column:
    """The first text long enough, else the longest (the first of equals), else ""."""
    fit = F.filter(texts, lambda x: F.length(x) >= least)
    longest = F.aggregate(texts, F.lit("").cast("string"), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return F.when(F.size(fit) > 0, F.element_at(fit, 1)).otherwise(longest)


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))


def item_type(source: Column, hn_id: Column | None = None) -> Column:
    disc = (source == "reddit") if hn_id is None else (source == "reddit") | hn_id.isNotNull()
    return F.when(source == "github", "REPO").when(disc, "DISCUSSION").otherwise("BLOG")


def from_base64(c: Column) -> Column:
    """UTF-8 text; bad bytes become U+FFFD."""
    return F.make_valid_utf8(F.unbase64(c).cast("string"))
