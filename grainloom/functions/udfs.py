"""What native expressions can't say: Arrow-batched functions on the standard library."""

from __future__ import annotations

import difflib
import hashlib
import hmac
import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType


def similarity(a: str | None, b: str | None) -> float | None:
    """Gestalt ratio of two titles, trimmed and lower-case."""
    if a is None or b is None:
        return None
    return difflib.SequenceMatcher(None, a.strip().lower(), b.strip().lower()).ratio()


def ratio_from(least: float):
    """A column function: the ratio of two titles, or 0 where a bound shows that it is below ``least``."""

    def one(x, y):
        if x is None or y is None:
            return None
        m = difflib.SequenceMatcher(None, x.strip().lower(), y.strip().lower())
        return m.ratio() if m.real_quick_ratio() >= least and m.quick_ratio() >= least else 0.0

    @F.pandas_udf(DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")

    return ratio


def signature(payload: str | None, secret: str) -> str | None:
    """Hex HMAC-SHA256 of the payload's compact JSON with sorted keys."""
    if payload is None:
        return None
    text = json.dumps(json.loads(payload), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    return hmac.new(secret.encode(), text.encode(), hashlib.sha256).hexdigest()


def signed(secret: str):
    @F.pandas_udf(StringType())
    def sign(p: pd.Series) -> pd.Series:
        return p.map(lambda x: signature(x, secret))

    return sign


# Key names whose values are secret, and whose texts are payloads.
SECRET_KEYS = ("authorization", "token", "secret", "password", "api_key", "apikey", "cookie", "session")
PAYLOAD_KEYS = ("body", "raw", "content", "payload", "response", "notes", "markdown", "blob")


def sanitized(value, key: str | None = None):
    """A copy of nested data without secrets: by key name, and in texts by what introduces them."""
    from grainloom.functions.text import REDACTED, SECRETS

    has = lambda k, names: any(n in k.lower() for n in names)
    blot = lambda s: f"<redacted payload ({len(s)} chars)>" if s.strip() else ""
    if isinstance(value, dict):
        out = {}
        for k, v in value.items():
            k = str(k)
            out[k] = REDACTED if has(k, SECRET_KEYS) else blot(v) if has(k, PAYLOAD_KEYS) and isinstance(v, str) else sanitized(v, k)
        return out
    if isinstance(value, list):
        return [sanitized(v, key) for v in value]
    if isinstance(value, str):
        for p in SECRETS:
            value = re.sub(p, lambda m: m.group(1) + REDACTED, value)
        return blot(value) if key and has(key, PAYLOAD_KEYS) else value
    return value


@F.pandas_udf(StringType())
def sanitize_json(s: pd.Series) -> pd.Series:
    def one(x):
        if x is None:
            return None
        try:
            return json.dumps(sanitized(json.loads(x)), ensure_ascii=False, sort_keys=True)
        except ValueError:
            return None

    return s.map(one)


class _Reader:
    """Reads JSON as far as it goes: raw line ends and quotes inside strings, trailing commas and a missing end are forgiven."""

    def __init__(self, s: str):
        self.s, self.i, self.cut = s, 0, False

    def space(self) -> str:
        while self.i < len(self.s) and self.s[self.i] in " \t\r\n":
            self.i += 1
        return self.s[self.i] if self.i < len(self.s) else ""

    def value(self):
        c = self.space()
        if c == "{":
            return self.object()
        if c == "[":
            return self.array()
        if c == '"':
            return self.string()
        m = re.compile(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null").match(self.s, self.i)
        if not m:
            raise ValueError
        self.i = m.end()
        return json.loads(m.group())

    def string(self) -> str:
        self.i += 1
        out = []
        while self.i < len(self.s):
            c = self.s[self.i]
            if c == "\\" and self.i + 1 < len(self.s):
                size = 6 if self.s[self.i + 1] == "u" else 2
                try:
                    out.append(json.loads(f'"{self.s[self.i : self.i + size]}"'))
                except ValueError:
                    out.append(self.s[self.i + 1])
                    size = 2
                self.i += size
                continue
            if c == '"' and re.compile(r'"\s*(?:[:}\]]|,\s*(?:["{\[\]}\-\d]|true|false|null|$)|$)').match(self.s, self.i):
                self.i += 1
                return "".join(out)
            out.append(c)
            self.i += 1
        self.cut = True
        return "".join(out)

    def object(self) -> dict:
        self.i += 1
        out: dict = {}
        while True:
            c = self.space()
            if c == ",":
                self.i += 1
                continue
            if c == "}":
                self.i += 1
                return out
            if c != '"':
                self.cut = True
                return out
            k = self.string()
            if self.space() != ":":
                self.cut = True
                return out
            self.i += 1
            try:
                out[k] = self.value()
            except ValueError:
                self.cut = True
                return out
            if self.cut:
                return out

    def array(self) -> list:
        self.i += 1
        out: list = []
        while True:
            c = self.space()
            if c == ",":
                self.i += 1
                continue
            if c == "]":
                self.i += 1
                return out
            if not c:
                self.cut = True
                return out
            try:
                v = self.value()
            except ValueError:
                self.cut = True
                return out
            if self.cut and isinstance(v, dict) and out:
                return out  # the last, incomplete object goes
            out.append(v)
            if self.cut:
                return out


def salvage(text: str | None) -> str | None:
    """Canonical JSON list of the objects in a damaged model answer; null if there is none.

    Fences go, the first bracket begins; ``{"articles": [...]}`` is unwrapped
    and a single object becomes a list of one.
    """
    if not text:
        return None
    t = re.sub(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "", text.strip())
    m = re.search(r"[\[{]", t)
    if not m:
        return None
    t = t[m.start() :]
    try:
        v = json.loads(t)
    except ValueError:
        r = _Reader(t)
        try:
            v = r.value()
        except ValueError:
            return None
    if isinstance(v, dict):
        v = v["articles"] if isinstance(v.get("articles"), list) else [v]
    v = [x for x in v if isinstance(x, dict) and x]
    return json.dumps(v, ensure_ascii=False, sort_keys=True) if v else None


@F.pandas_udf(StringType())
def salvage_json(s: pd.Series) -> pd.Series:
    return s.map(salvage)


def packed(header: str, more: str, entries: list[str], limit: int = 1900) -> list[str]:
    """Entries joined to messages of at most ``limit`` characters, each after its header."""
    out, now = [], header
    for e in entries:
        if len(now) + len(e) > limit:
            out.append(now)
            now = more
        now += e
    return [*out, now]


@F.pandas_udf(ArrayType(StringType()))
def pack_messages(header: pd.Series, more: pd.Series, entries: pd.Series) -> pd.Series:
    return pd.Series([packed(h, m, list(e)) for h, m, e in zip(header, more, entries)], dtype=object)
