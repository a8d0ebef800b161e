"""Secret scans: fixed patterns, and assignments read by a small lexer.

The lexer reads name-literal pairs of source and configuration syntax (``name = "x"``,
``name: x``, ``"name": "x"``, ``name := x``, ``name => x``, ``name = f("x")``, strings in three quotes,
``key="name" value="x"`` in a tag, ``scheme://user:x@host``), follows constants (``key = other``,
``"${other}"``, ``"a" + other``) and scores the literals behind a target by how sensitive the target's
name is and how random the value looks. A constant refers to its parts and does not copy them, so
constants of any size are followed. A call without a literal, or one that looks a name up, has no value.

A value of several words counts only for the names that always stand for a secret. Words like "your" or
"example" mark a placeholder if they are whole words of the value.

Spans are code points, end exclusive. Kinds are ``assign``, ``access`` and ``hex`` (patterns) and
``lexed`` (literals that only the lexer found; never inside a pattern's span).

Defined results: null and empty texts have no spans. Whole texts are read, whatever their length.
Repeated rows are scanned one by one, an empty table gives an empty result. Extra columns stay;
the column ``secrets`` is replaced if it exists.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KINDS = ("assign", "access", "hex", "lexed")
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_KEYWORD = re.compile(r"(?ai:passw|secret|token|api_?key)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# of 16 or more: the same spans as all runs with the short ones dropped, but found faster
_HEX = re.compile(r"[0-9a-f]{16,}")

SPANS = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", LongType()),
    StructField("end", LongType()), StructField("name", StringType()),
    StructField("score", DoubleType()),
]))


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    name: str | None = None
    score: float = 1.0


def pattern_spans(text: str) -> list[Span]:
    """The base spans: leftmost non-overlapping matches per kind, short ones dropped."""
    found = []
    if _KEYWORD.search(text):
        found += [
            Span("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
            if m.end(1) - m.start(1) >= 12
        ]
    if "AKIA" in text:
        found += [
            Span("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= 18
        ]
    found += [Span("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


# --- the lexer -----------------------------------------------------------------------------

_OPERATOR = re.compile(r":=|=>|(?<![=!<>])=(?![=>~])|:(?![:=/])")
_NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
_LONG = re.compile(r"""[rbuf]?(?:\"{3}((?:[^"\\]|\\.|"(?!""))*+)\"{3}|'{3}((?:[^'\\]|\\.|'(?!''))*+)'{3})""", re.S)
_QUOTED = re.compile(r"""[rbuf]?(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)""")
# ends at the next operator, so that a line of many assignments is read once
_BARE = re.compile(r"""[^\s"'`,;#(){}\[\]+<>=:]++={0,2}+""")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")
_REFERENCE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_.-]*)\}|\$([A-Za-z_][A-Za-z0-9_]*)")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_GAP = " \t"
# calls that take the name of a secret, not the secret
_LOOKUP = re.compile(r"(?i)(?:get|env|lookup|fetch|read|load|open|input|prompt|find|require)[a-z_]*\Z")
_IN_URL = re.compile(r"""://[^\s/:@"'`]*:([^\s/:@"'`]+)@""")

# How much a word in a target's name says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "privatekey": 1.0, "auth": 0.6,
    "bearer": 0.8, "key": 0.5, "api": 0.3, "private": 0.4, "access": 0.4, "signing": 0.5,
    "encryption": 0.5, "client": 0.1, "session": 0.3, "salt": 0.4,
}
_HARMLESS = {"public": -0.6, "example": -0.5, "length": -0.8, "name": -0.6, "file": -0.6,
             "path": -0.6, "url": -0.5, "type": -0.6, "policy": -0.6, "count": -0.8, "max": -0.5}
_WEIGHTS = {**SENSITIVE, **_HARMLESS}
_PLACEHOLDER = re.compile(
    r"(?i)(?<![a-z0-9])(?:change.?me|example|placeholder|your|dummy|sample|todo|x{3,})[0-9]*(?![a-z0-9])"
    r"|\*\*\*|\A(?:none|null|true|false|undefined)\Z"
)
_ALWAYS_SECRET = 0.95  # weight of a name whose value may be a phrase


def name_weight(name: str) -> float:
    """Between 0 and 1: the words of the name, weighed together."""
    words = [w.lower() for w in _PART.findall(name.rpartition(".")[2])]
    words += [a + b for a, b in zip(words, words[1:])]
    return min(1.0, max(0.0, sum(_WEIGHTS.get(w, 0.0) for w in words)))


_CLASSES = tuple(map(re.compile, ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")))


class Value:
    """A literal, or what was put together from others; it refers to its parts."""

    __slots__ = ("text", "at", "parts", "length", "_counts", "_harmless", "shown")

    def __init__(self, text: str = "", at: tuple[int, int] | None = None, parts: tuple = ()) -> None:
        self.text, self.at, self.parts = text, at, parts
        self.shown = 0.0  # the best score its literals were reported with
        self._counts = self._harmless = None
        self.length = len(text)
        if parts:  # at once: parts are weighed already, so nothing is followed deeper than one step
            self.length = sum(p.length for p in parts)
            self._counts = sum((p.counts for p in parts), Counter())
            self._harmless = any(p.harmless for p in parts)

    @property
    def counts(self) -> Counter:
        if self._counts is None:
            self._counts = Counter(self.text)
        return self._counts

    @property
    def harmless(self) -> bool:
        if self._harmless is None:
            self._harmless = bool(_PLACEHOLDER.search(self.text))
        return self._harmless

    def literals(self, score: float):
        """Where its parts are written, but for those reported with this score or a better one."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if value.shown < score:
                value.shown = score
                waiting += value.parts
                if value.at and value.at[1] > value.at[0]:
                    yield value.at


def literal_weight(value: Value | str) -> float:
    """Between 0 and 1: length times entropy, and no placeholder."""
    value = Value(value) if isinstance(value, str) else value
    if value.length < 8 or value.harmless:
        return 0.0
    shares = [n / value.length for n in value.counts.values()]
    entropy = -sum(p * math.log2(p) for p in shares)
    classes = sum(any(c.match(x) for x in value.counts) for c in _CLASSES)
    if classes < 2:
        return 0.0
    return min(1.0, entropy / 3.0) * min(1.0, value.length / 12) * min(1.0, 0.4 + 0.2 * classes)


def score_of(name: str, value: Value | str) -> float:
    weight = name_weight(name)
    if not weight:
        return 0.0
    value = Value(value) if isinstance(value, str) else value
    phrase = any(c in value.counts for c in " \t")
    return weight * literal_weight(value) if weight >= _ALWAYS_SECRET or not phrase else 0.0


def _target(text: str, operator: int) -> tuple[str, int] | None:
    """The name before an operator, with or without quotes, and where it starts."""
    at = operator
    while at and text[at - 1] in _GAP:
        at -= 1
    if at and text[at - 1] in "\"']":
        at -= 1
        if at and text[at - 1] in "\"'":
            at -= 1
    end = at
    while at and text[at - 1] in _NAME_CHARS:
        at -= 1
    name = text[at:end].strip(".-")
    if not name or not (name[0].isalpha() or name[0] == "_"):
        return None
    return name, at


def _string(text: str, at: int, known: dict[str, Value]) -> tuple[Value, int] | None:
    """A quoted string at ``at``, its references to constants filled in, and where it ends."""
    m = _LONG.match(text, at) or _QUOTED.match(text, at)
    if not m:
        return None
    raw, start = m.group(m.lastindex or 0), m.start(m.lastindex or 0)
    pieces, last = [], 0
    for ref in _REFERENCE.finditer(raw):
        value = known.get(ref.group(1) or ref.group(2))
        if value is None:
            continue
        if ref.start() > last:
            pieces.append(Value(raw[last:ref.start()], (start + last, start + ref.start())))
        pieces.append(value)
        last = ref.end()
    if not pieces:
        return Value(raw, (start, start + len(raw))), m.end()
    if last < len(raw):
        pieces.append(Value(raw[last:], (start + last, start + len(raw))))
    return Value(parts=tuple(pieces)), m.end()


def _term(text: str, at: int, known: dict[str, Value]) -> tuple[Value, int] | None:
    """A quoted string, a known name, a call of one string or a bare word at ``at``, and where it ends."""
    if found := _string(text, at, known):
        return found
    if m := _BARE.match(text, at):
        word = m.group().rstrip(".:")
        end = at + len(word)
        if not word:
            return None
        if text[end:end + 1] == "[":
            return None
        if text[end:end + 1] == "(":
            return None if _LOOKUP.search(word) else _string(text, end + 1, known)
        reference = _REFERENCE.fullmatch(word)
        name = (reference.group(1) or reference.group(2)) if reference else word
        if name in known:
            return known[name], end
        if reference or not word.isascii():
            return None
        return Value(word, (at, end)), end
    return None


def lexed_spans(text: str, threshold: float = 0.45) -> list[Span]:
    """The literals whose score, name times value, reaches ``threshold``."""
    known: dict[str, Value] = {}
    found: dict[tuple[int, int], Span] = {}

    def report(name: str, value: Value) -> None:
        score = score_of(name, value)
        if score >= threshold:
            for start, end in value.literals(score):
                old = found.get((start, end))
                if old is None or old.score < score:
                    found[start, end] = Span("lexed", start, end, name, score)

    for m in _IN_URL.finditer(text):
        report("password", Value(m.group(1), m.span(1)))
    label, label_end = None, 0  # of a tag's key or name attribute
    for operator in _OPERATOR.finditer(text):
        target = _target(text, operator.start())
        if target is None:
            continue
        at, parts = operator.end(), []
        while True:
            while at < len(text) and text[at] in _GAP:
                at += 1
            term = _term(text, at, known)
            if term is None:
                break
            parts.append(term[0])
            at = term[1]
            while at < len(text) and text[at] in _GAP:
                at += 1
            if at >= len(text) or text[at] != "+":
                break
            at += 1
        if not parts:
            continue
        value, name = parts[0] if len(parts) == 1 else Value(parts=tuple(parts)), target[0]
        known[name] = value
        if name.lower() in ("key", "name", "id") and value.at:
            label, label_end = text[slice(*value.at)], at
        elif name.lower() == "value" and label and not any(
                c in text[label_end:operator.start()] for c in "<>\n"):
            name, label = label, None
        report(name, value)
    return list(found.values())


def secret_spans(text: str | None, threshold: float = 0.45) -> list[Span]:
    """All spans of a text by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    base = pattern_spans(text)
    extra = lexed_spans(text, threshold) if "=" in text or ":" in text else []
    cover = sorted((s.start, s.end) for s in base)
    starts, furthest = [a for a, _ in cover], list(accumulate((b for _, b in cover), max))

    def covered(s: Span) -> bool:
        before = bisect_right(starts, s.start)  # base spans that start no later
        return before > 0 and furthest[before - 1] >= s.end

    extra = [s for s in extra if not covered(s)]
    return sorted(base + extra, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def masked(text: str | None, mark: str = "[secret]", threshold: float = 0.45) -> str | None:
    """The text with every stretch of overlapping spans replaced by ``mark``."""
    spans = secret_spans(text, threshold)
    if not spans:
        return text
    out, last, end = [], 0, -1
    for span in spans:
        if span.start >= end:
            if end >= 0:
                last = end
            out += [text[last:span.start], mark]
            end = span.end
        end = max(end, span.end)
    return "".join(out) + text[end:]


def find(docs: DataFrame, text: str = "text", threshold: float = 0.45) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``kind, start, end, name, score`` per text."""

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [(s.kind, s.start, s.end, s.name, s.score) for s in secret_spans(t, threshold)]
            for t in texts
        ], dtype=object)

    return docs.withColumn("secrets", scan(F.col(text)))


def mask(docs: DataFrame, text: str = "text", mark: str = "[secret]",
         threshold: float = 0.45) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark``; ``n_chars``, if there is such
    a column, is the new length of the texts that changed."""

    @F.pandas_udf(StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, mark, threshold) for t in texts], dtype=object)

    done = docs.withColumn("_clean", clean(F.col(text)))
    new = {text: F.col("_clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(
            F.col("_clean") == F.col(text), F.col("n_chars")
        ).otherwise(F.char_length("_clean").cast(docs.schema["n_chars"].dataType))
    return done.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, in their order, comma-joined."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
