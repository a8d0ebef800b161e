"""Personal data: fixed patterns, spread over each document by a skip-chain random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers. The field then labels
the tokens that hold a digit or ``@`` (all others are no personal data by definition, which cuts
the chain there, as do commas and the like): features of the token and its neighbours, transitions between adjacent
tokens, and skip links between repeated or similar tokens of the document, however far apart. Loopy
message passing makes linked tokens agree, so a number written in full once is also found where
it stands without its prefix. Digit groups side by side are read as one number: numbers with the same
last digits are linked group by group, however they are spaced. Tokens inside pattern spans are
observed. All others are decoded: a token is added if its marginal for one kind reaches ``threshold``,
and groups of one number as one span, if it holds seven digits or an ``@``.

Weights are fitted by pseudo-likelihood on a bounded sample of documents, labelled by the patterns,
on ``BACKGROUND``, plain numbers that are no personal data, and on ``FORMS`` that the patterns leave
out; tokens linked to an observed one are left out, as their label is what is to be found.

Spans are code points, end exclusive, by kind as listed in ``KINDS``, then start. Defined results:
null and empty texts have no spans; whole texts are read. Repeated rows are scanned one by
one, an empty table gives an empty result. Extra columns stay; ``pii`` is replaced if it exists.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match cannot begin inside a run of digits: it would have begun at the run's first.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")

SPANS = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", LongType()),
    StructField("end", LongType()), StructField("base", BooleanType()),
]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: from each ``@`` with a domain, back over the local part. Every character
    is read a bounded number of times, also in texts without spaces."""
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by kind, then start."""
    found = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- the field -------------------------------------------------------------------------------

_BREAKS = (",", ";", ":", "!", "?")  # no number goes on after them
_STRIP = ".,;:!?\"'()[]{}<>"
CUES = {
    "tel": "phone", "tel:": "phone", "phone": "phone", "call": "phone", "fax": "phone",
    "mobile": "phone", "mail": "email", "email": "email", "e-mail": "email", "ip": "ip",
    "host": "ip", "address": "ip", "server": "ip", "card": "card", "visa": "card",
    "account": "card",
}
N_FEATURES = 40
_DATE = re.compile(r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{2,4}")
_EDGES = (1, 2, 4, 5, 7, 9, 11, 16, 20)


def _features(token: str, before: str, after: str) -> list[int]:
    digits = _digits(token)
    core = token.strip(_STRIP)
    found = [0]
    found.append(1 + sum(len(digits) >= e for e in _EDGES))  # 1 to 10
    checks = (
        "@" in token, "@" in token and "." in token.partition("@")[2], token.startswith("+"),
        token.startswith("("), core.count(".") == 3 and core.replace(".", "").isdigit(),
        16 <= len(digits) <= 19 and luhn(digits), any(c.isalpha() for c in core),
        "-" in core, "." in core, any(c in "=:/_#$%&*|" for c in core), core.isdigit(),
        len(core) > 20, 7 <= len(digits) <= 15 and not any(c.isalpha() for c in core),
    )
    found += [11 + i for i, c in enumerate(checks) if c]  # 11 to 23
    for base, word in ((24, before), (28, after)):
        cue = CUES.get(word.lower().rstrip(":"))
        if cue:
            found.append(base + KINDS.index(cue))
    if before[-1:] not in _BREAKS and _CANDIDATE.search(before):
        found.append(32)
    if token[-1:] not in _BREAKS and _CANDIDATE.search(after):
        found.append(33)
    found += [34] * bool(_DATE.fullmatch(core))
    return found


@dataclass
class Graph:
    """Candidate tokens of a text and their links."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    observed: np.ndarray  # label, or -1
    chain: np.ndarray  # pairs of adjacent candidates
    skip: np.ndarray  # pairs of linked candidates
    digits: list[int] | None = None  # of each candidate that is no address
    run_digits: np.ndarray | None = None  # of the run of digit groups it is in
    together: set[tuple[int, int]] | None = None  # neighbours linked as groups of one number


LEAST_DIGITS = 7  # of a number that is linked or added
_SUFFIXES = (LEAST_DIGITS, 10, 16)  # digits from the right by which numbers are linked
_LONGEST = 19  # digits of a number
_LETTER = re.compile(r"[^\W\d_]|@")


def _mail_keys(token: str) -> list[str]:
    """What repeated or similar addresses have in common."""
    core = token.strip(_STRIP).lower()
    return [core, core.partition("@")[0] + "@"] if core.partition("@")[0] else []


def _ends(digits: list[str], run: list[int]) -> Iterator[tuple[str, tuple[int, ...]]]:
    """At each group of a run: the digits up to it and the groups that hold their last
    ``_LONGEST``, from the right. A single long group is whole."""
    for k, last in enumerate(run):
        groups, text = [], ""
        for i in reversed(run[max(0, k + 1 - _LONGEST):k + 1]):
            if len(text) >= _LONGEST:
                break
            groups.append(i)
            text = digits[i] + text
        if len(text) >= LEAST_DIGITS:
            yield text, tuple(groups)


def _aligned(digits: list[str], one, other) -> list[tuple[int, int]]:
    """Pairs of groups of two numbers whose digits stand at the same place from the right, as far
    as the numbers agree. A group counts if it agrees whole, but for zeros at its start (trunk
    prefixes), or its partner does."""
    (a, left), (b, right) = one, other
    same = 0
    while same < min(len(a), len(b)) and a[-1 - same] == b[-1 - same]:
        same += 1

    def places(groups):
        end = 0
        for i in groups:
            begin, end = end, end + len(digits[i])
            rest = digits[i][:max(end - same, 0)]
            yield i, begin, end, begin < same and not rest.strip("0")

    pairs = [(left[0], right[0])] if min(
        len(digits[left[0]]), len(digits[right[0]])) >= LEAST_DIGITS else []
    for i, begin, end, whole in places(left):
        pairs += [(i, j) for j, start, stop, full in places(right)
                  if (whole or full) and max(begin, start) < min(end, stop, same)]
    return pairs


def _number_links(digits: list[str], runs: list[list[int]]):
    """Links of groups of digits, and the neighbours that belong to one number."""
    links, together, first_of, before_of = set(), set(), {}, {}
    for run in runs:
        for end in _ends(digits, run):
            text = end[0]
            partners = {}
            for n in (*_SUFFIXES, len(text)):
                if len(text) < n:
                    continue
                key = (n in _SUFFIXES, text[-n:])
                if key in first_of:  # to the first and the one before: linear, and never far apart
                    partners[first_of[key]] = partners[before_of[key]] = None
                first_of.setdefault(key, end)
                before_of[key] = end
            for other in partners:
                pairs = [p for p in _aligned(digits, other, end) if p[0] != p[1]]
                links.update((min(p), max(p)) for p in pairs)
                for side in zip(*pairs):
                    held = sorted(set(side))
                    together.update((x, y) for x, y in zip(held, held[1:]) if y == x + 1)
    return links, together


def graph(text: str, base: list[tuple[str, int, int]]) -> Graph:
    spans, features, keys, chain = [], [], [], []
    digits, runs, plain = [], [], False  # runs: groups of digits side by side
    before, previous = "", None  # the token before, and its candidate number
    for m in _TOKEN.finditer(text):
        token = m.group()
        if features and previous == len(spans) - 1 and features[-1] is None:
            features[-1] = _features(*spans_text, token)
        if _CANDIDATE.search(token):
            if before[-1:] in _BREAKS:
                previous = None
            if previous is not None:
                chain.append((previous, len(spans)))
            was_plain, plain = plain and previous is not None, not _LETTER.search(token)
            digits.append("" if "@" in token else _digits(token))
            if was_plain and plain:
                runs[-1].append(len(spans))
            else:
                runs.append([len(spans)])
            previous = len(spans)
            spans.append(m.span())
            spans_text = (token, before)
            features.append(None)
            keys.append(_mail_keys(token) if "@" in token else [])
        else:
            previous = None
        before = token
    if features and features[-1] is None:
        features[-1] = _features(*spans_text, "")
    observed = np.full(len(spans), -1)
    starts = np.array([s for s, _ in spans], np.int64)
    ends = np.array([e for _, e in spans], np.int64)
    for kind, start, end in reversed(base):  # the kind listed first wins
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(starts, end, side="left"))
        observed[first:last] = LABELS.index(kind)
    links, first_of, before_of = set(), {}, {}
    for i, own in enumerate(keys):
        for key in own:
            if key in first_of:  # to the first and the one before: linear, and never far apart
                links.add((first_of[key], i))
                links.add((before_of[key], i))
            first_of.setdefault(key, i)
            before_of[key] = i
    numbers, together = _number_links(digits, runs)
    sizes = np.zeros(len(spans), np.int64)
    for run in runs:
        sizes[run] = sum(len(digits[i]) for i in run)
    pairs = lambda p: np.array(sorted(p), np.int64).reshape(-1, 2)
    return Graph(spans, features, observed, pairs(chain), pairs(links | numbers),
                 [len(d) for d in digits], sizes, together)


def _reached(g: Graph) -> np.ndarray:
    """Which candidates skip links connect to an observed one."""
    mark = g.observed > 0
    while len(g.skip):
        a, b = g.skip.T
        new = mark.copy()
        np.logical_or.at(new, a, mark[b])
        np.logical_or.at(new, b, mark[a])
        if (new == mark).all():
            break
        mark = new
    return mark


# Numbers that are no personal data, of each length and of the usual forms.
BACKGROUND = tuple(
    f"about {form} of the" for n in range(1, 20) for form in (
        "1234567890123456789"[:n], "9075318642907531864"[:n], "5" * n)
) + tuple(f"since {y}-{m:02d}-{d:02d} at {h}:{m * 4:02d} in {d}.{m}.{y}, {d * 13}.{h}{m}% of {y}-{y + 1}"
          for y, m, d, h in ((1998, 1, 31, 7), (2009, 6, 12, 11), (2021, 12, 5, 23), (2024, 10, 17, 16))
          ) + tuple(
    f'{name} = "{hashlib.sha1(bytes([i])).hexdigest()[:size]}" and' for i in range(20)
    for name, size in (("token", 40), ("id", 32), ("commit", 24))
) + ("version 1.2.34 and 10.4", "1,234,567.89 or 12,345,678", "id_20210317 x86-64 4567890a")

# Forms of personal data that the patterns leave out: numbers without a country's prefix, and cards
# written with other signs.
FORMS = tuple(
    (f"{before} {n} {after}", kind) for before, after in (
        ("call", "now"), ("later", "again"), ("reach us on", "or write"), ("and", ""), ("", "is mine"))
    for kind, numbers in (
        ("phone", ("974-555-3436", "212-555-0188", "974.555.3436", "(974) 555-3436", "030 1234 5678",
                   "0171-2345678", "(0171) 2345678")),
        ("card", ("4111.1111.1111.1111", "5500-0000-0000-0004", "4111/1111/1111/1111")))
    for n in numbers
)


@dataclass
class Field:
    """Weights: labels by features, transitions of adjacent and of linked tokens."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def prior() -> Field:
        n = len(LABELS)
        return Field(np.zeros((N_FEATURES, n)), np.zeros((n, n)), 2.0 * np.eye(n))


def fit(texts: list[str], steps: int = 150, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Pseudo-likelihood: each token's label given those of its neighbours. Weights stay near
    the prior, by which linked tokens agree; without data the prior is the result."""
    rows, n = [], len(LABELS)
    field, prior = Field.prior(), Field.prior()
    labelled = [(t, base_spans(t)) for t in texts]
    if labelled:
        labelled += [(t, []) for t in BACKGROUND]
        labelled += [(t, [(kind, 0, len(t))]) for t, kind in FORMS]
    for text, base in labelled:
        g = graph(text, base)
        if not g.spans:
            continue
        label = np.maximum(g.observed, 0)
        hidden = _reached(g) & (g.observed < 0)
        shape = (len(label), n)
        left, right, linked = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for a, b in g.chain:
            right[a, label[b]] += not hidden[b]
            left[b, label[a]] += not hidden[a]
        for a, b in g.skip:
            if not hidden[a] and not hidden[b]:
                linked[a, label[b]] += 1
                linked[b, label[a]] += 1
        x = np.zeros((len(label), N_FEATURES))
        for i, f in enumerate(g.features):
            x[i, f] = 1
        rows.append(tuple(v[~hidden] for v in (x, left, right, linked, label)))
    if not rows:
        return field
    x, left, right, linked, label = (np.concatenate(c) for c in zip(*rows))
    want = np.eye(n)[label]
    size = max(len(label), 1)
    for _ in range(steps):
        score = x @ field.node + left @ field.chain + right @ field.chain.T + linked @ field.skip
        p = np.exp(score - score.max(axis=1, keepdims=True))
        error = want - p / p.sum(axis=1, keepdims=True)
        both = linked.T @ error / size
        field.node += rate * (x.T @ error / size - decay * field.node)
        field.chain += rate * (left.T @ error / size + (right.T @ error / size).T
                               - decay * field.chain)
        field.skip += rate * ((both + both.T) / 2 - decay * (field.skip - prior.skip))
    return field


_EDGES_AT_ONCE = 1 << 16  # whose messages are computed together


def marginals(g: Graph, field: Field, rounds: int = 50, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of every candidate by loopy sum-product in the log domain."""
    n = len(LABELS)
    node = np.array([field.node[f].sum(axis=0) for f in g.features]).reshape(-1, n)
    fixed = g.observed >= 0
    node[fixed] = -50.0
    node[fixed, g.observed[fixed]] = 0.0
    pairs = np.concatenate([g.chain, g.skip])
    a, b = np.concatenate([pairs, pairs[:, ::-1]]).T
    # the edges share four matrices: both kinds, both ways round
    counts, matrices = (len(g.chain), len(g.skip)), (field.chain, field.skip)
    parts, start = [], 0
    for weight, size in zip((*matrices, *(w.T for w in matrices)), counts * 2):
        parts += [(weight, slice(at, min(at + _EDGES_AT_ONCE, start + size)))
                  for at in range(start, start + size, _EDGES_AT_ONCE)]
        start += size
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    message = np.zeros((len(a), n))
    for _ in range(rounds):
        belief = node.copy()
        np.add.at(belief, b, message)
        new = np.empty_like(message)
        for weight, part in parts:
            out = (belief[a[part]] - message[back[part]])[:, :, None] + weight
            top = out.max(axis=1)
            sent = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            sent -= sent.max(axis=1, keepdims=True)
            new[part] = damping * message[part] + (1 - damping) * sent
        done = not len(new) or np.abs(new - message).max() < 1e-4
        message = new
        if done:
            break
    belief = node.copy()
    np.add.at(belief, b, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(
    text: str, base: list[tuple[str, int, int]], field: Field, threshold: float
) -> list[tuple[str, int, int]]:
    g = graph(text, base)
    open_ = g.observed < 0
    mail = np.array(["@" in text[s:e] for s, e in g.spans], bool)
    if not (open_ & (mail | (g.run_digits >= LEAST_DIGITS))).any():
        return []
    p = marginals(g, field)
    best = p[:, 1:].argmax(axis=1) + 1
    chosen = open_ & (p[np.arange(len(best)), best] >= threshold)
    found = []
    groups: list[list[int]] = []
    side = set(map(tuple, g.chain.tolist()))
    linked = set(g.skip.ravel().tolist())
    for i in np.flatnonzero(chosen).tolist():
        last = groups[-1][-1] if groups else None
        # groups of one number: linked as such, or short ones side by side without any link
        if last is not None and (last, i) in side and best[last] == best[i] and not mail[i] and not mail[last] and (
                (last, i) in g.together or last not in linked and i not in linked
                and min(g.digits[last], g.digits[i]) < LEAST_DIGITS
                and sum(g.digits[j] for j in groups[-1]) + g.digits[i] <= _LONGEST
                and text[g.spans[last][1] - 1] != "."):
            groups[-1].append(i)
        else:
            groups.append([i])
    for group in groups:
        kind = KINDS[best[group[0]] - 1]
        if not mail[group[0]] and sum(g.digits[j] for j in group) < LEAST_DIGITS:
            continue
        start, end = g.spans[group[0]][0], g.spans[group[-1]][1]
        token = text[start:end]
        left = len(token) - len(token.lstrip(_STRIP))
        start += left
        end -= len(token) - len(token.rstrip(_STRIP))
        if left and text[start - 1] == "(" and ")" in text[start:end]:
            start -= 1
        if start < end:
            found.append((kind, start, end))
    return found


def pii_spans(
    text: str | None, field: Field, threshold: float = 0.5
) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, base`` by kind, then start."""
    if not text or not _CANDIDATE.search(text):
        return []
    base = base_spans(text)
    spans = [(*s, True) for s in base]
    spans += [(*s, False) for s in added_spans(text, base, field, threshold)]
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def train(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", sample_docs: int = 3_000,
    max_chars: int = 20_000,
) -> Field:
    """Fit on the documents of up to ``max_chars`` code points among the ``sample_docs`` whose ids
    hash lowest: at most their product reaches the driver."""
    ids = docs.select(F.col(id_column).alias("i")).where("i is not null").distinct().orderBy(
        F.xxhash64("i"), "i").limit(sample_docs)
    chosen = [r.i for r in ids.collect()]
    if not chosen:
        return Field.prior()
    sample = docs.where(
        F.col(id_column).isin(chosen) & (F.char_length(text) <= max_chars)
        & F.col(text).rlike("[0-9@]")
    ).select(text).distinct().orderBy(text)
    return fit([r[0] for r in sample.collect()])


def find(docs: DataFrame, field: Field, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``pii``: an array of ``kind, start, end, base`` per text."""

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([pii_spans(t, field, threshold) for t in texts], dtype=object)

    return docs.withColumn("pii", scan(F.col(text)))


def digest(spans: Column) -> Column:
    """``kind:start:end`` in order, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
