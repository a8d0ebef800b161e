"""The audit against plain counting, in Python and (for the query) in SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from closebell.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, value int, term string"


def brute(rows, min_docs=3, top=200):
    """rows: (text, lang, source) -> the whole answer, term by term."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        counts, held, total = {}, {}, {}
        for text, at, source in rows:
            if at != lang:
                continue
            group = counts.setdefault(source, {})
            found = TERM.findall(text.translate(LOWER))
            for t in found:
                group[t] = group.get(t, 0) + 1
                total[t] = total.get(t, 0) + 1
            for t in set(found):
                held[t] = held.get(t, 0) + 1
        kept = [t for t in total if held[t] >= min_docs]
        v = len(kept)

        def shares(group):
            n = sum(group.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (group.get(t, 0) + 1) // (n + v) for t in kept}

        p, q = {s: shares(g) for s, g in counts.items()}, shares(total)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o)
                     for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept
                     if counts[s].get(t, 0) and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)
                        if part == "pair" or k < top]
    return sorted(out)


def corpus(n, seed, sources=4):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "aÉb" for b in "xYß" for c in ("", "q", "Ω", "zz")]
    rows = []
    for _ in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(sources)}"
        text = "".join(rng.choice(words) + rng.choice((" ", "-1", "\n", "_")) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(("en", "de", None)), source))
    rows += [(None, "en", None), ("", "fr", "a"), ("one two", "fr", "b"), rows[0], rows[0]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, a, s, 1, "x") for i, (t, a, s) in enumerate(rows)], SCHEMA).repartition(3)


def answer(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("bucket, tile, held, cells", [(1024, 64, 300_000, 1 << 20), (3, 2, 10, 5)])
def test_equals_counting(spark, monkeypatch, bucket, tile, held, cells):
    for name, value in (("BUCKET", bucket), ("TILE", tile), ("HELD", held), ("CELLS", cells)):
        monkeypatch.setattr(D, name, value)
    rows = corpus(150, bucket)
    assert answer(D.audit(frame(spark, rows), top=5)) == brute(rows, top=5)


def test_terms_in_few_documents_are_left_out(spark):
    rows = [("rare rare rare", "en", "a"), ("rare common", "en", "b"), ("common", "en", "a"), ("Common", "en", "b")]
    assert answer(D.audit(frame(spark, rows))) == brute(rows)
    assert {r[3] for r in brute(rows) if r[2] == "term"} <= {"common"}


def test_words_of_ids_hold_64_terms(spark, monkeypatch):
    """More terms than a word has bits, all with the same count: whole words and a part of one."""
    words = " ".join(f"{a}{b}" for a in "abcdefghijklm" for b in "nopqrstuvwxyz")
    rows = [(words, "en", f"s{i % 3}") for i in range(6)] + [(words[:100], "en", "s0"), ("zz " * 9, "en", "s1")]
    assert answer(D.audit(frame(spark, rows))) == brute(rows)
    levels = D.level_bitmaps(D.group_counts(frame(spark, rows)))
    assert levels.agg(F.max(F.bit_count("bits"))).first()[0] == 64


def test_long_text(spark):
    long = ("alpha Beta " * 600_000) + "x" * 5_000_000
    rows = [(long, "en", "a"), ("alpha", "en", "b"), ("beta alpha", "en", "b"), ("beta", "en", "c")]
    assert answer(D.audit(frame(spark, rows))) == brute(rows)


def test_empty(spark):
    df = D.audit(frame(spark, corpus(1, 1)).limit(0))
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"] and not df.collect()
