"""Mixing against a plain recursive budget."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from closebell.llm import mixing as M
from closebell.llm.queries import MIX

LEVELS = ("domain", "lang", "source")


def shares(budget, children):
    """children: (name, weight, room) -> what each takes; a shortage goes to the siblings."""
    live = [c for c in children if c[1] > 0]
    taken = {name: 0 for name, _, _ in children}
    left = budget
    while live:
        level = left / sum(w for _, w, _ in live)
        short = min(live, key=lambda c: (c[2] / c[1], c[0]))
        if short[2] / short[1] > level:
            for name, w, _ in live:
                taken[name] = int(left * w / sum(x for _, x, _ in live))
            break
        taken[short[0]] = short[2]
        left -= short[2]
        live.remove(short)
    return taken


def plan(rows, weights, total, epochs, seed):
    """(doc_id, epoch) -> taken, by recursion over the tree."""
    out = {}

    def descend(level, group, budget):
        if level == len(LEVELS):
            held, used = sum(t for _, _, t in group), 0
            for epoch in range(epochs):
                key = lambda r: (hashlib.md5(f"{seed}:{epoch}:{r[0]}".encode()).hexdigest()[:15], r[0], r[2])  # noqa: E731,B023
                for doc, _, tokens in sorted(group, key=key):
                    if used < budget:
                        out[doc, epoch] = min(tokens, budget - used)
                    used += tokens
            return held
        names = sorted({r[1][level] for r in group})
        parts = {n: [r for r in group if r[1][level] == n] for n in names}
        stated = weights.get(LEVELS[level], {})
        given = shares(budget, [
            (n, stated.get(n, 1.0), epochs * sum(t for _, _, t in parts[n])) for n in names])
        for n in names:
            descend(level + 1, parts[n], given[n])

    descend(0, [r for r in rows if r[2] > 0], total)
    return out


@pytest.mark.parametrize("fraction, epochs", [(0.3, 1), (0.8, 2), (1.9, 2), (5.0, 2), (0.0, 1)])
def test_budgets(spark, monkeypatch, fraction, epochs):
    monkeypatch.setattr(M, "DOCUMENTS_PER_SLICE", 7)
    rng = random.Random(int(fraction * 10))
    rows = []
    for i in range(300):
        leaf = ("a", "x", "hot") if i % 3 == 0 else tuple(rng.choice(x) for x in ("abc", "xyz", "pqr"))
        rows.append((i, leaf, rng.randint(0, 30)))
    weights = {"domain": {"a": 5.0, "b": 1.0, "c": 0.0}, "lang": {"x": 3.0}}
    total = int(fraction * sum(t for *_, t in rows))
    docs = spark.createDataFrame([(d, *leaf, t) for d, leaf, t in rows],
                                 "doc_id long, domain string, lang string, source string, n long").repartition(4)
    got = M.plan(docs, LEVELS, weights, total=total, max_epochs=epochs, seed=9, tokens=F.col("n"))
    assert {(r.doc_id, r.epoch): r.taken for r in got.collect()} == plan(rows, weights, total, epochs, 9)


def test_words_and_prefixes(spark):
    texts = [None, "", "  ", "one", " one\ttwo\n\nthree ", "é\x0bü\x1fx y", "a b  c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", M.word_count(F.col("t")).alias("n"), M.prefix(F.col("t"), F.lit(2)).alias("p"))
    got = [(r.n, r.p) for r in df.collect()]
    assert [n for n, _ in got] == [0, 0, 0, 1, 3, 3, 3]
    assert got[4][1] == " one\ttwo" and got[6][1] == "a b" and got[5][1] == "é\x0bü\x1fx"


def test_sample_cuts_the_last_document(spark):
    docs = spark.createDataFrame(
        [(i, "w1 w2  w3 w4", None, "s", 1) for i in range(10)] + [(11, None, "en", None, 1)],
        "doc_id long, text string, lang string, source string, taken int")
    docs = docs.withColumn("domain", M.source_domain(F.col("source")))
    rows = M.sample(docs, total=10, max_epochs=1).collect()
    assert sorted(r.taken for r in rows) == [2, 4, 4]
    assert sorted(r.text for r in rows) == ["w1 w2", "w1 w2  w3 w4", "w1 w2  w3 w4"]
    assert M.sample(docs.limit(0)).count() == 0


def test_domains(spark):
    df = spark.createDataFrame([("src7",), ("x",), (None,), ("a99999999999",)], "s string")
    assert [r[0] for r in df.select(M.source_domain(F.col("s"))).collect()] == [
        "domain3", "domain0", "domain0", f"domain{999999999 % 4}"]


def test_query_parameters():
    assert MIX["max_epochs"] == 2 and set(MIX["weights"]) <= set(LEVELS)


def test_sample_tells_rows_apart_by_their_content(spark):
    """Rows that share an id, have none or are equal: the budget holds and no row is doubled."""
    words = lambda n, w: " ".join([w] * n)
    rows = [(2, words(60, "a"), "s", 1), (2, words(80, "b"), "s", 2), (None, words(30, "c"), "s", 3),
            (None, words(40, "d"), "s", 4), (5, words(20, "e"), "s", 5), (5, words(20, "e"), "s", 5), (6, None, "s", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int")
    got = M.sample(docs, levels=("source",), total=250, max_epochs=1).collect()
    assert sorted((r.doc_id or 0, r.tokens, r.taken) for r in got) == [
        (0, 3, 30), (0, 4, 40), (2, 1, 60), (2, 2, 80), (5, 5, 20), (5, 5, 20)]
    assert all(len(r.text.split()) == r.taken for r in got)
    for total in (1, 95, 155, 249, 400):
        part = M.sample(docs, levels=("source",), total=total, max_epochs=2).collect()
        assert sum(r.taken for r in part) == total == sum(len(r.text.split()) for r in part)
        per = {}
        for r in part:
            per[r.epoch, r.tokens] = per.get((r.epoch, r.tokens), 0) + 1
        assert all(n <= (2 if t == 5 else 1) for (_, t), n in per.items())
