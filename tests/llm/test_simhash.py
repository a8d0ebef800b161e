"""SimHash classes against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash

from closebell.llm import simhash as S
from closebell.llm.components import components
from closebell.llm.queries import QUERIES


def stated(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute(rows, budget=3):
    prints = [(d, stated(t)) for d, t in rows]
    name = list(range(len(prints)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= budget:
                name[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, f"{p:016x}", least.get(root(i))) for i, (d, p) in enumerate(prints)]


def test_fingerprints():
    rng = random.Random(2)
    pieces = ["a", "B", "É", "ſ", " ", "\t", " ", "x y", "\x1c", "word"]
    for n in list(range(12)) * 60:
        text = "".join(rng.choice(pieces) for _ in range(n))
        assert S.fingerprint(text) == stated(text), repr(text)
    assert S.fingerprint(None) == 0


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = "x%d" % rng.randrange(10**6)
    return " ".join(words)


def planted(seed=3):
    rng, rows = random.Random(seed), []
    for _ in range(12):
        base = ["w%d" % rng.randrange(10**5) for _ in range(rng.randint(80, 900))]
        rows += [near(rng, base, rng.choice([0, 0, 1, 2, 5])) for _ in range(rng.randint(1, 9))]
    rows += [None, "", " \t ", "one", "one", "one two"]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("per_task", [50_000, 4])
def test_classes(spark, monkeypatch, per_task):
    if per_task == 4:  # every block is dealt into chunks
        links = S.links
        monkeypatch.setattr(S, "links", lambda p, b: links(p, b, per_task=4))
    rows = planted() + [(None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, S.near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_a_dense_class_gives_linear_links():
    rng = np.random.default_rng(5)
    flips = np.uint64(1) << rng.integers(0, 64, (4000, 2)).astype(np.uint64)
    values = np.unique(np.uint64(0x123456789ABCDEF0) ^ np.bitwise_or.reduce(flips, axis=1))
    star = S._star(values, 0, 3, 0)
    assert len(star) <= len(values) - 1


def test_components_of_a_path(spark):
    n = 200
    path = spark.range(n).selectExpr("id as u", "id + 1 as v")
    got = {r.vertex: r.root for r in components(path).collect()}
    assert got == {i: 0 for i in range(1, n + 1)}
    assert components(path.limit(0)).count() == 0
    assert components(spark.range(3).selectExpr("id as u", "id as v")).count() == 0


def test_keep_one(spark):
    text = " ".join("w%d" % i for i in range(200))
    rows = [(7, text, 1, "a"), (3, text, 2, "b"), (3, text, 1, "c"), (9, "other words here", 0, "d"),
            (None, text, 5, "e"), (None, text, 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, fp string").repartition(3)
    got = sorted(map(tuple, S.keep_one(docs).collect()), key=str)
    assert got[1] == (9, "other words here", 0, "d") and got[0] in rows[1:3] and len(got) == 2
    assert S.keep_one(docs.limit(0)).count() == 0
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op4_simhash"](spark, sf).collect()))
    assert got == sorted(brute(rows))


def test_rows_are_kept_by_their_text_not_their_id(spark):
    """Null, repeated and tied ids: one row of each class stays, whatever the ids are."""
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta " * 4, "one two three four five six seven " * 4,
               "completely other words stand in this third text " * 4)
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "y"), (3, b, "z"), (None, c, "n"), (None, c, "n"), (None, a, "m"),
            (7, "solo text of its own without any copies at all", "s"), (7, "and another one that has its very own words", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_key` string")
    kept = S.keep_one(docs.repartition(4))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [rows[0], rows[2], rows[4], rows[7], rows[8]], key=str)
    again = [(5, a, "p"), (5, a, "o"), (5, a, "o")]
    [one] = S.keep_one(spark.createDataFrame(again, docs.schema)).collect()
    assert tuple(one) in again
