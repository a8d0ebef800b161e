"""Word variants against comparing all words with all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from closebell.llm import spelling as S
from closebell.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one character inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    return a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:]


def counted(rows, every=97, least=3):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def brute(n):
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    close = {w: [o for k in (-1, 0, 1) for o in by_size.get(len(w) + k, ()) if near(w, o)] for w in n}
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n.get(form.get(w))))
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    """Words over few letters: runs of equal ones, dense groups, ties, long chains."""
    rng = random.Random(seed)
    alphabet = "abé" if seed else "ab"
    n = {}
    for _ in range(400):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(5, 8)))
        n[w] = rng.choice((3, 3, 5, 10, 25, 60, 200))
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    want = {w: (k, f) for w, _, _, _, k, f in brute(n) if k}
    got = {r.word: r for r in S.neighbours(words).collect()}
    assert set(got) == set(want)
    for w, (k, _) in want.items():
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o))
        assert (got[w].n_near, got[w].near, got[w].near_n) == (k, best, n[best]) and k == len(others)


def test_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 50)
    rng = random.Random(4)
    base = ["Straße", "colour", "color", "colours", "naïveté", "ÀÉÎ×÷õ", "bookkeeper", "aaaaaa", "aaaaa", "HELLO", "hella"]
    rows = []
    for i in range(400):
        picked = [rng.choice(base) for _ in range(12)]
        rows.append((i if i % 9 else None, "".join(w + rng.choice((" ", "1", "ž", "日", "_", "\n")) for w in picked)))
    rows += [(5, None), (6, ""), rows[1], rows[1]]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    got = answer(S.variants(docs.repartition(3), every=7))
    assert got == brute(counted(rows, every=7))
    assert any(form for _, form, *_ in got)
    assert answer(S.variants(docs)) == brute(counted(rows, every=0))


def test_chains(spark):
    """Forms of forms: the root is the last of the chain."""
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb", "aabbbbbb"]
    n = {w: 3 * 2 ** i for i, w in enumerate(chain)}
    forms = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    assert {r.word: r.root for r in S.roots(forms).collect()} == {w: chain[-1] for w in chain[:-1]}
    assert [r for r in brute(n) if r[0] == chain[0]][0][2] == chain[-1]


def test_long_text(spark):
    text = "separate seperate " * 300_000 + "x" * 5_000_000 + " separate separate" * 3 * 300_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert answer(S.variants(docs, every=97)) == brute(counted([(1, text)]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = answer(QUERIES["op13_spelling"](spark, sf))
    assert got == brute(counted(rows)) and any(r[1] for r in got)


def test_empty(spark):
    assert S.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert S.variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect() == []
