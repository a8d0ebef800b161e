"""Quality rules against plain counting."""

import random
import re

import pytest

from closebell.llm import host_quality as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stated(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_statistics_on_random_texts():
    rng = random.Random(1)
    pieces = ["a", "b", "é", " ", "\n", "\t", "\x0b", "\x0c", "\r", "#", "<", " ", " ", "ab c", "\U0001f600", "\x1f"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        assert H.text_stats(text) == stated(text), repr(text)
    assert H.text_stats(None) == (0, 0, 0, 0, 0)


GOOD = " ".join(f"word{i}" for i in range(60))
BAD = " ".join(["same old words"] * 60)


def test_hosts_and_documents(spark):
    rows = [(i, GOOD, "good") for i in range(40)]
    rows += [(100 + i, BAD if i < 38 else GOOD, "bad") for i in range(40)]
    rows += [(200, BAD, "good"), (201, None, None), (202, GOOD, None), (203, "", "good"), (5, GOOD, "good")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = {r.doc_id: r for r in H.judge(docs).collect()}
    assert all(got[i].kept for i in range(40))
    assert not any(got[100 + i].kept for i in range(40))  # good texts of a rejected host too
    assert got[139].rule_failed is False
    assert got[200].base_failed and got[203].base_failed and got[201].base_failed
    kept = sorted(r.doc_id for r in H.keep_good(docs).collect())
    assert kept == sorted([*range(40), 5] + [i for i in (202,) if got[i].kept])


@pytest.mark.parametrize("extra", ["kept int", "n_words int", "_text string"])
def test_clashing_columns_and_empty_tables(spark, extra):
    kind = "x" if extra.endswith("string") else 7
    docs = spark.createDataFrame([(1, GOOD, "h", kind)], f"doc_id long, text string, source string, {extra}")
    assert H.judge(docs).first().n_words == 60
    assert [tuple(r) for r in H.keep_good(docs).collect()] == [(1, GOOD, "h", kind)]
    assert H.judge(docs.limit(0)).count() == 0 and H.keep_good(docs.limit(0)).count() == 0
