"""Decontamination against full edit-distance tables."""

import random
import tracemalloc

import numpy as np

from closebell.llm import decontaminate as D
from closebell.llm.queries import QUERIES


def best_edits(item, text):
    """Least edits between the item and any stretch of the text."""
    cost = np.zeros(len(text) + 1, int)
    codes = np.frombuffer(text, np.uint8)
    for i, c in enumerate(item, 1):
        step = np.empty_like(cost)
        step[0] = i
        step[1:] = np.minimum(cost[:-1] + (codes != c), cost[1:] + 1)
        cost = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
    return int(cost.min())


def edited(rng, raw, edits):
    raw = bytearray(raw)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(raw))
        if kind == 0:
            raw[at] = rng.randrange(97, 123)
        elif kind == 1:
            del raw[at]
        else:
            raw.insert(at, rng.randrange(97, 123))
    return bytes(raw)


def text_of(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(n))


def test_every_occurrence_within_the_budget_is_found():
    rng = random.Random(1)
    items = [(i, D.normalise(text_of(rng, rng.randint(8, 60)))) for i in range(25)]
    items = [x for x in items if len(x[1]) >= D.MIN_BYTES]
    index = D.Index(items, 0.1)
    texts = []
    for _ in range(150):
        parts = [text_of(rng, rng.randint(0, 40)).encode()]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1]
            parts += [edited(rng, item, rng.randint(0, len(item) // 6)), text_of(rng, rng.randint(0, 9)).encode()]
        texts.append(b" ".join(parts))
    got = {}
    for t, i, start, end, edits in D.find(index, texts):
        got[t, i] = min(edits, got.get((t, i), 99))
        assert 0 <= start <= end <= len(texts[t])
    want = {}
    for t, text in enumerate(texts):
        for i, (_, item) in enumerate(items):
            edits = best_edits(item, text)
            if edits <= int(0.1 * len(item)):
                want[t, i] = edits
    assert got == want and len(want) > 50 and any(want.values())


def test_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (None, "short"), (3, "")], "item_id long, text string")
    rows = [(1, "x " + item.upper().replace(" ", "\n\t") + " y", 5), (2, None, 5), (3, "", 5), (None, item, 5),
            (4, "clean text " * 9000, 5), (4, "another", 5), (5, "the" + "\0" * 20, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    found = {(r.doc_id, r.item_id): (r.n_matches, r.edits) for r in D.contaminated(docs, bench).collect()}
    assert found == {(1, 1): (2, 0), (None, 1): (2, 0)}
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in D.drop_contaminated(docs, bench).collect())
    assert kept == [(False, 2), (False, 3), (False, 4), (False, 4), (False, 5)]
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    blocks = D.matches(docs, bench, block_bytes=1).count()
    assert blocks == D.matches(docs, bench).count()


def test_wide_regions_do_not_overflow():
    item = b"the quick brown fox jumps over the lazy dog again"
    region = b"z" * 36_000 + item.replace(b"quick", b"quack") + b"z" * 3_000
    assert D.align(item, [region], 4) == [(1, 36_000 + len(item))]


def test_parts_of_long_items_are_found(spark):
    rng = random.Random(5)
    words = text_of(rng, 100).split()
    item, other = " ".join(words), text_of(rng, 60)
    texts = {
        1: f"{other} {' '.join(words[:80])}",  # cut at the end of the document
        2: f"{other} {' '.join(words[20:])} {other}",
        3: f"{edited(rng, ' '.join(words[10:90]).encode(), 8).decode()} {other}",
        4: f"{item} {other}", 5: other, 6: " ".join(words[:8]),
        7: f"{item} {other} {' '.join(words[:80])}",
    }
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in D.contaminated(docs, bench).collect()}
    assert found.keys() == {1, 2, 3, 4, 7}
    assert found[1].bytes == found[3].bytes == D.PASSAGE
    assert found[4][2:] == (1, 0, len(item)) and found[7].n_matches > 1 and found[7].bytes == len(item)
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [5, 6]


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, D.normalise(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        text = D.normalise(r.text)
        for i, item in items:
            if len(item) >= D.MIN_BYTES and len(text) >= len(item) // 2:
                edits = best_edits(item, text)
                if edits <= int(0.1 * len(item)):
                    want[r.doc_id, i] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op2_decontaminate"](spark, sf).collect()}
    assert want and got == want


def test_short_items_and_quotes_of_parts(spark):
    rng = random.Random(8)
    short, medium = "seven zebras hum at noon", "which river flows through both vienna and the city of bratislava"
    assert len(short) < D.SHORT <= len(medium)
    other = text_of(rng, 40)
    texts = {
        1: f"{other} {short.upper()}, {other}".replace(",", ""), 2: f"{other} x{short} {other}", 3: f"{other} {short}s",
        4: short, 5: f"{other} {medium[:55]}", 6: f"{medium[-55:]} {other}", 7: f"{other} {medium[:30]} {other}",
        8: f"{other} {short[:-4]} {other}", 9: other,
    }
    bench = spark.createDataFrame([(1, short), (2, medium), (3, "a b")], "item_id long, text string")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert found == {(1, 1), (4, 1), (5, 2), (6, 2)}


def test_rows_are_judged_by_their_text(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    docs = spark.createDataFrame(
        [(None, item, "a"), (1, item, "b"), (1, "clean", "c"), (None, "clean", "d"), (1, "clean", "c")],
        "doc_id long, text string, `_row` string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r[2] for r in kept.collect()) == ["c", "c", "d"]


def test_texts_are_drawn_a_buffer_at_a_time(monkeypatch):
    rng = random.Random(4)
    items = [(i, D.normalise(text_of(rng, 20))) for i in range(5)]
    texts = [b" ".join([text_of(rng, 30).encode(), rng.choice(items)[1]]) for _ in range(60)]
    index = D.Index(items, 0.1)
    want = D.find(index, texts)
    drawn, ahead, search = [0], [], D._find

    def counted():
        for text in texts:
            drawn[0] += 1
            yield text

    def seen(index, raw, starts, some, first):
        ahead.append(drawn[0] - first)
        return search(index, raw, starts, some, first)

    monkeypatch.setattr(D, "_BUFFER", 2_000)
    monkeypatch.setattr(D, "_find", seen)
    assert {f[:2] for f in D.find(index, counted())} == {f[:2] for f in want} and len(want) >= 60
    assert len(ahead) > 5 and max(ahead) <= 2_000 // min(map(len, texts)) + 1


def test_grams_of_a_long_text_are_not_held_at_once(monkeypatch):
    rng = random.Random(6)
    items = [(i, D.normalise(text_of(rng, 20))) for i in range(5)]
    index = D.Index(items, 0.1)
    raw = rng.randbytes(8 << 20)
    tracemalloc.start()
    index.hits(raw)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(raw)
    for text in (b"", b"short", b" ".join(rng.choice(items)[1] for _ in range(200))):
        monkeypatch.setattr(D, "_POSITIONS", 1 << 30)
        once = index.hits(text)
        for size in (1, 7, 100, 4096):
            monkeypatch.setattr(D, "_POSITIONS", size)
            assert all(np.array_equal(a, b) for a, b in zip(once, index.hits(text), strict=True))


def test_hits_of_a_buffer_are_not_held_at_once(monkeypatch):
    """Texts that share most grams with the items: a buffer's hits are many times the buffer."""
    rng = random.Random(7)
    items = [(i, D.normalise(text_of(rng, 20) + " and so on and so forth ")) for i in range(5)]
    texts = [edited(rng, b"and so on and so forth " * 20 + rng.choice(items)[1], 5) for _ in range(60)]
    index = D.Index(items, 0.1)
    raw = b"".join(t + b"\0" * D.Q for t in texts)
    starts = np.cumsum([0, *(len(t) + D.Q for t in texts[:-1])])
    peaks, bands = [], []
    for size in (1 << 30, 1 << 11, 1):
        monkeypatch.setattr(D, "_POSITIONS", size)
        tracemalloc.start()
        bands.append(sum(1 for _ in D._bands(index, starts, raw)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert bands[0] == bands[1] == bands[2] > 0
    assert peaks[1] < peaks[0] / 5
    monkeypatch.setattr(D, "_POSITIONS", 1 << 30)
    whole = sorted(D._bands(index, starts, raw))
    for size in (1, 1500, 1 << 13):
        monkeypatch.setattr(D, "_POSITIONS", size)
        assert sorted(D._bands(index, starts, raw)) == whole
