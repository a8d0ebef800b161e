"""Packing against whole-text tokenisation, plain subset sums and the laws of a packing."""

import itertools
import json
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from closebell.llm import packing as P

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


def expected_pieces(rows, capacity, encode):
    out = []
    for doc, text in rows:
        ids = [*encode(text or ""), 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out.append((doc, n, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check_packing(rows, capacity):
    """Every sequence is filled from 0 without gaps or overlaps; returns how many there are."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_words_alone_have_the_ids_of_the_whole_text():
    plain = tokenizer()
    encode = P._encoder(WORD_BPE)
    rng = random.Random(5)
    odd = ["can't", "O'REILLY's", "x²", "ﬁne", "é", "́lone", "İstanbul", "ΣΑΣ", "a b", "a b",
           "\x1c", "a\x85b", "<|endoftext|>", "x<|startoftext|>y", "😀😀", "日本語", "...!?", "12345", "​", "\x00", "№5", "'s", "'"]
    texts = [" ".join(rng.choice(odd) + rng.choice(["", "", rng.choice(odd)]) for _ in range(30)) for _ in range(300)]
    texts += [rng.choice(" \t\n\r\x0b\x0c").join(rng.sample(odd, 9)) for _ in range(50)] + ["", " ", "\n \t"]
    for text in texts:
        got = np.frombuffer(encode(text.encode().split()), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids, text


def test_query_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = tokenizer()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = P.pack(docs, WORD_BPE).collect()
    want = expected_pieces(rows, 4096, lambda t: plain.encode(t, add_special_tokens=False).ids)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
    least = -(-sum(w[3] for w in want) // 4096)
    assert least <= check_packing(got, 4096) <= least + 1


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.randint(1, 40)
        counts = Counter(rng.randint(1, 20) for _ in range(rng.randint(0, 7)))
        items = sorted(counts.elements())
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k)
                   if sum(c) <= capacity)
        chosen = P.fullest(sorted(counts.items(), reverse=True), capacity)
        assert sum(n * x for x, n in chosen) == best
        assert all(n <= counts[x] for x, n in chosen)


@pytest.mark.parametrize("seed", range(6))
def test_every_pattern_is_the_fullest_left(seed):
    """Replayed one sequence at a time: each holds the longest piece left and has the least slack."""
    rng = random.Random(seed)
    capacity = rng.choice((10, 37, 64))
    left = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 60)))
    for pattern, times in P.minimum_slack(dict(left), capacity):
        assert times > 0
        for _ in range(times):
            longest = max(left)
            rest = left - Counter([longest])
            best = P.fullest(sorted(((x, n) for x, n in rest.items() if x <= capacity - longest), reverse=True),
                             capacity - longest)
            assert sum(x * n for x, n in pattern) == longest + sum(x * n for x, n in best) <= capacity
            assert all(left[x] >= n for x, n in pattern)
            left -= Counter(dict(pattern))
    assert not left


def test_few_sequences_against_first_fit():
    rng = random.Random(3)
    items = [rng.choice((rng.randint(1, 4096), rng.randint(1, 300))) for _ in range(3000)]
    bins = []
    for x in sorted(items, reverse=True):
        spot = next((i for i, b in enumerate(bins) if b + x <= 4096), None)
        if spot is None:
            bins.append(x)
        else:
            bins[spot] += x
    got = sum(t for _, t in P.minimum_slack(Counter(items), 4096))
    assert -(-sum(items) // 4096) <= got <= len(bins)


def test_rows(spark, monkeypatch):
    """Small sequences, slices of a few pieces, nulls, repeats and a hot length."""
    monkeypatch.setattr(P, "PIECES_PER_SLICE", 3)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["cat", "dog's", "naïve", "42"], k=rng.randrange(40)))) for i in range(80)]
    rows += [(7, "same words here")] * 50 + [(None, None), (None, ""), (None, None), (900, "word " * 5000)]
    docs = spark.createDataFrame([(d, t, 5, "x") for d, t in rows], "doc_id long, text string, length int, piece string")
    got = P.pack(docs.repartition(3), WORD_BPE, capacity=16).collect()
    plain = tokenizer()
    want = expected_pieces(rows, 16, lambda t: plain.encode(t, add_special_tokens=False).ids)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
    least = -(-sum(w[3] for w in want) // 16)
    assert least <= check_packing(got, 16) <= least + 2


def test_long_text_is_cut_as_it_is_read(monkeypatch):
    from closebell.llm import words

    text = " ".join(f"word{i % 97}" for i in range(20_000))
    whole = list(P.cut(text, P._encoder(WORD_BPE), 1, 4096))
    monkeypatch.setattr(words.parts, "__defaults__", (1000,))
    assert list(P.cut(text, P._encoder(WORD_BPE), 1, 4096)) == whole
    assert [len(x) for x in whole[:-1]] == [4 * 4096] * (len(whole) - 1)


def test_many_shuffle_partitions_give_few_files(spark, monkeypatch):
    given = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in given}
    docs = spark.createDataFrame([(i, "word " * (i % 50)) for i in range(400)], "doc_id long, text string")
    cores = spark.sparkContext.defaultParallelism
    try:
        for k, v in given.items():
            spark.conf.set(k, v)
        got = P.pack(docs, WORD_BPE)
        assert got.rdd.getNumPartitions() <= cores
        rows = got.collect()
        monkeypatch.setattr(P, "PIECES_PER_FILE", 400 // (cores + 3))
        assert cores < P.pack(docs, WORD_BPE).rdd.getNumPartitions() <= cores + 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.doc_id for r in rows) == list(range(400))
    check_packing(rows, 4096)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(docs, WORD_BPE).collect() == []


def test_other_tokenisers_are_refused(tmp_path):
    assert P.splits_at_spaces(WORD_BPE)
    assert not P.splits_at_spaces(public_tokenizers.path("byte_bpe_50k.json"))
    made = json.load(open(WORD_BPE, encoding="utf-8"))
    made["normalizer"]["normalizers"].append({"type": "Prepend", "prepend": "_"})
    path = tmp_path / "t.json"
    path.write_text(json.dumps(made))
    assert not P.splits_at_spaces(str(path))


def test_the_library_sees_each_run_of_letters_once(tmp_path, monkeypatch):
    import tokenizers

    seen = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        from_file = classmethod(lambda cls, path: cls(tokenizers_class.from_file(path)))
        from_str = classmethod(lambda cls, made: cls(tokenizers_class.from_str(made)))

        def get_vocab(self):
            return self.inner.get_vocab()

        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

    tokenizers_class = tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    path = tmp_path / "copy.json"
    path.write_bytes(open(WORD_BPE, "rb").read())
    rng = random.Random(2)
    cores = ["".join(rng.choices("aeinrsté", k=9)) for _ in range(900)]
    text = " ".join(f(c) + end for c in cores for f in (str.lower, str.upper) for end in ("", ",", "$$$", "...!", "_(\\"))
    got = np.frombuffer(P._encoder(str(path))(text.encode().split()), "<u4").tolist()
    assert got == tokenizers_class.from_file(WORD_BPE).encode(text, add_special_tokens=False).ids
    assert len(seen) < 20 and sum(map(len, seen)) < 1.2 * sum(len(c) + 1 for c in set(cores))


@pytest.mark.parametrize("kept", [1, 1 << 24])
def test_texts_looked_up_together(monkeypatch, kept):
    """Chunks of some texts, long ones by themselves, however little is remembered."""
    import pyarrow as pa

    monkeypatch.setattr(P, "REMEMBERED_BYTES", kept, raising=False)
    rng = random.Random(8)
    odd = ["can't", "Été!", "ÀÉ--", "x²", "<|endoftext|>", "a<|endoftext|>", "...", "e\u0301!", "a\x1cb", "12", "n'", "İ.", "ſt"]
    texts = ["", "", *(rng.choice(" \t\n\r\x0b\x0c").join(rng.choices(odd, k=rng.randrange(12))) for _ in range(60)),
             "", "word " * 200, " lead", "", "trail ", ""]
    monkeypatch.setattr(P, "CHUNK_BYTES", 300)
    ranges = list(P._in_chunks(pa.array(texts)))
    assert [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]] and ranges[-1][1] == len(texts)
    assert all(b - a == 1 or sum(len(t.encode()) for t in texts[a:b]) <= 300 for a, b in ranges)
    ids_of, plain = P._looked_up.__wrapped__(WORD_BPE), tokenizer()
    got = [list(P._encoded(pa.array(texts[a:b]), ids_of)) for a, b in ranges]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for part in got for x in part] == want
    assert list(P._in_chunks(pa.array([], pa.string()))) == []
