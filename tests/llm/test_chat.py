"""Chat trees: an exact round trip, shared turns written once, and the intervals of ancestors."""

import hashlib
import os
import random

import pytest

from closebell.llm import chat
from closebell.llm.queries import HOSTILE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """conv_id -> contract columns, from the rows alone."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(
            (turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(len("".join(chat.render(r, x))) for r, x in turns),
        )
    return out


def hostile_rows(seed):
    rng = random.Random(seed)
    pieces = ["\\", "#", "<", ":", "</turn>", "### assistant: ", "\n", "ok", " ", "é", "\U0001f600"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
    openings = [("system", text()), ("user", text()), ("user", HOSTILE)]
    rows = []
    for conv in range(40):
        turns = [rng.choice(openings)] if rng.random() < 0.8 else []
        turns += [(rng.choice(["user", "assistant", "a:b\\", None]), rng.choice([text(), "same", None]))
                  for _ in range(rng.randint(0 if turns else 1, 4))]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


def test_round_trip(spark):
    rows = hostile_rows(1) + [(None, 0, "user", "x"), (None, None, "assistant", "y"),
                              (0, 0, "assistant", "tie"), (0, 0, "assistant", "tie")]
    sequence, members = chat.format_tree(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = members.join(chat.digests(chat.read_back(sequence)), "leaf").drop("leaf").collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows)
    assert len(got) == len(expected(rows))


def test_shared_turns_are_written_once_with_their_intervals(spark):
    texts = {"a": "first", "b": "second", "c": "third"}
    paths = ["a", "ab", "abc", "ac", "ab", "c"]
    rows = [(i, t, "user", texts[x]) for i, p in enumerate(paths) for t, x in enumerate(p)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        sequence, _ = chat.format_tree(df)
        nodes = sorted((r for r in sequence.collect() if r.segment is not None),
                       key=lambda r: (r.shard, r.number))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(nodes) == 5  # a, ab, abc, ac, c
    at = 0
    for n in nodes:
        assert (n.start, n.end) == (at, at + len(n.segment))
        at = n.end
        assert n.position == sum(s.end - s.start for s in n.ancestors)
        whole = "".join(x.segment for x in nodes)
        seen = "".join(whole[s.start:s.end] for s in n.ancestors) + n.segment
        assert len(chat.read_turns(seen)) == n.depth + 1
        assert (n.loss_start is None) == ("assistant" not in n.segment)


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"), reason="no vocabulary")
def test_tokens_of_a_tokenizer(spark):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", "general answer"), (2, 0, "user", "hello there")]
    sequence, _ = chat.format_tree(spark.createDataFrame(rows, SCHEMA).repartition(1), path)
    loaded = Tokenizer.from_file(path)
    for n in sequence.where("segment is not null").collect():
        assert n.end - n.start == len(n.tokens)
        assert loaded.decode(n.tokens) == n.segment
        if n.mask_start is not None:
            said = n.tokens[n.mask_start - n.start:n.mask_end - n.start]
            assert loaded.decode(said) == n.segment[n.loss_start:n.loss_end]


def test_empty_table_and_extra_columns(spark):
    sequence, members = chat.format_tree(spark.createDataFrame([], SCHEMA))
    assert sequence.count() == 0 and members.count() == 0
    df = spark.createDataFrame([(1, 0, "user", "x", 5, "n")], SCHEMA + ", leaf int, nodes string")
    sequence, members = chat.format_tree(df)
    assert members.count() == 1


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    got = QUERIES["op9_chat"](spark, sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows)
