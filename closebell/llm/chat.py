"""Chat formatting as a prefix tree: turns that conversations share are written once.

A conversation is a path of turns from a root. A node is a turn with everything before it, named by
a chained digest, so equal beginnings meet in one node. Conversations are sorted by their paths; in
that order the tree is walked depth-first, and each conversation adds only the turns below the
point where it leaves the one before. A shard (one task's range of paths) is a training sequence
of its own: at its beginning it restates the path it continues, so at most one path per shard
border is written twice.

For every node the output has the rendered segment, where it stands in the shard's sequence
(``start``, ``end``), the position id of its first unit (units on the path above it), the
intervals of its ancestors in the sequence, joined where they touch (a unit attends to these and
to the units before it in its own segment), and the loss mask over assistant texts, in code points
of the segment and in units of the sequence. Units are code points, or tokens of a given tokenizer.

The template renders a turn as ``### role: text</turn>`` and a line feed. In roles and texts the
characters ``\\``, ``#``, ``<`` and ``:`` are preceded by ``\\`` (``:`` in roles only), so no text can
contain a control string, and reading back is exact.

Defined results: null roles and texts are empty. Turns are ordered by ``turn`` (nulls first), then
role and text, so ties and repeated rows have one order; a null conversation id is a conversation
like any other. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.session import stage

_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.)*+)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, characters: str = "\\#<") -> str:
    for c in characters:
        text = text.replace(c, "\\" + c)
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands after it."""
    return f"### {escape(role, chr(92) + '#<:')}: ", escape(text), "</turn>\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """``role, text`` of each turn of a rendered conversation."""
    found, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return found


def _counter(tokenizer: str | None):
    """``units(text) -> (number, ids)``: tokens of the tokenizer file, or one per code point."""
    if tokenizer is None:
        return lambda text: (len(text), None)
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(tokenizer)
    loaded.encode_special_tokens = True

    def count(text):
        ids = loaded.encode(text, add_special_tokens=False).ids
        return len(ids), ids

    return count


PATHS = "conv_id long, conv_null boolean, leaf string, nodes array<binary>"


def _paths(turns: DataFrame) -> DataFrame:
    """One row per conversation: the digests of its nodes, from the root to its last turn.

    Turns are dealt by conversation and sorted inside the partition; digests are chained while
    the rows stream by. A conversation is one path, so its digests make one row.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, nodes, started = None, [], False

        def row():
            name = None if pd.isna(current) else int(current)
            return name, name is None, nodes[-1].hex(), nodes

        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                same = started and (conv == current or (pd.isna(conv) and pd.isna(current)))
                if not same:
                    if started:
                        out.append(row())
                    current, nodes, started = conv, [], True
                above = nodes[-1] if nodes else b""
                segment = "".join(render(role, text)).encode()
                nodes.append(hashlib.blake2b(above + segment, digest_size=16).digest())
            yield _frame(out)
        if started:
            yield _frame([row()])

    def _frame(rows):
        frame = pd.DataFrame(rows, columns=["conv_id", "conv_null", "leaf", "nodes"])
        return frame.astype({"conv_id": "Int64"})

    return ordered.select("conv_id", "role", "text").mapInPandas(chain, PATHS)


PLACES = "key long, conv_null boolean, leaf string, shard int, number long, shared int, size int"


def _places(first: DataFrame) -> DataFrame:
    """Where each distinct path stands: its shard, its rank there and how many turns it shares
    with the path before. Only digests are sorted; the path is the key, dealt by range."""
    ordered = first.repartitionByRange("nodes").sortWithinPartitions("nodes")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, number, before = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                nodes = [bytes(n) for n in row.nodes]
                shared = 0
                while shared < min(len(before), len(nodes)) and before[shared] == nodes[shared]:
                    shared += 1
                out.append((row.key, row.conv_null, row.leaf, shard, number, shared, len(nodes)))
                before, number = nodes, number + 1
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PLACES.split(", ")])

    return ordered.select("key", "conv_null", "leaf", "nodes").mapInPandas(walk, PLACES)


SEQUENCE = (
    "shard int, number long, conv_id long, depth int, segment string, loss_start long, "
    "loss_end long, start long, end long, position long, "
    "ancestors array<struct<start:long,end:long>>, mask_start long, mask_end long, "
    "tokens array<int>, leaf string"
)
_COLUMNS = ("shard", "number", "conv_id", "depth", "segment", "loss_start", "loss_end", "start",
            "end", "position", "ancestors", "mask_start", "mask_end", "tokens", "leaf")
_WHOLE = ("conv_id", "loss_start", "loss_end", "start", "end", "position", "mask_start", "mask_end")


def _sequence(turns: DataFrame, places: DataFrame, tokenizer: str | None) -> DataFrame:
    """The depth-first sequences of all shards, from one conversation for each distinct path."""
    texts = turns.withColumn("conv_null", F.col("conv_id").isNull()).withColumn(
        "key", F.coalesce("conv_id", F.lit(0)))
    placed = texts.join(places, ["key", "conv_null"]).select(
        "shard", "number", "shared", "size", "leaf", "conv_id", "turn", "role", "text")
    ordered = placed.repartition("shard").sortWithinPartitions(
        "shard", "number", F.col("turn").asc_nulls_first(), "role", "text")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(tokenizer)
        # of the path being walked: units up to and with each turn, intervals up to and with it
        path: list[tuple[int, tuple]] = []
        shard, at, number, current, depth = None, 0, 0, None, 0
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, at, number, current, path = row.shard, 0, 0, None, []
                if row.number != current:
                    current, depth = row.number, 0
                    del path[row.shared:]
                leaf = row.leaf if depth == row.size - 1 else None
                if depth >= row.shared:
                    head, body, tail = render(row.role, row.text)
                    sizes, ids = zip(*(count(part) for part in (head, body, tail)))
                    units = sum(sizes)
                    above, spans = path[-1] if path else (0, ())
                    own = ((spans[-1][0], at + units) if spans and spans[-1][1] == at
                           else (at, at + units))
                    joined = (*(spans[:-1] if own[0] != at else spans), own)
                    path.append((above + units, joined))
                    said = row.role == "assistant"
                    out.append((
                        shard, number, row.conv_id, depth, head + body + tail,
                        len(head) if said else None, len(head) + len(body) if said else None,
                        at, at + units, above, list(spans),
                        at + sizes[0] if said else None, at + sizes[0] + sizes[1] if said else None,
                        None if ids[0] is None else [t for part in ids for t in part], leaf,
                    ))
                    number, at = number + 1, at + units
                elif leaf is not None:  # a path that ends inside the one before
                    out.append((shard, number, row.conv_id, depth, *[None] * 10, leaf))
                    number += 1
                depth += 1
            frame = pd.DataFrame(out, columns=_COLUMNS)
            yield frame.astype({c: "Int64" for c in _WHOLE})

    return ordered.mapInPandas(walk, SEQUENCE)


def prepared(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` without null roles and texts."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )


def format_tree(
    conversations: DataFrame, tokenizer: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(sequence, members). ``sequence`` has a row per node in depth-first order within ``shard``
    (by ``number``); a row without a segment marks a conversation that ends at a node written
    before. ``members`` maps ``conv_id`` to its ``leaf``, however many share one."""
    turns = prepared(conversations)
    paths = stage(_paths(turns), "chat-paths")
    # copies of a conversation meet as one row per task before the shuffle
    first = paths.groupBy("leaf").agg(
        F.min(F.struct("conv_null", "conv_id")).alias("c")
    ).select("leaf", "c.*")
    nodes = paths.select(F.coalesce("conv_id", F.lit(0)).alias("key"), "conv_null", "nodes")
    first = first.withColumn("key", F.coalesce("conv_id", F.lit(0))).join(
        nodes, ["key", "conv_null"])
    places = stage(_places(first), "chat-places")
    sequence = stage(_sequence(turns, places, tokenizer), "chat-sequence")
    return sequence, paths.select("conv_id", "leaf")


READ = "leaf string, formatted string, loss array<struct<start:long,end:long>>"


def read_back(sequence: DataFrame) -> DataFrame:
    """``leaf, formatted, loss``: the text of every path and the spans under its loss mask, from
    the sequence alone. Segments of the path being walked are kept; a row says how deep it is."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, path = None, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, path = row.shard, []
                if row.segment is not None:
                    del path[row.depth:]
                    masked = None if pd.isna(row.loss_start) else (
                        int(row.loss_start), int(row.loss_end))
                    path.append((row.segment, masked))
                if row.leaf is not None:
                    at, spans = 0, []
                    for segment, masked in path[:row.depth + 1]:
                        if masked:
                            spans.append((at + masked[0], at + masked[1]))
                        at += len(segment)
                    out.append((row.leaf, "".join(x for x, _ in path[:row.depth + 1]), spans))
            yield pd.DataFrame(out, columns=["leaf", "formatted", "loss"])

    dealt = sequence.select("shard", "number", "depth", "segment", "loss_start", "loss_end", "leaf")
    return dealt.repartition("shard").sortWithinPartitions("shard", "number").mapInPandas(
        read, READ)


DIGESTS = (
    "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the parsed turns and of the text under the mask, per path."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for leaf, text, spans in zip(batch["leaf"], batch["formatted"], batch["loss"]):
                turns, whole, loss, chars = read_turns(text), hashlib.sha256(), hashlib.sha256(), 0
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"]:span["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                out.append((leaf, len(turns), whole.hexdigest(), chars, loss.hexdigest(),
                            len(text)))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in DIGESTS.split(", ")])
            yield frame.astype({"n_turns": np.int64, "loss_chars": np.int64,
                                "formatted_chars": np.int64})

    return formatted.mapInPandas(parse, DIGESTS)
