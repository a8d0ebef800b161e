"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary trie self-join.

A pair within ``budget`` bits agrees on at least one of ``budget + 1`` equal blocks of the
fingerprint. Fingerprints are rotated so that each block leads once; those that share the leading
block form one trie, whose root is that block. Node pairs are traversed together, level by
level: a pair splits into its children's pairs, differing bits add up, and pairs beyond the
budget are dropped with everything below them.

Defined results: a null or empty text has no words and the fingerprint zero, which links like
any other; fewer words than a shingle give one shingle of all of them. Repeated rows and copies
share a fingerprint and are joined only as one. Rows without ``doc_id`` take part and get a
component, but are never its name. Extra columns stay; ``fingerprint`` and ``component_id`` are
replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from closebell.llm.components import components
from closebell.llm.rows import keyed, without
from closebell.session import stage

_CHUNK = 1 << 16  # shingles whose bits are added up at a time
_FRONTIER = 1 << 20  # node pairs held at a time; more wait on a stack
_LEAF = 16  # node pairs of at most so many fingerprint pairs are compared directly


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash; bit b is 1 if it is set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, ASCII spaces cut
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if n > 1 or len(
        words) == shingle else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        size = min(_CHUNK, n - start)
        hashes = np.fromiter((digest(next(grams), seed) for _ in range(size)), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > n, bitorder="little")
    return int(majority.view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The SimHash as a signed long column."""

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, shingle, seed)) for t in texts], dtype="int64")

    return of(text)


def _rotate(values: np.ndarray, by: int) -> np.ndarray:
    if not by:
        return values
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def trie_pairs(
    values: np.ndarray, depth: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of sorted distinct ``values`` that agree on the first ``depth`` bits
    and differ in at most ``budget`` bits, in batches.

    A node is a range of the sorted array. The frontier holds node pairs ``a0, a1, b0, b1`` with
    the bits by which they differ so far; a node paired with itself stands for the pairs inside.
    """
    if len(values) < 2:
        return
    lead = values >> np.uint64(64 - depth) if depth else np.zeros(len(values), np.uint64)
    cuts = np.flatnonzero(np.diff(lead)) + 1
    lo = np.concatenate(([0], cuts))
    hi = np.concatenate((cuts, [len(values)]))
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        level, a0, a1, b0, b1, cost = stack.pop()
        if len(a0) > _FRONTIER:
            half = len(a0) // 2
            stack.append((level, *(x[half:] for x in (a0, a1, b0, b1, cost))))
            a0, a1, b0, b1, cost = (x[:half] for x in (a0, a1, b0, b1, cost))
        done = ((a1 - a0) * (b1 - b0) <= _LEAF) | (level >= 64)
        if done.any():
            yield from _compare(values, *(x[done] for x in (a0, a1, b0, b1)), budget)
            a0, a1, b0, b1, cost = (x[~done] for x in (a0, a1, b0, b1, cost))
        if not len(a0):
            continue
        am, bm = _middle(values, a0, level), _middle(values, b0, level)
        am, bm = np.clip(am, a0, a1), np.clip(bm, b0, b1)
        own = a0 == b0
        children = []
        for x0, x1, y0, y1, step, which in (
            (a0, am, b0, bm, 0, slice(None)),
            (am, a1, bm, b1, 0, slice(None)),
            (a0, am, bm, b1, 1, slice(None)),
            (am, a1, b0, bm, 1, ~own),  # of a node with itself, the mirror of the one above
        ):
            part = [v[which] for v in (x0, x1, y0, y1)]
            part.append((cost + np.int8(step))[which])
            self_pair = part[0] == part[2]
            left, right = part[1] - part[0], part[3] - part[2]
            live = (part[4] <= budget) & (left > 0) & (right > 0) & ~(self_pair & (left < 2))
            children.append([v[live] for v in part])
        joined = [np.concatenate(column) for column in zip(*children)]
        if len(joined[0]):
            stack.append((level + 1, *joined))


def _middle(values: np.ndarray, first: np.ndarray, level: int) -> np.ndarray:
    """Where the members with bit ``level`` set begin, for nodes that start at ``first``."""
    shift = np.uint64(63 - level)
    one = ((values[first] >> shift) | np.uint64(1)) << shift
    return np.searchsorted(values, one)


def _compare(values, a0, a1, b0, b1, budget):
    """All pairs of small node pairs, compared directly; in batches of bounded size."""
    sizes = (a1 - a0) * (b1 - b0)
    for part in np.array_split(np.arange(len(a0)), max(1, int(sizes.sum()) >> 21)):
        if not len(part):
            continue
        n = sizes[part]
        row = np.repeat(part, n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[row]
        i, j = a0[row] + at // width, b0[row] + at % width
        once = (i < j) | (a0 != b0)[row]  # a node with itself holds each pair twice
        near = once & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        i, j = i[near], j[near]
        first, second = np.minimum(i, j), np.maximum(i, j)
        if len(first):
            yield first, second


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of linked members in place; a label is the smallest member known."""
    while True:
        li, lj = label[i], label[j]
        apart = li != lj
        if not apart.any():
            return
        i, j, li, lj = i[apart], j[apart], li[apart], lj[apart]
        small, large = np.minimum(li, lj), np.maximum(li, lj)
        np.minimum.at(label, large, small)
        while True:  # shorten chains until every label names a root
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def _star(values: np.ndarray, depth: int, budget: int, rotation: int) -> pd.DataFrame:
    """Links of the trie join as one star for each class: linear, however dense the class."""
    label = np.arange(len(values))
    for i, j in trie_pairs(values, depth, budget):
        _merge(label, i, j)
    linked = np.flatnonzero(label != np.arange(len(values)))
    back = _rotate(values, (64 - rotation) % 64).view(np.int64)
    return pd.DataFrame({"u": back[linked], "v": back[label[linked]]})


def links(prints: DataFrame, budget: int = 3, per_task: int = 50_000) -> DataFrame:
    """Spanning links ``u, v`` of the distinct fingerprints in column ``fp`` of ``prints``.

    Fingerprints that share a leading block go to one bucket; a bucket holds whole blocks, about
    ``per_task`` fingerprints. A block with more is dealt into chunks and each pair of chunks is
    a bucket of its own, so no task holds more than two chunks.
    """
    blocks = budget + 1
    width = 64 // blocks
    rotated = prints.select(
        "fp", F.explode(F.array(*[F.lit(b * width) for b in range(blocks)])).alias("turn")
    ).withColumn(
        "block",
        F.expr(f"shiftrightunsigned(shiftleft(fp, turn) | "
               f"case when turn = 0 then 0L else shiftrightunsigned(fp, 64 - turn) end, "
               f"{64 - width})"),
    )
    sizes = rotated.groupBy("turn", "block").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stage(sizes, "simhash-blocks")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // per_task), min(total // 64, 64))
    sized = rotated.join(sizes, ["turn", "block"]).withColumn(
        "chunks", F.ceil(F.col("n") / per_task)
    )
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    dealt = sized.withColumn("chunk", chunk).withColumn("other", other).select(
        "fp", "turn",
        F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("turn", "block"), F.lit(buckets)))
        .otherwise(-1).alias("bucket"),
        F.when(F.col("chunks") > 1, F.struct(
            "block", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b")
        )).alias("pair"),
    )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for turn, part in group.groupby("turn"):
            values = np.sort(_rotate(part["fp"].to_numpy().view(np.uint64), int(turn)))
            found.append(_star(values, width, budget, int(turn)))
        return pd.concat(found) if found else pd.DataFrame({"u": [], "v": []}, dtype="int64")

    return dealt.groupBy("bucket", "pair").applyInPandas(join, "u long, v long")


def near_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 3,
    budget: int = 3, seed: int = 42,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row: the smallest id reachable by links of
    at most ``budget`` differing bits. Texts are read once, into a staged table of fingerprints."""
    prints = stage(
        docs.select(F.col(id_column).alias("doc_id"),
                    fingerprints(F.col(text), shingle, seed).alias("fp")),
        "simhash",
    )
    return prints.join(classes(prints, budget), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def classes(prints: DataFrame, budget: int = 3) -> DataFrame:
    """``fp, component_id, root`` for every distinct fingerprint of ``prints(doc_id, fp)``; the root
    is a fingerprint that names the class, with or without an id."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = components(links(distinct.select("fp"), budget))
    rooted = distinct.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id", "root")


def keep_one(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 3,
    budget: int = 3, seed: int = 42,
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest id.

    Every row is judged by its own text, whatever its id: rows without an id come after all others, and
    among rows of one id the smallest row key (see ``rows.keyed``) decides. Of equal rows one stays.
    """
    found = stage(keyed(docs).select(
        "_key", F.col(f"_row.{id_column}").alias("doc_id"),
        fingerprints(F.col(f"_row.{text}"), shingle, seed).alias("fp")), "simhash")
    found = stage(found.join(classes(found, budget).select("fp", "root"), "fp"), "simhash-classes")
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("_first"))
    judged = found.join(first, "root")
    dropped = judged.where(F.col("_key") != F.col("_first")).select("_key").distinct()
    repeated = judged.where(F.col("_key") == F.col("_first")).groupBy("_key").count().where(
        "count > 1").select("_key")
    # staged, so that their sizes are known before the texts would be shuffled to meet them
    dropped, repeated = stage(dropped, "simhash-dropped"), stage(repeated, "simhash-repeated")
    return without(keyed(docs), dropped, repeated).select("_row.*")
