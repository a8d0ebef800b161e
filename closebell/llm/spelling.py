"""Grouping words that differ by one character, by sorted rotations (a permuterm index).

A word and a terminator, written in a circle, has one rotation per place. Two words that differ
in one character have rotations that agree in all but the last character; if one word has a
character more, a rotation of the longer agrees, but for its last character, with a whole rotation
of the shorter. So every rotation enters the sorted order by the prefix that skips the character to be
edited, and every whole rotation by itself; words that stand at one prefix are neighbours.

A prefix has at most one whole rotation, and one word for each character: a group is bounded by the
alphabet, whatever the words. Neighbours are counted and the best one is found from the first three of
a group in order, so no pair is written. Each pair of words meets at exactly one prefix: a character that
is cut from a run of equal ones is counted at the run's first place only.

A word's form is its most frequent neighbour, if that is at least ``ratio`` times as frequent. Counts
grow by that ratio from form to form, so chains are short (the binary digits of the largest count),
and following them by doubling takes few rounds.

Defined results: words are runs of ASCII and Latin-1 letters, ASCII in lower case; null texts have
none; a null id is written as the empty string. Each row is a document, repeated rows too. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebell.llm.words import parts
from closebell.session import stage

END = "$"  # in no word
HELD = 300_000  # counts a task holds before it passes them on

# Latin-1 bytes: letters stay, ASCII ones in lower case; the rest are spaces
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20
    for b in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """The letter runs of a text in Latin-1, a byte per character, in parts."""
    # a character outside Latin-1 becomes '?', which is no letter
    for part in parts(text.encode("latin-1", "replace").translate(_TO_WORDS)):
        yield part.split()


def misspelt(run: bytes, seed: int, every: int) -> bytes:
    """The run, without one character where the checksum of document and run says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(
    docs: DataFrame, min_length: int = 5, min_count: int = 3, every: int | None = None,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``word, n`` for every word of at least ``min_length`` characters and ``min_count`` occurrences.

    With ``every``, one in so many (document, run) is misspelt first (see ``misspelt``).
    """
    given = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def flush() -> pd.DataFrame:
            made = pd.DataFrame({
                "word": [w.decode("latin-1") for w in total], "n": list(total.values())})
            total.clear()
            return made

        for batch in batches:
            for doc, t in zip(batch["id"], batch["text"]):
                seed = zlib.crc32(f"{doc}:".encode())
                for found in runs(t):
                    for run, n in Counter(found).items():
                        if len(run) >= min_length:
                            word = misspelt(run, seed, every) if every else run
                            if len(word) >= min_length:
                                total[word] += n
                    if len(total) > HELD:
                        yield flush()
        if total:
            yield flush()

    found = given.mapInPandas(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, cut, word, n``: for each character of a word, the rotation that ends in it, up to
    it; and each whole rotation, whose ``cut`` is null."""
    t, size = F.concat("word", F.lit(END)), F.char_length("word")

    def turned(start, stop):
        return F.concat(F.substr(t, start + 1), F.substr(t, F.lit(1), stop))

    skipping = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(turned(i + 1, i).alias("prefix"), F.substr(t, i + 1, F.lit(1)).alias("cut")))
    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(turned(i, i).alias("prefix"), F.lit(None).cast("string").alias("cut")))
    return words.select("word", "n", F.explode(F.concat(skipping, whole)).alias("r")).select(
        "r.prefix", "r.cut", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n`` for every word that has neighbours: how many, and the most
    frequent (ties: the smallest)."""
    rows = rotations(words).repartitionByRange("prefix").select(
        "*", F.col("cut").isNull().alias("whole"),
        # cutting it makes the same word as cutting the character before
        (F.col("cut") == F.right("prefix", F.lit(1))).alias("repeats"))
    group = Window.partitionBy("prefix")
    in_order = group.orderBy(F.desc("n"), "word").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("n", "word", "whole", F.coalesce("repeats", F.lit(False)).alias("repeats"))
    scanned = rows.select(
        "word", "n", "whole", F.coalesce("repeats", F.lit(False)).alias("repeats"),
        *[F.nth_value(member, k).over(in_order).alias(f"m{k}") for k in (1, 2, 3)],
        F.count("*").over(in_order).alias("size"),
        F.max("whole").over(in_order).alias("has_whole"),
        F.max(F.coalesce("repeats", F.lit(False))).over(in_order).alias("has_repeat"),
    ).where("size > 1")

    def meets(m):
        return (m["word"] != F.col("word")) & ~(m["whole"] & F.col("repeats")) & ~(
            m["repeats"] & F.col("whole"))

    missed = (F.col("whole") & F.col("has_repeat")) | (F.col("repeats") & F.col("has_whole"))
    best = F.coalesce(*[F.when(meets(F.col(f"m{k}")), F.col(f"m{k}")) for k in (1, 2, 3)])
    met = scanned.select(
        "word", (F.col("size") - 1 - missed.cast("long")).alias("k"), best.alias("best"))
    near = met.where("k > 0").groupBy("word").agg(
        F.sum("k").alias("n_near"),
        F.min(F.struct((-F.col("best.n")).alias("less"), F.col("best.word").alias("word"))).alias("b"))
    return near.select(
        "word", "n_near", F.col("b.word").alias("near"), (-F.col("b.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last of the chain of forms, by doubling."""
    known = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stage(
            known.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved")),
            "spelling-roots")
        known = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return known


def variants(
    docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2,
    every: int | None = None, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word (see the module)."""
    words = stage(
        word_counts(docs, min_length, min_count, every, id_column, text), "spelling-words")
    is_form = F.col("near_n") >= ratio * F.col("n")
    judged = stage(
        words.join(neighbours(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n")),
        "spelling-forms")
    last = roots(judged.where(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
