"""How far the sources of a language differ in their words, from count-level bitmaps.

Every (language, source) group counts the terms that at least ``min_docs`` documents of the language
have. A group's terms are kept as bitsets, one for each count that occurs (a level): bit i of a
level is set if term i has that count. For two groups, AND and popcount of two levels give the number
of terms with that pair of counts (a joint cell); the divergence is a sum over cells of the cell times
``f`` of its two smoothed shares, so no term is looked at by itself. A count of zero has no bitset:
its cells are what the level sizes and the number of terms leave over.

With J the joint cells of counts above zero, a and b the level sizes of both groups, V the terms, and
0 standing for a count of zero, the cells with a zero follow by complement, and

    sum = J * (f(p, q) - f(p, 0) - f(0, q) + f(0, 0))      over pairs of levels
        + a * f(p, 0) + b * f(0, q)                        over single levels
        + (V - terms of either group) * f(0, 0)

Where the work is: texts are read once, by tasks that pre-aggregate counts; what is shuffled has a row
per (language, source, term) and task. Term ids are places in buckets of about ``BUCKET`` terms of
alike total counts, so that a word of 64 ids has few levels; a task meets the levels of one bucket.
Sources beyond ``TILE`` are dealt into tiles and tasks meet two tiles, so a group is bounded however
many sources a language has. The output has a row for each ordered pair of sources, as it is asked for.

Arithmetic is exact: shares are whole numbers of at most 10^9 + 1, so a cell's f is below 2^63, and so
is the sum over a bucket (its shares add up to about 10^9); sums over buckets are decimals.

Defined results: null text, language and source are ``''``. Each row is a document, repeated rows
too. Groups without terms take part; if a language keeps no term, its pairs have the value 0. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebell.llm.words import parts
from closebell.session import stage

BUCKET = 1_024  # expected terms in a bucket of ids
TILE = 64  # expected sources in a tile
HELD = 300_000  # counts a task holds before it passes them on
CELLS = 1 << 20  # cells met at once in a task

_KEPT = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
# ASCII letters in lower case and all bytes of other characters stay, the rest are spaces
_TO_TERMS = bytes(ord(chr(b).lower()) if b < 0x80 and b in _KEPT else b if b in _KEPT else 0x20
                  for b in range(256))

_GROUP_COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, as UTF-8, in parts."""
    for part in parts(text.encode().translate(_TO_TERMS)):
        yield part.split()


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> pd.DataFrame:
        rows = []
        for (lang, source), (n, docs) in groups.items():
            rows.append((lang, source, None, 0, 0))  # the group, even without terms
            rows.extend((lang, source, t.decode(), c, docs[t]) for t, c in n.items())
        groups.clear()
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for found in terms(text):
                n.update(found)
                seen.update(found)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield flush()
                held = 0
    if groups:
        yield flush()


def group_counts(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    min_docs: int = 3,
) -> DataFrame:
    """``lang, source, term, n, lang_n, lead`` for every kept term of a group, and a row with a null
    term for every group. ``lead`` is true in one row of each term of a language."""
    texts = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang, "lang"), (source, "source"), (text, "text"))
    ])
    found = texts.mapInPandas(_count, _GROUP_COUNTS)
    # one shuffle serves the counts by group and the sums by language
    counted = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    summed = counted.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("lang_docs"),
        (F.col("source") == F.min("source").over(of_term)).alias("lead"),
    )
    return summed.where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("lang_docs")


def group_totals(counts: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, kept`` of every group: its occurrences of kept terms, those
    of its language, and the number of kept terms."""
    is_term = F.col("term").isNotNull()
    groups = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(is_term & F.col("lead")).alias("_leads"),
        F.count_if(is_term).alias("held"))
    of_lang = Window.partitionBy("lang")
    return groups.select(
        "lang", "source", "total", "held", F.sum("total").over(of_lang).alias("lang_total"),
        F.sum("_leads").over(of_lang).alias("kept"))


def share(n: str, total: str, kept: str = "kept") -> Column:
    """The smoothed share of a count, in billionths."""
    return F.expr(
        f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 1 as decimal(20,0)))"
        f" div nullif({total} + {kept}, 0)")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def top_terms(counts: DataFrame, totals: DataFrame, most: int = 200) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group has more of than its language."""
    rows = counts.where(F.col("term").isNotNull()).join(totals, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q"),
    ).where("p > q").select("lang", "source", "item", gap("p", "q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def level_bitmaps(counts: DataFrame) -> DataFrame:
    """``lang, tier, bucket, word, source, n, bits``: the bitsets of every (group, count), in words of
    64 term ids. A tier has the terms whose totals have the same number of binary digits."""
    rows = counts.where(F.col("term").isNotNull()).withColumn(
        "tier", F.floor(F.log2("lang_n")).cast("int"))
    slices = rows.where("lead").groupBy("lang", "tier").agg(
        F.ceil(F.count("*") / BUCKET).alias("slices"))
    rows = rows.join(slices, ["lang", "tier"]).withColumn(
        "bucket", F.pmod(F.xxhash64("term"), F.col("slices")))
    place = Window.partitionBy("lang", "tier", "bucket").orderBy("term")
    rows = rows.withColumn("id", F.dense_rank().over(place) - 1)
    return rows.groupBy(
        "lang", "tier", "bucket", F.expr("id div 64").alias("word"), "source", "n"
    ).agg(F.bit_or(F.expr("shiftleft(1L, cast(id % 64 as int))")).alias("bits"))


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _joint(rows: pd.DataFrame) -> pd.DataFrame:
    """The joint cells of one bucket and pair of tiles, times their f, summed by pair of sources."""
    codes, names = pd.factorize(rows["source"])
    rows = rows.assign(code=codes).sort_values("word", kind="stable")
    total = np.zeros((len(names), len(names)), np.int64)
    met = np.zeros((len(names), len(names)), bool)
    for _, word in rows.groupby("word", sort=False):
        left, right = ({
            c: word.loc[word[side], c].to_numpy() for c in ("code", "p", "p0", "bits")
        } for side in ("left", "right"))
        bits = right["bits"].view(np.uint64)
        step = max(1, CELLS // max(1, len(bits)))
        for at in range(0, len(left["bits"]), step):
            part = {c: v[at:at + step] for c, v in left.items()}
            cells = np.bitwise_count(part["bits"].view(np.uint64)[:, None] & bits[None, :])
            i, j = np.nonzero(cells)
            terms = cells[i, j].astype(np.int64)
            p, p0, q, q0 = part["p"][i], part["p0"][i], right["p"][j], right["p0"][j]
            value = terms * (_gap(p, q) - _gap(p, q0) - _gap(p0, q) + _gap(p0, q0))
            pair = part["code"][i], right["code"][j]
            np.add.at(total, pair, value)
            met[pair] = True
    np.fill_diagonal(met, False)
    i, j = np.nonzero(met)
    return pd.DataFrame({
        "lang": rows["lang"].iloc[0], "source": names[i], "item": names[j], "value": total[i, j]})


def _tiles(totals: DataFrame) -> DataFrame:
    """``lang, tiles``: how many tiles a language's sources are dealt into."""
    return totals.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))


def pair_values(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of a language's sources."""
    shares = totals.select(
        "lang", "source", "kept", "total", "held", F.expr("0L").alias("_none"),
    ).withColumn("p0", share("_none", "total")).drop("_none")
    levels = stage(
        level_bitmaps(counts).join(shares.drop("held"), ["lang", "source"]).select(
            "lang", "tier", "bucket", "word", "source", "n", "bits", "p0",
            share("n", "total").alias("p")),
        "divergence-levels")

    exact = "decimal(38,0)"
    other = shares.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"),
                          F.col("held").alias("q_held"))
    # neither group has the term: what all cells with a term of either leave over
    none = shares.join(other, "lang").where("source <> item").select(
        "lang", "source", "item",
        (F.expr("kept - held - q_held").cast(exact) * F.coalesce(gap("p0", "q0"), F.lit(0)))
        .cast(exact).alias("value"))
    # one group has it: level sizes against the other's share of a missing term, both ways round
    sizes = levels.groupBy("lang", "source", "n", "p").agg(
        F.sum(F.bit_count("bits").cast("long")).alias("size"))
    one = sizes.join(other.drop("q_held"), "lang").where("source <> item").select(
        "lang", F.explode(F.array(
            F.struct(F.col("source").alias("of"), F.col("item").alias("to"), gap("p", "q0").alias("f")),
            F.struct(F.col("item").alias("of"), F.col("source").alias("to"), gap("q0", "p").alias("f")),
        )).alias("c"), "size",
    ).select("lang", F.col("c.of").alias("source"), F.col("c.to").alias("item"),
             (F.col("size").cast(exact) * F.col("c.f")).cast(exact).alias("value"))
    # both have it
    tiled = levels.join(_tiles(totals), "lang").withColumn(
        "tile", F.pmod(F.hash("source"), F.col("tiles")))
    all_tiles = F.sequence(F.lit(0), F.col("tiles") - 1)
    own = F.col("tile")
    dealt = tiled.select(
        "lang", "tier", "bucket", "word", "source", "p", "p0", "bits",
        F.explode(F.concat(
            F.transform(all_tiles, lambda t: F.struct(
                own.alias("a"), t.alias("b"), F.lit(True).alias("left"), (own == t).alias("right"))),
            F.filter(F.transform(all_tiles, lambda t: F.struct(
                t.alias("a"), own.alias("b"), F.lit(False).alias("left"), F.lit(True).alias("right"))),
                lambda s: s["a"] != s["b"]),
        )).alias("t"),
    ).select("*", "t.*").drop("t")
    both = dealt.groupBy("lang", "tier", "bucket", "a", "b").applyInPandas(
        _joint, "lang string, source string, item string, value long")
    parts_ = none.unionByName(one).unionByName(
        both.withColumn("value", F.col("value").cast(exact)))
    return parts_.groupBy("lang", "source", "item").agg(
        F.sum("value").cast("long").alias("value"))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    min_docs: int = 3, top: int = 200,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language and the divergence from it. Part ``term``: the
    ``top`` terms by which the source stands out from its language. Ranks start at 1, values
    descending, then items in the order of their UTF-8 bytes.
    """
    counts = stage(group_counts(docs, lang, source, text, min_docs), "divergence-counts")
    totals = stage(group_totals(counts), "divergence-totals")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(counts, totals).withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        top_terms(counts, totals, top).withColumn("part", F.lit("term")).select(*columns))
