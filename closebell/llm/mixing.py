"""Mixing sources to target weights by hierarchical token budgets.

Documents hang on the leaves of a tree (domain, language, source by default). A token budget
enters at the root and is split at every node among its children in proportion to their
weights; a child cannot take more than its subtree holds (its tokens times ``max_epochs``), and
what it cannot take goes to its siblings in the same proportion. Because a node's own limit is the
sum of its children's, a shortage leaves a family for the ancestors only when all siblings are full.

A leaf takes its share as a prefix of its documents in a seeded order: one order per epoch, the
epochs one after the other; the document at the end is taken in part.

Budgets are whole tokens (rounded down at each node). Defined results: null and empty texts
have no tokens and are never taken; null keys count as the key ``''``; children without a
stated weight have weight 1, weights of 0 take nothing; ties in the seeded order (repeated rows) are
in the order of the id, then the text's hash; exact copies of a row are interchangeable. An empty
table or a budget of 0 gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebell.llm.rows import keyed, once
from closebell.session import stage

SPACES = "[ \\t-\\r]+"
DOCUMENTS_PER_SLICE = 2_000  # expected; a leaf's order is cut into slices of its key


def word_count(text: Column) -> Column:
    """Runs of anything but the six ASCII spaces."""
    trimmed = F.regexp_replace(text, "^[ \\t-\\r]+|[ \\t-\\r]+$", "")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(
        F.size(F.split(trimmed, SPACES))
    ).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    stated = weights.get(level, {})
    if not stated:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for pair in stated.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(level)).cast("double"), F.lit(1.0))


def fill(children: DataFrame, parent: Sequence[str], budget: str = "budget") -> DataFrame:
    """Adds ``share``: each child's part of its parent's ``budget``.

    Columns ``weight`` and ``room`` (a limit in tokens). Children are filled in the order of
    room per weight: those that fall short get their room, and the rest of the budget goes to
    the others in proportion. Windows run over the tree's nodes, not over documents.
    """
    ratio = F.when(F.col("weight") > 0, F.col("room") / F.col("weight"))
    in_order = Window.partitionBy(*parent).orderBy(F.col("_ratio").asc_nulls_last(), "_node")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = in_order.rowsBetween(0, Window.unboundedFollowing)
    ranked = children.withColumns({"_ratio": ratio}).withColumns({
        "_taken": F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("room"))).over(before),
                             F.lit(0)),
        "_weights": F.sum("weight").over(from_here),
    })
    # the budget per weight if all from here on were to share what the ones before leave
    level = (F.col(budget) - F.col("_taken")) / F.col("_weights")
    ranked = ranked.withColumn(
        "_full", F.coalesce(F.col("_ratio") <= level, F.lit(False))
    )
    full = F.sum(F.when(F.col("_full"), F.col("room")).otherwise(0)).over(
        Window.partitionBy(*parent))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0.0)).over(
        Window.partitionBy(*parent))
    ranked = ranked.withColumns({"_fixed": full, "_open": open_weight})
    share = F.when(F.col("weight") <= 0, F.lit(0).cast("long")).when(
        F.col("_full"), F.col("room")
    ).otherwise(F.floor((F.col(budget) - F.col("_fixed")) * F.col("weight") / F.col("_open")))
    return ranked.withColumn("share", share.cast("long")).drop(
        "_ratio", "_taken", "_weights", "_full", "_fixed", "_open"
    )


def budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    total: int,
    max_epochs: int,
) -> DataFrame:
    """``levels, budget`` per leaf. ``leaves`` has one row per leaf with its ``tokens``."""
    shares = None
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[:depth - 1])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("room"))
        nodes = nodes.withColumns({
            "weight": _weight(levels[depth - 1], weights),
            "_node": F.col(levels[depth - 1]),
        })
        if shares is None:
            nodes = nodes.withColumns({"budget": F.lit(total).cast("long"), "_root": F.lit(0)})
            parent = ["_root"]
        else:
            nodes = nodes.join(shares, parent)
        shares = fill(nodes, parent).select(*path, F.col("share").alias("budget"))
    return shares


def plan(
    docs: DataFrame,
    levels: Sequence[str] = ("domain", "lang", "source"),
    weights: Mapping[str, Mapping[str, float]] | None = None,
    total: int | None = None,
    fraction: float = 0.5,
    max_epochs: int = 2,
    seed: int = 7,
    id_column: str = "doc_id",
    tokens: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, *levels, tokens, epoch, taken`` for every document an epoch takes.

    ``carry`` names further columns that go with a row; rows without an id are then ordered by these.

    ``total`` is the budget in tokens; without it, ``fraction`` of all tokens. ``tokens`` is the
    size of a document (words of ``text`` by default). Texts are read once; what follows works on
    ids and sizes. A leaf may hold any part of the rows: its order is cut into slices by the seeded
    key, sums per slice are combined before they are shuffled, and a task orders one slice.
    """
    tokens = word_count(F.col("text")) if tokens is None else tokens
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels]
    sized = docs.select(
        F.col(id_column).alias("doc_id"), *keys, tokens.cast("long").alias("tokens"), *carry,
    ).where("tokens > 0")
    sized = stage(sized, "mixing-sizes")
    leaves = stage(
        sized.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")),
        "mixing-leaves",
    )
    if total is None:
        total = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * fraction)
    given = budgets(leaves, levels, weights or {}, total, max_epochs).where("budget > 0")
    given = given.join(leaves.withColumnRenamed("tokens", "held"), list(levels))
    given = given.withColumn("slices", F.ceil(F.col("docs") / DOCUMENTS_PER_SLICE).cast("long"))
    given = stage(given, "mixing-budgets")

    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")
    dealt = sized.join(given, list(levels)).select(sized["*"], "budget", "held", "slices", epochs)
    # whole epochs before the last one need no order
    dealt = dealt.where(F.col("epoch") * F.col("held") < F.col("budget"))
    name = F.coalesce(F.col("doc_id").cast("string"), *map(F.col, carry))
    key = F.substring(F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.col("epoch").cast("string"), name)), 1, 15)
    dealt = dealt.withColumn("key", F.conv(key, 16, 10).cast("long"))
    # 15 hex digits: a slice is a range of keys
    dealt = dealt.withColumn("slice", F.expr("key div (1152921504606846976 div slices + 1)"))
    place = [*levels, "epoch"]
    sums = dealt.groupBy(*place, "slice").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy(*place).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    inside = Window.partitionBy(*place, "slice").orderBy("key", "doc_id", "tokens", *carry).rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("epoch") * F.col("held") + F.col("_before") + F.coalesce(
        F.sum("tokens").over(inside), F.lit(0))
    placed = dealt.join(sums, [*place, "slice"]).withColumn("_start", start)
    return placed.withColumn(
        "taken", F.least("tokens", F.col("budget") - F.col("_start"))
    ).where("taken > 0").select("doc_id", *levels, "tokens", "epoch", "taken", *carry)


def source_domain(source: Column, domains: int = 4) -> Column:
    """A domain for tables without one: the digits at the end of the source name, modulo."""
    digits = F.regexp_extract(F.coalesce(source.cast("string"), F.lit("")), "([0-9]{1,9})$", 1)
    number = F.when(digits == "", F.lit(0)).otherwise(digits.cast("long"))
    return F.concat(F.lit("domain"), F.pmod(number, F.lit(domains)).cast("string"))


def prefix(text: Column, words: Column) -> Column:
    """The text up to and with its ``words``-th word."""
    leading = F.when(text.rlike("^[ \\t-\\r]"), 1).otherwise(0)
    parts = F.split(text, SPACES, (words + 1 + leading).cast("int"))
    rest = F.char_length(F.element_at(parts, -1))
    head = F.substring(text, F.lit(1), F.char_length(text) - rest)
    return F.regexp_replace(head, "[ \\t-\\r]+$", "")


def sample(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    levels: Sequence[str] = ("domain", "lang", "source"), **settings,
) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` plus ``epoch`` and ``taken`` (replaced if they
    exist), with the text of a document taken in part cut to its first ``taken`` words.

    Rows are told apart by their whole content, not by the id: rows without one, or that share one, are
    each taken for what they are, and equal rows as often as there are of them.
    """
    rows = keyed(docs)
    parts = [F.col(f"_row.`{c}`").alias(c) for c in dict.fromkeys((id_column, *levels))]
    sized = stage(rows.select(
        "_key", *parts, word_count(F.col(f"_row.`{text}`")).alias("_tokens")), "mixing-rows")
    taken = plan(sized, levels, id_column=id_column, tokens=F.col("_tokens"), carry=("_key",), **settings)
    repeated = stage(
        sized.groupBy("_key").count().where("count > 1").select("_key"), "mixing-repeated")
    chosen = taken.select(
        "_key", *[F.col(c).alias(f"_{c}") for c in ("epoch", "taken", "tokens")])
    joined = once(rows, repeated).join(chosen, "_key")
    row = lambda c: F.col(f"_row.`{c}`")
    cut = F.when(F.col("_taken") < F.col("_tokens"), prefix(row(text), F.col("_taken")))
    return joined.select(
        *[F.coalesce(cut, row(c)).alias(c) if c == text else row(c).alias(c)
          for c in docs.columns if c not in ("epoch", "taken")],
        F.col("_epoch").alias("epoch"), F.col("_taken").alias("taken"),
    )
