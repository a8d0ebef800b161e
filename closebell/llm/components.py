"""Connected components of a link table by alternating star contraction.

Every step is a grouped minimum (combined before the shuffle) and a join on the vertex. The
links are staged after each round, so lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.session import stage


def _fingerprint(links: DataFrame):
    return links.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger vertex ``u`` to smaller ones: all go to the smallest."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return least.select("u", F.col("m").alias("v")).unionByName(moved)


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``links(u, v)`` but the roots themselves.

    ``root`` is the smallest vertex of the component in the order of the vertex type. Links to
    itself and repeated links count as none; an empty table gives an empty result.
    """
    links = links.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    links = stage(links, "links")
    before = _fingerprint(links)
    while before.n:
        links = stage(_small_star(_large_star(links)).distinct(), "links")
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
