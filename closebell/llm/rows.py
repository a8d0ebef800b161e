"""Rows told apart by their whole content, for tables whose ids are missing or repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.session import stage


def keyed(docs: DataFrame) -> DataFrame:
    """``_row``, the row as one column, so that no name of its columns can clash, and ``_key``.

    The key is a 128-bit hash of all columns, nulls told from values: rows share it only if they are
    equal (but for a chance of 2^-128 a pair). It is computed from the row alone, so it is the
    same in every pass over the table, on every executor.
    """
    texts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{f.name}`").cast("string")), F.lit("-"))
             if _plain(f) else F.coalesce(F.to_json(F.struct(f"`{f.name}`")), F.lit("-"))
             for f in docs.schema]
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.md5(F.concat_ws("\x00", *[F.md5(t) for t in texts])).alias("_key"))


def _plain(field) -> bool:
    return field.dataType.typeName() not in ("array", "map", "struct", "variant")


def without(rows: DataFrame, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` of ``keyed`` but for the keys in ``dropped(_key)``, and one of each in ``repeated(_key)``.

    Rows first meet the keys' 64-bit hashes, a list a quarter as long; only those that share one, few
    beside all rows, are compared by the key itself and moved.
    """
    short = F.xxhash64("_key").alias("_short")
    named = stage(dropped.unionByName(repeated).select(short).distinct(), "rows-named")
    hashed = rows.select("*", short)
    clear = hashed.join(named, "_short", "left_anti").select("_row", "_key")
    named_rows = hashed.join(named, "_short", "left_semi").select("_row", "_key")
    kept = once(named_rows.join(dropped, "_key", "left_anti"), repeated)
    return clear.unionByName(kept.select("_row", "_key"))


def once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` of ``keyed``, with one of each key in ``repeated(_key)``. Equal rows are combined
    before they are shuffled; all others stay where they are."""
    single = rows.join(repeated, "_key", "left_anti")
    several = rows.join(repeated, "_key", "left_semi")
    return single.unionByName(several.groupBy("_key").agg(
        F.any_value("_row").alias("_row")).select("_row", "_key"), allowMissingColumns=False)
