"""Data contracts as aggregates: nulls, keys, ranges, causality, freshness, checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from closebell.schemas import schema_drift


class ContractError(RuntimeError):
    """A dataset breaks its contract."""


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, nulls, rows``: all columns counted in one pass."""
    columns = columns or df.columns
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    each = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
          for i, c in enumerate(columns)]
    )
    return counts.select(F.explode(each).alias("c"), "rows").select("c.column", "c.nulls", "rows")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of ``rows``."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def causality_violations(
    decisions: DataFrame, decision_ts: str = "date", feature_ts: str = "fact_date"
) -> DataFrame:
    """One row: how many rows there are and how many use data from after the decision."""
    return decisions.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(feature_ts) > F.col(decision_ts)).alias("violations"),
    )


def out_of_range(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """``column, violations`` for values outside [low, high]; nulls do not count."""
    def outside(column: str) -> Column:
        low, high = bounds[column]
        return ~F.col(column).between(low, high)

    counts = df.agg(*[F.count_if(outside(c)).alias(f"n{i}") for i, c in enumerate(bounds)])
    each = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("violations"))
          for i, c in enumerate(bounds)]
    )
    return counts.select(F.explode(each).alias("c")).select("c.*")


SENTIMENT_BOUNDS = {"news_sent": (-1.0, 1.0), "news_conf": (0.0, 1.0)}


def freshness(df: DataFrame, today: str, max_age_days: int, column: str = "date") -> DataFrame:
    """One row: latest date, its age on ``today``, and whether that keeps the promise."""
    latest = df.agg(F.max(F.to_date(column)).alias("latest"))
    age = F.date_diff(F.lit(today).cast("date"), F.col("latest"))
    return latest.select(
        "latest", age.alias("age_days"),
        F.coalesce(age <= max_age_days, F.lit(False)).alias("fresh"),
    )


def portable_hash(*columns: Column) -> Column:
    """A row's hash that other engines can compute: the first 15 hex digits of the MD5 of its values
    as text, joined by ``|``; nulls are left out."""
    text = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("long")


def checksums(
    df: DataFrame, partitions: Sequence[str], row_hash: Column | None = None
) -> DataFrame:
    """Row count and order-free checksum per partition. The count is needed as well: in an
    exclusive or, two equal rows cancel out."""
    hashed = F.xxhash64(*[c for c in df.columns if c not in partitions]) if row_hash is None else row_hash
    return df.groupBy(*partitions).agg(
        F.count("*").alias("rows"), F.bit_xor(hashed).alias("checksum")
    )


def updated_checksums(
    df: DataFrame, recorded: DataFrame, touched: DataFrame, column: str = "date",
    row_hash: Column | None = None,
) -> DataFrame:
    """``recorded`` with new checksums for the ``touched`` values of one partition ``column``.

    The touched values (days: a bounded number) become literals of a filter, so the scan of a table
    with a folder per value opens no other folder. Values that have no rows any more are left out.
    """
    values = [r[0] for r in touched.select(column).where(F.col(column).isNotNull()).distinct().collect()]
    fresh = checksums(df.where(F.col(column).isin(*values)), [column], row_hash)
    kept = recorded.where(~F.col(column).isin(*values)) if values else recorded
    return kept.select(*fresh.columns).unionByName(fresh) if values else kept


def changed_partitions(
    df: DataFrame, recorded: DataFrame, partitions: Sequence[str]
) -> DataFrame:
    """Partitions whose rows are not those the ``recorded`` checksums were taken of."""
    now = checksums(df, partitions)
    return now.join(recorded, [*partitions, "rows", "checksum"], "left_anti").unionByName(
        recorded.select(*now.columns).join(now, list(partitions), "left_anti")
    )


def require(df: DataFrame, schema: StructType, keys: Sequence[str] = ()) -> None:
    """Raise ``ContractError`` on schema drift, null keys or duplicate keys."""
    drift = schema_drift(df, schema)
    if drift:
        raise ContractError("; ".join(drift))
    if keys:
        missing = [r["column"] for r in null_counts(df, keys).where("nulls > 0").collect()]
        if missing:
            raise ContractError(f"null keys in {', '.join(missing)}")
        if duplicate_keys(df, keys).limit(1).count():
            raise ContractError(f"duplicate keys ({', '.join(keys)})")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """The frame, and an observation whose ``get["rows"]`` holds the row count once an
    action has run over it; no second pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
