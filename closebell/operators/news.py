"""News cleaning, deterministic deduplication, and joins of news to returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.functions.text import article_key, clean, unicode_normalised

UNKNOWN = "UNKNOWN"  # fixed value: symbol of an article without one


def cleaned(news: DataFrame, null_as_text: bool = False) -> DataFrame:
    """Title, description and content in lower case without URLs, as ``*_clean``."""
    return news.select(
        "*",
        *[clean(F.col(c), null_as_text).alias(f"{c}_clean")
          for c in ("title", "description", "content")],
    )


def deduplicated(
    news: DataFrame,
    by_symbol: bool = False,
    keep: str = "first",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One article per (time, source, cleaned title): the first or latest by ``ingest_seq``.

    ``ingest_seq`` is unique. The symbol is not part of the key unless ``by_symbol``. First the
    survivors' numbers are found by a hash aggregation of (key, ``ingest_seq``), which combines
    copies before the shuffle; then their rows are fetched by number, so texts are neither sorted
    nor gathered by key. Only ``columns`` (default: all) are read and returned.
    """
    if keep not in ("first", "latest"):
        raise ValueError(f"keep must be 'first' or 'latest', not {keep!r}")
    pick = F.min if keep == "first" else F.max
    key = [article_key(F.col("ts"), F.col("source"), F.col("title")).alias("_key")]
    if by_symbol:
        key.append(F.col("symbol").alias("_symbol"))
    survivors = news.groupBy(*key).agg(pick("ingest_seq").alias("ingest_seq")).select("ingest_seq")
    columns = columns or news.columns
    rows = news.select(*dict.fromkeys(("ingest_seq", *columns)))
    return rows.join(survivors, "ingest_seq", "left_semi").select(*columns)


def normalised(
    news: DataFrame,
    by_symbol: bool = False,
    keep: str = "first",
    null_as_text: bool = False,
    unicode_form: str | None = None,
) -> DataFrame:
    """Raw articles to ``ts, symbol, source, title, text, url``.

    The text is cleaned after deduplication, so dropped copies are never cleaned.
    """
    columns = ("ts", "symbol", "source", "title", "url", "content")
    kept = deduplicated(news, by_symbol, keep, columns)
    text = F.col("content")
    if unicode_form:
        text = unicode_normalised(text, unicode_form)
    return kept.select(
        "ts", F.coalesce("symbol", F.lit(UNKNOWN)).alias("symbol"), "source", "title",
        clean(text, null_as_text).alias("text"), "url",
    )


def with_returns(news: DataFrame, r20: DataFrame) -> DataFrame:
    """Every article with the 20-bar return of its symbol on its day, if there is one.

    Returns are unique per (symbol, date). A symbol-day with very many articles lies on the
    left side, where adaptive execution splits oversized partitions of an outer join.
    """
    by_day = r20.select("date", "symbol", "r20")
    dated = news.withColumn("date", F.to_date("ts"))
    return dated.join(by_day, ["date", "symbol"], "left").select(
        "date", "symbol", "r20", "source", "title"
    )
