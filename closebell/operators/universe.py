"""Which symbols are traded: liquidity ranking, allowlist and headline-to-symbol mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dollar_volume(bars: DataFrame) -> DataFrame:
    """Average daily dollar volume per symbol as ``adv``."""
    return bars.groupBy("symbol").agg(F.avg(F.col("close") * F.col("volume")).alias("adv"))


def top_by_dollar_volume(bars: DataFrame, n: int = 300) -> DataFrame:
    """The ``n`` most traded symbols; ties go to the smaller symbol."""
    return dollar_volume(bars).orderBy(F.desc("adv"), "symbol").limit(n)


def by_month(bars: DataFrame, n: int = 300, months: int = 3) -> DataFrame:
    """``month, symbol, adv, rank``: the ``n`` most traded symbols for each month, by average daily
    dollar volume of the ``months`` calendar months before it. Ties go to the smaller symbol.

    No ranking sees its own month or a later one. Months without a bar of any symbol have no
    universe; a symbol without a bar in the months before is not in it. Volumes are summed by (symbol,
    month) before anything is ordered, and of a month's symbols only the first ``n`` of each task
    are shuffled to be ranked.
    """
    month = F.trunc("date", "month")
    volume = F.col("close") * F.col("volume")
    sums = bars.where(F.col("symbol").isNotNull() & F.col("date").isNotNull()).groupBy(
        "symbol", month.alias("month")).agg(F.sum(volume).alias("sum"), F.count(volume).alias("bars"))
    # a month's volume counts for each of the months after it
    later = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_later")
    passed_on = sums.select("symbol", "sum", "bars", "month", later).select(
        "symbol", "sum", "bars", F.add_months("month", F.col("_later")).alias("month"))
    adv = passed_on.groupBy("month", "symbol").agg(
        F.try_divide(F.sum("sum"), F.sum("bars")).alias("adv")).where(F.col("adv").isNotNull())
    traded = sums.select("month").distinct()  # one row per calendar month
    best = Window.partitionBy("month").orderBy(F.desc("adv"), "symbol")
    ranked = adv.join(traded, "month", "left_semi").withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= n).select("month", "symbol", "adv", "rank")


def restrict_by_month(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows whose symbol is in the universe of their date's month (see ``by_month``)."""
    members = universe.select("symbol", F.col("month").alias("_month"))
    rows = df.withColumn("_month", F.trunc("date", "month"))
    return rows.join(members, ["symbol", "_month"], "left_semi").select(*df.columns)


def restrict(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows whose symbol is in ``universe``; Spark broadcasts it when its size allows."""
    return df.join(universe.select("symbol").distinct(), "symbol", "left_semi").select(*df.columns)


def _words(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    found = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " ")
    return F.filter(found, lambda w: w != "")


def anchors(names: DataFrame, titles: DataFrame) -> DataFrame:
    """``names`` with ``_word, _at_word``: each alias's word that fewest title words equal (ties: its
    first), and the place of it. Aliases with a word that no title has are left out.

    ``names`` has ``_alias`` and ``titles`` ``_title``, both arrays of words. Only words of
    aliases are counted, and counts are combined before they are shuffled.
    """
    parts = names.select("*", F.posexplode("_alias").alias("_at_word", "_word"))
    said = titles.select(F.explode("_title").alias("_word"))
    counts = said.join(parts.select("_word").distinct(), "_word", "left_semi").groupBy("_word").agg(
        F.count("*").alias("_said"))
    rated = parts.join(counts, "_word", "left").withColumn("_said", F.coalesce("_said", F.lit(0)))
    rarest = rated.groupBy("_alias", "_to").agg(
        F.min(F.struct("_said", "_at_word", "_word")).alias("_r"))
    return rarest.where("_r._said > 0").select("_alias", "_to", "_r._word", "_r._at_word")


def map_to_symbols(news: DataFrame, aliases: DataFrame) -> DataFrame:
    """Give articles without a symbol one from an (alias, symbol) table.

    An alias of one or more words matches where its words follow each other in the title, in
    any case and with anything but letters and digits between them. The match that comes first wins,
    of several there the longest, then the smaller symbol. Articles keep a symbol they already
    have, and are returned unchanged when nothing matches.

    Titles meet the aliases by an alias's rarest word (see ``anchors``); the others are compared in
    place, so the number of words an alias may have is unlimited, and a common word gathers its
    titles only if an alias consists of common words.
    """
    names = aliases.select(_words("alias").alias("_alias"), F.col("symbol").alias("_to"))
    names = names.where(F.size("_alias") > 0).groupBy("_alias").agg(F.min("_to").alias("_to"))
    untagged = news.where(F.col("symbol").isNull())
    titles = untagged.select("ingest_seq", _words("title").alias("_title"))
    terms = titles.select("ingest_seq", "_title", F.posexplode("_title").alias("_place", "_word"))
    met = terms.join(anchors(names, titles), "_word").withColumn(
        "_at", F.col("_place") - F.col("_at_word"))
    run = F.slice("_title", F.greatest(F.col("_at"), F.lit(0)) + 1, F.size("_alias"))
    rank = F.struct("_at", -F.size("_alias"), "_to")
    hits = met.where((F.col("_at") >= 0) & (run == F.col("_alias"))).groupBy("ingest_seq").agg(
        F.min_by("_to", rank).alias("_to")
    )
    mapped = untagged.drop("symbol").join(hits, "ingest_seq", "left")
    return news.where(F.col("symbol").isNotNull()).unionByName(
        mapped.withColumnRenamed("_to", "symbol").select(*news.columns)
    )
