"""Headline scoring with a pluggable model, and daily sentiment."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from closebell.functions.numbers import sentiment_scores

LABELS = ("negative", "neutral", "positive")
BATCH = 32  # fixed value: titles per model call


class Scorer(Protocol):
    """A loaded model: titles in, one row of logits per title out."""

    def __call__(self, titles: Sequence[str]) -> Sequence[Sequence[float]]: ...


_MODELS: dict[str, Scorer] = {}


def _loaded(name: str, load: Callable[[], Scorer]) -> Scorer:
    """The model of a loader, loaded once in each worker process, however many tasks it runs."""
    if name not in _MODELS:
        _MODELS[name] = load()
    return _MODELS[name]


def score_news(
    news: DataFrame,
    load: Callable[[], Scorer],
    labels: Sequence[str] = LABELS,
    batch: int = BATCH,
    keep: Sequence[str] = ("ts", "symbol"),
    tasks: int | None = None,
) -> DataFrame:
    """``keep`` columns plus ``news_sent`` and ``news_conf``, one row per headline.

    ``load`` runs once per worker process and returns the model. Only the kept columns and the
    title are sent to Python. ``labels`` gives the model's output order; a row of logits of
    another length fails the job. Partitions are cut by
    bytes, which says little about a slow model: ``tasks`` spreads the headlines evenly.
    """
    sent = news.select(*keep, "title")
    if tasks is not None:
        sent = sent.repartition(tasks)
    schema = StructType(
        [sent.schema[c] for c in keep] + [StructField("logits", ArrayType(DoubleType()))]
    )

    name, width = hashlib.sha256(cloudpickle.dumps(load)).hexdigest(), len(labels)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _loaded(name, load)
        for frame in frames:
            titles = frame["title"].fillna("").tolist()
            logits = [
                [float(x) for x in row]
                for i in range(0, len(titles), batch)
                for row in model(titles[i : i + batch])
            ]
            if len(logits) != len(titles) or any(len(row) != width for row in logits):
                raise ValueError(f"the model must return {width} logits for every title")
            out = frame[list(keep)].copy()
            out["logits"] = pd.Series(logits, index=out.index, dtype=object)
            yield out

    return scored(sent.mapInPandas(run, schema), labels)


def title_key(title: Column) -> Column:
    """What a title's stored scores are found by; null titles read as empty ones."""
    return F.sha2(F.coalesce(title, F.lit("")), 256)


def unscored(news: DataFrame, stored: DataFrame, model: str) -> DataFrame:
    """``title_key, title``: every different title without a stored score of the model, once."""
    titles = news.select(F.coalesce("title", F.lit("")).alias("title")).select(
        title_key(F.col("title")).alias("title_key"), "title")
    different = titles.groupBy("title_key").agg(F.any_value("title").alias("title"))
    known = stored.where(F.col("model") == model).select("title_key")
    return different.join(known, "title_key", "left_anti")


def score_titles(
    news: DataFrame, stored: DataFrame, load: Callable[[], Scorer], model: str, **options
) -> DataFrame:
    """``model, title_key, news_sent, news_conf`` of the titles without a stored score.

    ``model`` names the weights: another name scores everything anew. Titles are scored once
    however many articles have them. ``options`` as for ``score_news``.
    """
    found = score_news(unscored(news, stored, model), load, keep=("title_key",), **options)
    return found.select(F.lit(model).alias("model"), "title_key", "news_sent", "news_conf")


def with_scores(
    news: DataFrame, stored: DataFrame, model: str, keep: Sequence[str] = ("ts", "symbol")
) -> DataFrame:
    """``keep`` columns plus ``news_sent`` and ``news_conf`` from stored scores, null where there
    are none; no model is called."""
    scores = stored.where(F.col("model") == model).select("title_key", "news_sent", "news_conf")
    keyed = news.select(*keep, title_key(F.col("title")).alias("title_key"))
    return keyed.join(scores, "title_key", "left").drop("title_key")


def scored(news: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Replace a ``logits`` array by ``news_sent`` in [-1, 1] and ``news_conf`` in [0, 1]."""
    sent, conf = sentiment_scores(F.col("logits"), labels)
    return news.select("*", sent.alias("news_sent"), conf.alias("news_conf")).drop("logits")


def daily(scores: DataFrame) -> DataFrame:
    """Mean sentiment and confidence and number of headlines per (date, symbol)."""
    return scores.groupBy(F.to_date("ts").alias("date"), "symbol").agg(
        F.avg("news_sent").alias("news_sent"),
        F.avg("news_conf").alias("news_conf"),
        F.count("*").alias("headlines"),
    )


def two_day(scores: DataFrame) -> DataFrame:
    """Mean over the headlines of a day and the calendar day before.

    Daily sums are formed first, then each is counted on its own day and the next, so the
    headlines themselves are not duplicated.
    """
    sums = scores.groupBy(F.to_date("ts").alias("day"), "symbol").agg(
        F.sum("news_sent").alias("s"), F.count("news_sent").alias("ns"),
        F.sum("news_conf").alias("c"), F.count("news_conf").alias("nc"),
        F.count("*").alias("n"),
    )
    spread = sums.select("*", F.explode(F.array("day", F.date_add("day", 1))).alias("date"))
    return spread.groupBy("date", "symbol").agg(
        F.try_divide(F.sum("s"), F.sum("ns")).alias("news_sent"),
        F.try_divide(F.sum("c"), F.sum("nc")).alias("news_conf"),
        F.sum("n").alias("headlines"),
    )


def zscored(features: DataFrame) -> DataFrame:
    """``news_sent`` as z-score across the symbols of a day; null without spread.

    Day statistics are aggregated and joined back, so no task has to hold all symbols of a day.
    """
    stats = features.groupBy("date").agg(
        F.avg("news_sent").alias("_mean"), F.stddev_samp("news_sent").alias("_std")
    )
    spread = F.when(F.col("_std") > 0, F.col("_std"))
    z = (F.col("news_sent") - F.col("_mean")) / spread
    joined = features.join(stats, "date", "left")
    return joined.select(
        *[z.alias(c) if c == "news_sent" else F.col(c) for c in features.columns]
    )
