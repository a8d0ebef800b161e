"""The daily run: landed files to lake tables to signals, backtest and metrics.

Each step reads lake tables and writes the next one, so a step can be rerun alone and gives
the same rows. Starting and retrying steps is the job of whatever scheduler calls them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebell.functions.dates import days_before
from closebell.operators import (
    backtest,
    features,
    fundamentals,
    metrics,
    news,
    quality,
    resumed,
    sentiment,
    signals,
)
from closebell.schemas import DATASETS, EQUITY, FEATURES, METRICS, SENTIMENT, SIGNALS
from closebell.session import stage, staging
from closebell.sources import lake, landed

INGEST_DAYS = 30
BACKTEST_DAYS = 7


def ingest(
    spark: SparkSession, landed_root: str, root: str, symbols: Sequence[str], start: str, end: str
) -> None:
    """Landed bars, statements and news of ``symbols`` into the lake.

    Bars run from ``start`` up to, not including, ``end``; news days include both. Only bars that are
    not stored alike are written, and only their days get new checksums. What has changed is noted in
    ``bar_changes`` before it is written, and stays there until ``update_momentum`` has seen it.
    """
    with staging(spark):
        bars = landed.read_bars(spark, f"{landed_root}/bars", start, end, symbols)
        stored = lake.read(spark, root, "ohlcv_daily")
        window = stored.where(
            (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
        changed = stage(lake.changed_rows(bars, window), "changed-bars")
        noted = lake.read(spark, root, "bar_changes").unionByName(changed.select("symbol", "date"))
        lake.replace(noted.distinct(), root, "bar_changes")
        lake.upsert_bars(changed, root)
        touched = lake.read(spark, root, "bar_changes")
        recorded = lake.read(spark, root, "ohlcv_checksums")
        stored = lake.read(spark, root, "ohlcv_daily")
        lake.replace(quality.updated_checksums(stored, recorded, touched), root, "ohlcv_checksums")
    statements = landed.read_statements(spark, f"{landed_root}/statements", symbols)
    lake.upsert_fundamentals(fundamentals.merged(*statements), root)
    raw = landed.read_news(
        spark, f"{landed_root}/news", symbols, f"{start}T00:00:00Z", f"{end}T23:59:59Z"
    )
    lake.replace(raw, root, "news_raw")
    lake.replace(news.normalised(lake.read(spark, root, "news_raw")), root, "news_norm")


def score(
    spark: SparkSession,
    root: str,
    load_model: Callable[[], sentiment.Scorer],
    labels: Sequence[str] = sentiment.LABELS,
    model: str | None = None,
    scored_on: str | None = None,
) -> None:
    """Score the normalised news and store sentiment per (date, symbol).

    With the name of a ``model``, scores are kept in ``title_scores``: a title is scored once by
    each model, on the day ``scored_on``, however often it comes and the day is rerun.
    """
    headlines = lake.read(spark, root, "news_norm")
    if model is None:
        scores = sentiment.score_news(headlines, load_model, labels)
    else:
        dataset = DATASETS["title_scores"]
        found = sentiment.score_titles(
            headlines, lake.read(spark, root, "title_scores"), load_model, model, labels=labels)
        found = found.withColumn("scored_on", F.lit(scored_on).cast("date"))
        lake.upsert(found.select(*dataset.schema.fieldNames()), lake.path_of(root, "title_scores"),
                    dataset.schema, dataset.keys, dataset.partitions)
        scores = sentiment.with_scores(headlines, lake.read(spark, root, "title_scores"), model)
    daily = sentiment.daily(scores).select(*SENTIMENT.fieldNames())
    lake.replace(daily, root, "sentiment_daily")


def update_momentum(spark: SparkSession, root: str) -> None:
    """Bring ``momentum_daily`` and the states it is continued from up to the bars noted in
    ``bar_changes``. Blocks before a symbol's first change are neither read nor written; without
    states, all bars count as changed. A run that fails is made good by the next one."""
    bars = lake.read(spark, root, "ohlcv_daily")
    states = lake.read(spark, root, "momentum_states")
    changed = lake.read(spark, root, "bar_changes")
    if states.isEmpty():
        changed = bars
    elif changed.isEmpty():
        return
    for name, rows in zip(
        ("momentum_daily", "momentum_states"), resumed.momentum_from(bars, states, changed)
    ):
        dataset = DATASETS[name]
        lake.upsert(rows.select(*dataset.schema.fieldNames()), lake.path_of(root, name),
                    dataset.schema, dataset.keys, dataset.partitions)
    lake.replace(lake.empty(spark, DATASETS["bar_changes"].schema), root, "bar_changes")


def build_features(
    spark: SparkSession,
    root: str,
    start: str,
    end: str,
    sectors: DataFrame | None = None,
) -> None:
    """Features for ``start <= date <= end``: those of the full series, continued from stored states."""
    update_momentum(spark, root)
    days = F.lit(start).cast("date"), F.lit(end).cast("date")
    blocks = [F.floor(F.unix_date(d) / F.lit(features.BARS.days)) for d in days]
    rows = lake.read(spark, root, "momentum_daily").where(
        F.col("block").between(*blocks) & F.col("date").between(*days) & F.col("r20").isNotNull()
    ).select("date", "symbol", "r20", "rsi14")
    rows = features.with_sentiment(rows, lake.read(spark, root, "sentiment_daily"))
    if sectors is None:
        rows = rows.withColumn("sector", F.lit(None).cast("string"))
    else:
        rows = features.with_sector(rows, sectors)
    # decisions are taken day by day: rows of a day lie together
    laid_out = rows.select(*FEATURES.fieldNames()).repartitionByRange("date", "symbol")
    lake.replace(laid_out.sortWithinPartitions("date", "symbol"), root, "features_daily")


def decide(spark: SparkSession, root: str, **rule) -> None:
    """Signals of the stored features, and the orders they call for."""
    found = signals.decide(lake.read(spark, root, "features_daily"), **rule)
    lake.replace(found.select(*SIGNALS.fieldNames()), root, "aggregated_signals")
    lake.replace(
        signals.to_orders(lake.read(spark, root, "aggregated_signals")), root, "orders"
    )


def backtest_and_measure(
    spark: SparkSession, root: str, symbols: Sequence[str], start: str, end: str, **account
) -> None:
    """Backtest ``symbols`` over ``start <= date <= end``; store equity curve and metrics,
    and record the run under its last day unless ``run_id`` is given."""
    account.setdefault("run_id", end)
    _, _, equity = backtest.run_backtest(
        lake.read(spark, root, "ohlcv_daily"),
        lake.read(spark, root, "aggregated_signals"),
        symbols, start, end, **account,
    )
    lake.replace(equity.select(*EQUITY.fieldNames()), root, "equity_curve")
    found = metrics.performance(lake.read(spark, root, "equity_curve"))
    lake.replace(found.select(*METRICS.fieldNames()), root, "metrics")
    lake.record_run(spark, root, lake.read(spark, root, "metrics"), started=end)


def report(spark: SparkSession, root: str) -> DataFrame:
    """Metrics of the latest finished run as labelled lines."""
    return metrics.labelled(metrics.latest_run(lake.read(spark, root, "runs")))


def nightly_checks(
    spark: SparkSession, root: str, today: str, names: Sequence[str] = ("ohlcv_daily", "news_norm")
) -> None:
    """Raise when a table breaks its contract, has null or repeated keys, or is out of date; when
    sentiment is out of range, bars are not those their checksums were taken of, or a feature
    is dated after the last bar it can have been computed from."""
    for name in names:
        dataset, rows = DATASETS[name], lake.read(spark, root, name)
        quality.require(rows, dataset.schema, dataset.keys)
        state = quality.freshness(rows, today, dataset.max_age_days, dataset.date_column).first()
        if not state.fresh:
            raise quality.ContractError(f"{name} is out of date: latest is {state.latest}")
    scores = lake.read(spark, root, "sentiment_daily")
    for check in quality.out_of_range(scores, quality.SENTIMENT_BOUNDS).where("violations > 0").collect():
        raise quality.ContractError(f"{check.violations} values of {check.column} out of range")
    bars = lake.read(spark, root, "ohlcv_daily")
    recorded = lake.read(spark, root, "ohlcv_checksums")
    changed = quality.changed_partitions(bars, recorded, ["date"]).orderBy("date").first()
    if changed:
        raise quality.ContractError(f"bars of {changed.date} do not match their checksum")
    last = bars.groupBy("symbol").agg(F.max("date").alias("last_bar"))
    found = lake.read(spark, root, "features_daily").join(last, "symbol", "left")
    early = quality.causality_violations(found, "last_bar", "date").first()
    if early.violations:
        raise quality.ContractError(f"{early.violations} features from after the last bar")


def run_day(
    spark: SparkSession,
    landed_root: str,
    root: str,
    run_date: str,
    symbols: Sequence[str],
    load_model: Callable[[], sentiment.Scorer],
    mode: str = "backtest",
    model: str | None = None,
    **rule,
) -> dict[str, int]:
    """All steps for one day. ``model`` names the model's stored scores (see ``score``). Mode ``backtest`` measures the last week; ``paper`` stops at
    the orders table, which a trading client picks up. Returns the rows of each table.
    Tables staged on the way are dropped at the end, also after an error."""
    if mode not in ("backtest", "paper"):
        raise ValueError(f"mode must be 'backtest' or 'paper', not {mode!r}")
    tomorrow = (dt.date.fromisoformat(run_date) + dt.timedelta(days=1)).isoformat()
    first = days_before(run_date, INGEST_DAYS)
    with staging(spark):
        ingest(spark, landed_root, root, symbols, first, tomorrow)
        score(spark, root, load_model, model=model, scored_on=run_date)
        build_features(spark, root, first, run_date)
        decide(spark, root, **rule)
        if mode == "backtest":
            backtest_and_measure(
                spark, root, symbols, days_before(run_date, BACKTEST_DAYS), run_date
            )
    return {name: lake.read(spark, root, name).count() for name in DATASETS}
