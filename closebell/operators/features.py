"""Daily features from bars: momentum, RSI, indicators, adjusted prices, feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebell.functions.numbers import null_if_nan
from closebell.operators.series import Series, ewm, own_rows, running, with_history

BARS = Series()


def simple_return(now: Column, before: Column) -> Column:
    return F.try_divide(now, before) - 1


def momentum(
    bars: DataFrame, series: Series = BARS, lookback: int = 20, rsi_span: int = 14
) -> DataFrame:
    """``r20`` and ``rsi14`` for every bar: one shuffle of (symbol, date, close).

    r20 is the return over 20 bars, null for the first 20. RSI smooths gains and losses
    with alpha = 1/14 from the first change on (no warm-up), over non-null changes; it is
    null where there has been no movement at all.
    """
    w = series.window()
    change = F.col("close") - F.lag("close").over(w)
    closes = bars.select(*series.keys, *series.order, null_if_nan(F.col("close")).alias("close"))
    changes = own_rows(
        with_history(closes, series, lookback, ["close"]).select(
            "*",
            simple_return(F.col("close"), F.lag("close", lookback).over(w)).alias("r20"),
            change.alias("_change"),
        )
    )
    moves = changes.select(
        "*",
        F.when(F.col("_change").isNotNull(), F.greatest("_change", F.lit(0.0))).alias("_gain"),
        F.when(F.col("_change").isNotNull(), F.greatest(-F.col("_change"), F.lit(0.0))).alias("_loss"),
    )
    smoothed = ewm(
        moves, series, _up=("_gain", 1.0 / rsi_span), _down=("_loss", 1.0 / rsi_span)
    )
    return smoothed.select(
        *series.order, *series.keys, "r20", rsi(F.col("_up"), F.col("_down")).alias("rsi14")
    )


def trailing_return(bars: DataFrame, lookback: int = 20, series: Series = BARS) -> DataFrame:
    """``date, symbol, r20`` alone, without the first ``lookback`` bars of each symbol."""
    before = F.lag("close", lookback).over(series.window())
    rows = _looking_back(
        bars, series, lookback, ["close"], r20=simple_return(F.col("close"), before)
    )
    return rows.where(F.col("r20").isNotNull())


def with_return(bars: DataFrame, lookback: int = 20, series: Series = BARS) -> DataFrame:
    """All bars with ``r20``, which is null for the first ``lookback`` bars of each symbol: what
    decides and what is traded stay in one row, so neither is joined to the other later."""
    before = F.lag("close", lookback).over(series.window())
    rows = with_history(bars, series, lookback, ["close"])
    added = own_rows(rows.withColumn("r20", simple_return(F.col("close"), before)))
    return added.select(*bars.columns, "r20")


def rsi(up: Column, down: Column) -> Column:
    return F.when(down > 0, 100 - 100 / (1 + up / down)).when(up > 0, 100.0)


def daily_features(bars: DataFrame, series: Series = BARS) -> DataFrame:
    """``date, symbol, r20, rsi14`` without the first 20 bars of each symbol."""
    return momentum(bars, series).where(F.col("r20").isNotNull())


def features_between(
    bars: DataFrame, start: str, end: str, series: Series = BARS
) -> DataFrame:
    """``daily_features`` of ``start <= date <= end``. The averages never forget, so all bars up
    to ``end`` are read: a rebuilt day has the values of the full series."""
    rows = daily_features(bars.where(F.col("date") <= F.lit(end).cast("date")), series)
    return rows.where(F.col("date") >= F.lit(start).cast("date"))


def with_sentiment(features: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Add ``news_sent`` and ``news_conf`` of the same day; null on days without news."""
    daily = sentiment.select("date", "symbol", "news_sent", "news_conf")
    return features.join(daily, ["date", "symbol"], "left")


def with_sector(features: DataFrame, sectors: DataFrame) -> DataFrame:
    """Add ``sector`` from a (symbol, sector) table; null for symbols not in it.

    No broadcast hint: Spark broadcasts by the table's measured size.
    """
    return features.join(sectors.select("symbol", "sector"), "symbol", "left").select(
        *features.columns, "sector"
    )


def _looking_back(bars: DataFrame, series: Series, k: int, columns: list[str], **outs: Column):
    """Window expressions over at most ``k`` earlier rows, as new columns."""
    rows = with_history(bars.select(*series.order, *series.keys, *columns), series, k, columns)
    added = rows.select("*", *[c.alias(name) for name, c in outs.items()])
    return own_rows(added).select(*series.order, *series.keys, *outs)


def returns(bars: DataFrame, series: Series = BARS) -> DataFrame:
    """``simple_return`` and ``log_return`` from bar to bar; null on the first."""
    before = F.lag("close").over(series.window())
    ratio = F.try_divide(F.col("close"), before)
    return _looking_back(
        bars, series, 1, ["close"],
        simple_return=ratio - 1, log_return=F.when(ratio > 0, F.ln(ratio)),
    )


def moving_average(
    bars: DataFrame, n: int = 20, column: str = "close", series: Series = BARS
) -> DataFrame:
    """Mean of the last ``n`` bars as ``sma``; null until there are ``n``."""
    frame = series.window().rowsBetween(1 - n, 0)
    full = F.count(F.lit(1)).over(frame) == n
    return _looking_back(
        bars, series, n - 1, [column], sma=F.when(full, F.avg(column).over(frame))
    )


def rolling_volatility(bars: DataFrame, n: int = 20, series: Series = BARS) -> DataFrame:
    """Sample deviation of the last ``n`` bar returns as ``vol``; null until there are ``n``."""
    frame = series.window().rowsBetween(1 - n, 0)
    back = simple_return(F.col("close"), F.lag("close").over(series.window()))
    rows = with_history(bars.select(*series.order, *series.keys, "close"), series, n, ["close"])
    rows = rows.withColumn("_ret", back)
    full = F.count("_ret").over(frame) == n
    rows = rows.withColumn("vol", F.when(full, F.stddev_samp("_ret").over(frame)))
    return own_rows(rows).select(*series.order, *series.keys, "vol")


def _span(n: int) -> float:
    return 2.0 / (n + 1)


def macd(
    bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, series: Series = BARS
) -> DataFrame:
    """Difference of a fast and a slow average (``macd``) and its own average (``macd_signal``)."""
    rows = bars.select(*series.order, *series.keys, "close")
    rows = ewm(rows, series, _fast=("close", _span(fast)), _slow=("close", _span(slow)))
    rows = rows.withColumn("macd", F.col("_fast") - F.col("_slow"))
    rows = ewm(rows, series, macd_signal=("macd", _span(signal)))
    return rows.select(*series.order, *series.keys, "macd", "macd_signal")


def average_true_range(bars: DataFrame, n: int = 14, series: Series = BARS) -> DataFrame:
    """Exponential average (alpha = 1/n) of the true range as ``atr``."""
    before = F.lag("close").over(series.window())
    rows = with_history(
        bars.select(*series.order, *series.keys, "high", "low", "close"), series, 1, ["close"]
    )
    true_range = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)
    )
    ranges = own_rows(rows.withColumn("_range", true_range))
    return ewm(ranges, series, atr=("_range", 1.0 / n)).select(
        *series.order, *series.keys, "atr"
    )


def adjusted(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Prices times the split and dividend ``factor`` of (symbol, date); 1 where none is given."""
    factor = F.coalesce("factor", F.lit(1.0))
    scaled = {c: F.col(c) * factor for c in ("open", "high", "low", "close")}
    joined = bars.join(factors.select("symbol", "date", "factor"), ["symbol", "date"], "left")
    return joined.select(*[scaled.get(c, F.col(c)).alias(c) for c in bars.columns])


def _last_bar_before(rows: DataFrame, series: Series) -> DataFrame:
    """Adds ``_before``, the close of the symbol's last bar before a row."""
    return own_rows(
        with_history(rows, series, 1, ["close"]).withColumn(
            "_before", F.lag("close").over(series.window())))


def adjustment_factors(
    bars: DataFrame, actions: DataFrame, series: Series = BARS
) -> DataFrame:
    """``symbol, date, factor, shares`` per bar: what its prices, and its volume, are multiplied by.

    ``actions`` has ``symbol, date`` (the first day without the right), ``split`` (new shares for an
    old one, null or 1 for none) and ``dividend`` (per old share, null or 0 for none). An action
    takes effect on the symbol's first bar on or after its day, and multiplies all bars before that
    by (1 - dividend / close of the last bar before) / split. Several actions that meet at one bar
    add up their dividends and multiply their splits. Without effect are actions after the last bar or
    up to the first, splits that are not positive, and dividends that leave no price.

    The factor is a running product from the end of the series backwards, carried from block to
    block; an action meets its bar by the same kind of carry, not by a range join.
    """
    days = actions.where(F.col("symbol").isNotNull() & F.col("date").isNotNull()).groupBy(
        "symbol", "date").agg(
        F.product(F.when(F.col("split") > 0, F.col("split"))).alias("_split"),
        F.sum("dividend").alias("_dividend"))
    dated = bars.select("symbol", "date", F.col("date").alias("_bar")).unionByName(
        days.select("symbol", "date", F.lit(None).cast("date").alias("_bar"), "_split", "_dividend"),
        allowMissingColumns=True)
    # a bar and an action of its day are two rows: the bar is the later one, so it is met first backwards
    order = Series(series.keys, (*series.order, "_is_bar"), series.days)
    met = running(
        dated.withColumn("_is_bar", F.col("_bar").isNotNull()), order, backwards=True,
        _at=("last", "_bar"))
    at_bar = met.where(~F.col("_is_bar") & F.col("_at").isNotNull()).groupBy(
        "symbol", F.col("_at").alias("date")).agg(
        F.product("_split").alias("_split"), F.sum("_dividend").alias("_dividend"))
    rows = bars.select("symbol", "date", null_if_nan(F.col("close")).alias("close"))
    rows = _last_bar_before(rows, series).join(at_bar, ["symbol", "date"], "left")
    left = 1 - F.try_divide(F.coalesce("_dividend", F.lit(0.0)), F.col("_before"))
    first, one = F.col("_before").isNull(), F.lit(1.0)
    rows = rows.select(
        "symbol", "date",
        F.when(first, one).otherwise(F.coalesce("_split", one)).alias("_split"),
        F.when(left > 0, left).otherwise(one).alias("_left"))
    rows = rows.withColumn("_step", F.col("_left") / F.col("_split"))
    total = running(rows, series, backwards=True,
                    _all=("product", "_step"), _shares=("product", "_split"))
    # the bar an action takes effect on is not changed by it
    return total.select(
        "symbol", "date", (F.col("_all") / F.col("_step")).alias("factor"),
        (F.col("_shares") / F.col("_split")).alias("shares"))


def adjusted_by_actions(
    bars: DataFrame, actions: DataFrame, series: Series = BARS
) -> DataFrame:
    """Bars with prices and volumes as if all splits and dividends had been in effect from the start.
    Volumes are rounded to whole shares."""
    scaled = {c: F.col(c) * F.col("factor") for c in ("open", "high", "low", "close")}
    scaled["volume"] = F.round(F.col("volume") * F.col("shares")).cast("bigint")
    joined = bars.join(adjustment_factors(bars, actions, series), ["symbol", "date"])
    return joined.select(*[scaled.get(c, F.col(c)).alias(c) for c in bars.columns])


def liquid(
    bars: DataFrame, min_volume: float, n: int = 20, series: Series = BARS
) -> DataFrame:
    """Bars whose mean volume over the last ``n`` bars reaches ``min_volume``."""
    frame = series.window().rowsBetween(1 - n, 0)
    rows = with_history(bars, series, n - 1, ["volume"])
    rows = rows.withColumn("_mean_volume", F.avg("volume").over(frame))
    return own_rows(rows).where(F.col("_mean_volume") >= min_volume).select(*bars.columns)


def bars_between(bars: DataFrame, symbols, start: str, end: str) -> DataFrame:
    """Bars of the given symbols with ``start <= date <= end``, sorted within partitions."""
    picked = bars.where(
        F.col("symbol").isin(*symbols)
        & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    return picked.sortWithinPartitions("symbol", "date")
