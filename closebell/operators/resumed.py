"""Momentum features continued from stored block-end states.

``features.momentum`` needs all bars of a symbol, because its averages never forget. But all that a
calendar block needs from the bars before it is small: the last 20 closes and the two averages.
Stored per (symbol, block), these states make a day's work follow the day: when bars are added or
corrected, a symbol is recomputed from the block of its first changed bar on, starting from the
state of the block before. Bars of earlier blocks are not read.

A run returns the features and the states of the blocks it computed; both replace what is stored for
these blocks. Started without states and with all bars as changes, it is the full computation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebell.functions.numbers import null_if_nan
from closebell.operators.features import BARS, rsi, simple_return
from closebell.operators.series import BLOCK, PAST, Series, ewm, with_history

LOOKBACK, RSI_SPAN = 20, 14
STATE = "symbol string, block bigint, tail array<struct<date: date, close: double>>, up double, down double"
EPOCH = dt.date(1970, 1, 1)


def block_of(column: str, series: Series = BARS):
    """The number of the calendar block a date lies in."""
    return F.floor(F.unix_date(F.col(column)) / F.lit(series.days))


def first_blocks(changed: DataFrame, series: Series = BARS) -> DataFrame:
    """``symbol, first``: the block each symbol is recomputed from, for changed (symbol, date)."""
    keyed = changed.where(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    return keyed.groupBy("symbol").agg(F.min(block_of("date", series)).alias("first"))


def touched_bars(bars: DataFrame, first: DataFrame, series: Series = BARS) -> DataFrame:
    """The bars of each symbol from its first changed block on.

    The earliest of these days is a literal in the plan (one number is fetched for it), so the
    scan of a table with a folder per date starts there.
    """
    least = first.agg(F.min("first")).first()[0]
    if least is None:
        return bars.where(F.lit(False))
    start = EPOCH + dt.timedelta(days=int(least) * series.days)
    recent = bars.where(F.col("date") >= F.lit(start))
    return recent.join(first, "symbol").where(
        block_of("date", series) >= F.col("first")).select(*bars.columns)


def states_before(states: DataFrame, first: DataFrame) -> DataFrame:
    """``symbol, tail, up, down``: the last state before each symbol's first changed block. States
    tell the averages at a block's end even if no price has changed in it."""
    earlier = states.join(first, "symbol").where(F.col("block") < F.col("first"))
    return earlier.groupBy("symbol").agg(
        *[F.max_by(c, "block").alias(c) for c in ("tail", "up", "down")])


def momentum_from(
    bars: DataFrame, states: DataFrame, changed: DataFrame, series: Series = BARS
) -> tuple[DataFrame, DataFrame]:
    """(features, states) of every touched block: ``symbol, block, date, r20, rsi14`` for each bar,
    as ``features.momentum`` has them, and ``symbol, block, tail, up, down`` (see ``STATE``).

    ``states`` holds what earlier runs returned; ``changed`` (symbol, date) the bars that are new or
    corrected. ``bars`` is the whole table.
    """
    first = first_blocks(changed, series)
    before = states_before(states, first)
    closes = touched_bars(bars, first, series).select(
        "symbol", "date", null_if_nan(F.col("close")).alias("close"))
    rows = with_history(closes, series, LOOKBACK, ["close"])
    # the first block's history comes from the state instead
    least = rows.where(~F.col(PAST)).groupBy("symbol").agg(F.min(BLOCK).alias(BLOCK))
    stored = before.join(least, "symbol").select(
        "symbol", BLOCK, F.explode("tail").alias("t")).select(
        "symbol", BLOCK, "t.date", "t.close", F.lit(True).alias(PAST))
    # a short block passes on what it has; the state fills up the rest of the 20 bars
    short = _fill_up(rows, before, series)
    rows = rows.unionByName(stored).unionByName(short)

    w = series.window()
    change = F.col("close") - F.lag("close").over(w)
    back = simple_return(F.col("close"), F.lag("close", LOOKBACK).over(w))
    moves = rows.select("*", back.alias("r20"), change.alias("_change"))
    moves = moves.where(~F.col(PAST)).drop(PAST).select(
        "*",
        *[F.when(F.col("_change").isNotNull(), F.greatest(sign * F.col("_change"), F.lit(0.0)))
          .alias(name) for name, sign in (("_gain", 1), ("_loss", -1))])
    alpha = 1.0 / RSI_SPAN
    seeds = before.select("symbol", F.col("up").alias("_up"), F.col("down").alias("_down"))
    smoothed = ewm(moves, series, seeds, _up=("_gain", alpha), _down=("_loss", alpha))
    features = smoothed.select(
        "symbol", F.col(BLOCK).alias("block"), "date", "r20",
        rsi(F.col("_up"), F.col("_down")).alias("rsi14"))
    return features, _block_ends(rows, smoothed, before, series)


def _fill_up(rows: DataFrame, before: DataFrame, series: Series) -> DataFrame:
    """Bars from the stored tail for touched blocks after the first that still lack some of the 20."""
    held = rows.groupBy("symbol", BLOCK).agg(
        F.count_if(F.col(PAST)).alias("_had"), F.min(F.when(~F.col(PAST), F.col("date"))).alias("_at"))
    first = held.groupBy("symbol").agg(F.min(BLOCK).alias("_least"))
    lacking = held.join(first, "symbol").where(
        (F.col(BLOCK) > F.col("_least")) & (F.col("_had") < LOOKBACK))
    wanted = F.lit(LOOKBACK) - F.col("_had")
    tail = F.slice("tail", F.greatest(F.size("tail") - wanted, F.lit(0)) + 1, wanted)
    return lacking.join(before, "symbol").select(
        "symbol", BLOCK, F.explode(tail.cast("array<struct<date: date, close: double>>")).alias("t")
    ).select("symbol", BLOCK, "t.date", "t.close", F.lit(True).alias(PAST))


def _block_ends(
    rows: DataFrame, smoothed: DataFrame, before: DataFrame, series: Series
) -> DataFrame:
    """The states of the touched blocks. Averages not known in a block are those before it."""
    tails = rows.groupBy("symbol", BLOCK).agg(
        F.sort_array(F.collect_list(F.struct("date", "close"))).alias("_rows")
    ).select("symbol", BLOCK, F.slice(
        "_rows", F.greatest(F.size("_rows") - LOOKBACK, F.lit(0)) + 1, F.lit(LOOKBACK)).alias("tail"))
    known = F.when(F.col("_up").isNotNull(), F.col("date"))
    ends = smoothed.groupBy("symbol", BLOCK).agg(
        F.max_by("_up", known).alias("_up"), F.max_by("_down", known).alias("_down"))
    so_far = series.earlier_blocks().rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select("symbol", BLOCK, *[
        F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("_up", "_down")])
    seeds = before.select("symbol", F.col("up").alias("_up0"), F.col("down").alias("_down0"))
    return tails.join(ends, ["symbol", BLOCK]).join(seeds, "symbol", "left").select(
        "symbol", F.col(BLOCK).alias("block"), "tail",
        F.coalesce("_up", "_up0").alias("up"), F.coalesce("_down", "_down0").alias("down"))
