import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from closebell.operators import features, universe
from closebell.operators.series import Series

START = dt.date(2024, 1, 1)
SERIES = [Series(days=16), Series(), Series(days=None)]


def bars(spark, closes, start=START, **extra):
    """One bar per day and symbol; ``closes`` maps symbol to a list of closes."""
    rows = [
        (start + dt.timedelta(days=i), s, c, c, c, c, 100 + i)
        for s, values in closes.items()
        for i, c in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "date date, symbol string, open double, high double, low double, close double, volume bigint"
    )


def by_date(df, column):
    return [r[column] for r in df.orderBy("symbol", "date").collect()]


def rsi_loop(closes, n=14):
    """The definition, one value after the other; None where a change is missing."""
    out, up, down, before = [], None, None, None
    for c in closes:
        change = None if c is None or before is None else c - before
        before = c
        if change is None:
            out.append(None)
            continue
        gain, loss = max(change, 0.0), max(-change, 0.0)
        up = gain if up is None else up + (gain - up) / n
        down = loss if down is None else down + (loss - down) / n
        out.append(None if up == down == 0 else 100.0 if down == 0 else 100 - 100 / (1 + up / down))
    return out


@pytest.mark.parametrize("series", SERIES, ids=["16d", "512d", "whole"])
def test_return_needs_21_bars(spark, series):
    df = bars(spark, {"A": [1.0] * 20, "B": [2.0] * 20 + [3.0], "Z": [0.0] + [1.0] * 20})
    got = features.trailing_return(df, series=series).collect()
    assert [(r.symbol, r.r20) for r in got] == [("B", 0.5)]


@pytest.mark.parametrize("series", SERIES, ids=["16d", "512d", "whole"])
def test_rsi_edge_cases(spark, series):
    cases = {
        "DOWN": [50.0 - i for i in range(40)],
        "FLAT": [5.0] * 40,
        "GAP": [10.0, 11.0, None, 12.0, 11.0, 13.0],
        "ONE": [7.0],
        "TAIL": [10.0, 12.0, 11.0] + [11.0] * 60,
        "UP": [1.0 + i for i in range(40)],
    }
    got = by_date(features.momentum(bars(spark, cases), series), "rsi14")
    want = [v for s in sorted(cases) for v in rsi_loop(cases[s])]
    assert [g is None for g in got] == [w is None for w in want]
    assert [g for g in got if g is not None] == pytest.approx([w for w in want if w is not None])
    tail = got[-40 - 63 : -40]
    assert tail[-1] == pytest.approx(tail[2])


def test_rsi_matches_pandas_on_a_walk(spark):
    rng = np.random.default_rng(1)
    closes = (100 + rng.normal(0, 1, 1500).cumsum()).tolist()
    got = by_date(features.momentum(bars(spark, {"A": closes}), Series(days=200)), "rsi14")
    diff = pd.Series(closes).diff()
    up = diff.clip(lower=0).iloc[1:].ewm(com=13, adjust=False).mean()
    down = (-diff).clip(lower=0).iloc[1:].ewm(com=13, adjust=False).mean()
    assert got[0] is None
    np.testing.assert_allclose(got[1:], 100 - 100 / (1 + up / down), rtol=1e-9)


def test_features_join_sentiment_and_sector(spark):
    df = bars(spark, {"A": [1.0 + i for i in range(22)], "B": [3.0] * 21})
    sentiment = spark.createDataFrame(
        [(START + dt.timedelta(days=20), "A", 0.5, 0.9)],
        "date date, symbol string, news_sent double, news_conf double",
    )
    sectors = spark.createDataFrame([("A", "Tech")], "symbol string, sector string")
    rows = features.with_sector(
        features.with_sentiment(features.daily_features(df), sentiment), sectors
    ).orderBy("symbol", "date").collect()
    assert [(r.symbol, r.news_sent, r.sector) for r in rows] == [
        ("A", 0.5, "Tech"), ("A", None, "Tech"), ("B", None, None)
    ]


def test_rolling_indicators_match_pandas(spark):
    rng = np.random.default_rng(2)
    closes = (50 + rng.normal(0, 1, 300).cumsum()).tolist()
    df, s = bars(spark, {"A": closes}), Series(days=50)
    x = pd.Series(closes)

    def column(frame, name):
        return pd.Series([np.nan if v is None else v for v in by_date(frame, name)])

    np.testing.assert_allclose(column(features.moving_average(df, 20, series=s), "sma"), x.rolling(20).mean(), rtol=1e-10)
    np.testing.assert_allclose(
        column(features.rolling_volatility(df, 20, s), "vol"), x.pct_change().rolling(20).std(), rtol=1e-8)
    fast, slow = x.ewm(span=12, adjust=False).mean(), x.ewm(span=26, adjust=False).mean()
    got = features.macd(df, series=s)
    np.testing.assert_allclose(column(got, "macd"), fast - slow, atol=1e-9)
    np.testing.assert_allclose(
        column(got, "macd_signal"), (fast - slow).ewm(span=9, adjust=False).mean(), atol=1e-9)
    np.testing.assert_allclose(
        column(features.returns(df, s), "log_return")[1:], np.log(x / x.shift())[1:], rtol=1e-10)


def test_true_range_uses_the_previous_close(spark):
    rows = [(START, "A", 10.0, 12.0, 9.0, 11.0, 1), (START + dt.timedelta(days=1), "A", 15.0, 16.0, 14.0, 15.0, 1)]
    df = spark.createDataFrame(
        rows, "date date, symbol string, open double, high double, low double, close double, volume bigint")
    assert by_date(features.average_true_range(df, 14), "atr") == pytest.approx([3.0, 3 + (5 - 3) / 14])


def test_adjusted_prices_and_liquidity(spark):
    df = bars(spark, {"A": [10.0, 20.0], "B": [1.0, 1.0]})
    factors = spark.createDataFrame([("A", START, 0.5)], "symbol string, date date, factor double")
    assert by_date(features.adjusted(df, factors), "close") == [5.0, 20.0, 1.0, 1.0]
    assert features.liquid(df, 100.5, n=2).count() == 2


def test_universe(spark):
    df = bars(spark, {"A": [1.0], "B": [5.0], "C": [5.0], "D": [2.0]})
    top = universe.top_by_dollar_volume(df, 2)
    assert [r.symbol for r in top.collect()] == ["B", "C"]
    assert {r.symbol for r in universe.restrict(df, top).collect()} == {"B", "C"}


def test_alias_mapping(spark):
    news = spark.createDataFrame(
        [(1, "X", "apple up"), (2, None, "Big Apple"), (3, None, "msft and apple"),
         (4, None, "nothing"), (5, None, None)],
        "ingest_seq bigint, symbol string, title string")
    aliases = spark.createDataFrame(
        [("apple", "AAPL"), ("msft", "MSFT"), ("big apple", "NYC"), ("", "BAD")], "alias string, symbol string")
    got = {r.ingest_seq: r.symbol for r in universe.map_to_symbols(news, aliases).collect()}
    assert got == {1: "X", 2: "NYC", 3: "MSFT", 4: None, 5: None}
