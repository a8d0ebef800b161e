import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from closebell.operators import backtest, metrics, signals
from closebell.operators.series import Series

D = dt.date(2023, 1, 1)
FEATURES = "date date, symbol string, r20 double, news_sent double, news_conf double"
BARS = "date date, symbol string, open double, high double, low double, close double, volume bigint"


def day(i):
    return D + dt.timedelta(days=i)


def test_rule_golden_rows(spark):
    df = spark.createDataFrame(
        [(day(0), "AAPL", 0.05, 0.8, 0.9), (day(0), "MSFT", -0.02, -0.7, 0.85), (day(1), "AAPL", 0.03, 0.1, 0.5)],
        FEATURES)
    rows = signals.decide(df, 0.3, -0.3).orderBy("date", "symbol").collect()
    assert [(r.symbol, round(r.alpha, 9), r.side, round(r.conf, 9)) for r in rows] == [
        ("AAPL", 0.425, "BUY", 0.425), ("MSFT", -0.36, "SELL", 0.36), ("AAPL", 0.065, "HOLD", 0.065)]
    assert rows[0].reason == (
        "Strong buy signal (alpha=0.43) based on positive news sentiment (0.80) "
        "and positive momentum (20D return=0.05).")
    assert "alpha=-0.36" in rows[1].reason and rows[1].reason.startswith("Strong sell signal")
    assert rows[2].reason.startswith("Hold signal (alpha=0.07) due to mixed or neutral signals")


def test_rule_edges(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(day(0), "AT", 1.0, 0.0, 0.0), (day(0), "AT-", -1.0, 0.0, 0.0), (day(0), "NULL", None, None, None),
         (day(0), "NAN", nan, 0.4, 0.0), (day(0), "TIE", 0.125, 0.125, 0.0)], FEATURES)
    rows = {r.symbol: r for r in signals.decide(df).collect()}
    assert [rows[s].side for s in ("AT", "AT-", "NULL", "NAN")] == ["HOLD"] * 4
    assert rows["NULL"].alpha == 0.0 and rows["NAN"].alpha == 0.2
    assert "alpha=0.12)" in rows["TIE"].reason
    assert signals.decide(df.limit(0)).count() == 0


def test_orders_and_sides(spark):
    df = spark.createDataFrame([("buy",), ("SELL",), ("short",), (None,)], "side string")
    good, bad = signals.split_by_side(df)
    assert sorted(r.side for r in good.collect()) == ["BUY", "SELL"] and bad.count() == 2
    with pytest.raises(Exception, match="short"):
        df.where("side = 'short'").select(signals.checked_side(F.col("side"))).collect()
    made = signals.decide(spark.createDataFrame(
        [(day(0), "A", 2.0, 2.0, 0.0), (day(0), "B", 0.0, 0.0, 0.0)], FEATURES))
    rows = signals.to_orders(made, 3).collect()
    assert [(r.symbol, r.side, r.qty) for r in rows] == [("A", "BUY", 3)]


def make(spark, series):
    """series: {symbol: [(day, open, close, side or None), ...]}"""
    b = [(day(i), s, o, max(o, c), min(o, c), c, 1) for s, rows in series.items() for i, o, c, _ in rows]
    g = [(day(i), s, x) for s, rows in series.items() for i, _, _, x in rows if x]
    return spark.createDataFrame(b, BARS), spark.createDataFrame(g, "date date, symbol string, side string")


def loop(rows, cash=100_000.0, commission=0.001):
    """One account, one order at a time, filled at the next bar's open."""
    out, long, pending = [], 0, None
    for i, o, c, side in rows:
        fill = 0
        if pending == "BUY":
            fill = 1
        elif pending == "SELL":
            fill = -1
        pending = None
        cash -= fill * o + abs(fill) * o * commission
        long += fill
        if side == "BUY" and not long:
            pending = "BUY"
        elif side == "SELL" and long:
            pending = "SELL"
        out.append((day(i), long, fill, cash + long * c))
    return out


@pytest.fixture(scope="module")
def walk():
    rng = random.Random(5)
    series = {}
    for s, n, step in (("A", 400, 1), ("B", 150, 3), ("C", 2, 1)):
        at, rows = 0, []
        for _ in range(n):
            side = rng.choice([None, None, None, "BUY", "SELL", "HOLD"])
            rows.append((at, rng.uniform(10, 20), rng.uniform(10, 20), side))
            at += rng.randint(1, step)
        series[s] = rows
    return series


@pytest.mark.parametrize("s", [Series(days=32), Series(days=None)], ids=["32d", "whole"])
def test_positions_and_equity_match_an_event_loop(spark, walk, s):
    held = backtest.positions(*make(spark, walk), series=s).cache()
    got = {(r.symbol, r.date): (r.pos, r.fill) for r in held.collect()}
    equity = {(r.run_id, r.date): r.equity for r in backtest.equity_by_symbol(held, series=s).collect()}
    fills = 0
    for symbol, rows in walk.items():
        for d, pos, fill, value in loop(rows):
            assert got[symbol, d] == (pos, fill)
            assert equity[symbol, d] == pytest.approx(value, abs=1e-8)
            fills += fill != 0
    assert fills > 50
    assert backtest.trades(held).count() == fills


def test_portfolio_adds_up(spark, walk):
    held = backtest.positions(*make(spark, walk)).cache()
    curve = {r.date: r.equity for r in backtest.equity_portfolio(held, series=Series(days=32)).collect()}
    alone = {s: dict((d, v - 100_000) for d, _, _, v in loop(rows)) for s, rows in walk.items()}
    last = dict.fromkeys(alone, 0.0)
    for d in sorted(curve):
        last.update({s: days[d] for s, days in alone.items() if d in days})
        assert curve[d] == pytest.approx(100_000 + sum(last.values()), abs=1e-7)
    pnl = sum(r.pnl for r in backtest.pnl_by_symbol(held).collect())
    assert pnl == pytest.approx(curve[max(curve)] - 100_000, abs=1e-7)


def test_order_edges(spark):
    rows = {
        "LAST": [(0, 1.0, 1.0, None), (1, 1.0, 1.0, "BUY")],               # never filled
        "FLAT": [(0, 1.0, 1.0, "SELL"), (1, 1.0, 1.0, None)],              # nothing to sell
        "TWICE": [(0, 1.0, 1.0, "BUY"), (1, 2.0, 2.0, "BUY"), (2, 3.0, 3.0, "SELL"), (5, 4.0, 4.0, None)],
    }
    bars, sig = make(spark, rows)
    held = backtest.positions(bars, sig)
    log = {(r.symbol, r.side): r for r in backtest.trades(held, stake=2, slippage_bps=100).collect()}
    assert set(log) == {("TWICE", "BUY"), ("TWICE", "SELL")}
    buy, sell = log["TWICE", "BUY"], log["TWICE", "SELL"]
    assert (buy.date, buy.qty, buy.price) == (day(1), 2, pytest.approx(2.02))
    assert (sell.date, sell.price) == (day(5), pytest.approx(3.96))
    assert sell.commission == pytest.approx(2 * 3.96 * 0.001)
    trip = backtest.round_trips(backtest.trades(held)).collect()
    assert [(t.opened, t.date, round(t.profit, 9)) for t in trip] == [(day(1), day(5), round(2 - 0.006, 9))]
    empty = backtest.positions(bars.limit(0), sig)
    assert empty.count() == 0 and backtest.trades(empty).count() == 0


def test_an_account_that_cannot_pay_stops_the_job(spark):
    bars, sig = make(spark, {"A": [(0, 10.0, 10.0, "BUY"), (1, 10.0, 10.0, None)]})
    held = backtest.positions(bars, sig)
    with pytest.raises(Exception, match="not enough cash"):
        backtest.equity_by_symbol(held, cash=5.0).collect()
    log = backtest.trades(held).withColumn("run_id", F.col("symbol"))
    for poor in (backtest.equity_by_symbol(held, cash=5.0), backtest.equity_portfolio(held, cash=5.0)):
        for reader in (
            lambda e: e.select("run_id", "date", "equity").collect(),
            lambda e: metrics.performance(e.select("run_id", "date", "equity")).collect(),
            lambda e: backtest.turnover(log, e).collect(),
            lambda e: e.count(),
        ):
            with pytest.raises(Exception, match="not enough cash"):
                reader(poor)
    flagged = backtest.equity_by_symbol(held, cash=5.0, on_shortfall="flag").orderBy("date").collect()
    assert [r.shortfall for r in flagged] == [False, True]
    low = backtest.lowest_cash(backtest.equity_by_symbol(held)).first()
    assert low.min_cash == pytest.approx(100_000 - 10.01)


def test_turnover_and_scaling(spark):
    bars, sig = make(spark, {"A": [(0, 10.0, 10.0, "BUY"), (1, 10.0, 10.0, None)], "B": [(0, 1.0, 1.0, None)]})
    held = backtest.positions(bars, sig)
    log = backtest.trades(held).withColumn("run_id", F.col("symbol"))
    rows = {r.run_id: r.turnover for r in backtest.turnover(log, backtest.equity_by_symbol(held)).collect()}
    assert rows["B"] == 0.0 and rows["A"] == pytest.approx(10 / 99999.995)
    closed = spark.createDataFrame(
        [("A", day(i), p) for i, p in enumerate([1.0, -1.0, -1.0, -1.0, 2.0])], "symbol string, date date, profit double")
    got = backtest.scaled_by_success(closed, n=2, series=Series(days=2)).orderBy("date").collect()
    assert [r.p_success for r in got] == [None, 1.0, 0.5, 0.0, 0.0]
    assert [r.scale for r in got] == [1.0, 1.0, 0.5, 0.0, 0.0]


def curve(spark, **runs):
    return spark.createDataFrame(
        [(k, day(i), v) for k, vs in runs.items() for i, v in enumerate(vs)], "run_id string, date date, equity double")


@pytest.mark.parametrize("s", [Series(("run_id",), days=3), Series(("run_id",), days=None)], ids=["3d", "whole"])
def test_metrics(spark, s):
    values = [100.0, 110.0, 99.0, 105.0, 80.0, 120.0]
    df = curve(spark, one=[5.0], two=[100.0, 150.0], flat=[7.0] * 9, many=values, zero=[0.0, 1.0, 2.0])
    got = {r.run_id: r for r in metrics.performance(df, s).collect()}
    assert tuple(got["one"])[1:] == (0.0, 0.0, 0.0, 0.0)
    two = got["two"]
    assert (two.total_return, two.annualized_volatility, two.sharpe_ratio, two.max_drawdown) == (0.5, None, None, 0.0)
    assert (got["flat"].sharpe_ratio, got["flat"].annualized_volatility) == (0.0, 0.0)
    import pandas as pd

    x = pd.Series(values)
    ret = x.pct_change().dropna()
    many = got["many"]
    assert many.total_return == pytest.approx(0.2)
    assert many.annualized_volatility == pytest.approx(ret.std() * 252**0.5)
    assert many.sharpe_ratio == pytest.approx(ret.mean() / ret.std() * 252**0.5)
    assert many.max_drawdown == pytest.approx((x / x.cummax() - 1).min())
    assert got["zero"].total_return is None
    assert metrics.performance(df.limit(0), s).count() == 0


def test_breaker_runs_and_labels(spark):
    df = curve(spark, a=[100.0, 95.0, 85.0, 101.0])
    assert [r.tripped for r in metrics.breaker(df, -0.1).orderBy("date").collect()] == [False, False, True, False]
    runs = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), "FINISHED", 0.1), ("b", dt.datetime(2024, 1, 3), "FAILED", 0.1),
         ("c", dt.datetime(2024, 1, 2), "FINISHED", 0.2), ("d", dt.datetime(2024, 1, 4), "FINISHED", None)],
        "run_id string, start_time timestamp, status string, total_return double")
    assert metrics.latest_run(runs).first().run_id == "c"
    lines = {r.label: r.value for r in metrics.labelled(metrics.performance(df)).collect()}
    assert lines["Max Drawdown"] == "-0.1500" and lines["Total Return"] == "0.0100"


def test_walk_forward_folds(spark):
    df = spark.createDataFrame([(dt.date(2024, m, d), m * d) for m in range(1, 6) for d in (1, 9)], "date date, x int")
    rows = metrics.walk_forward(df, 3).orderBy("fold").collect()
    assert [(r.fold, str(r.test_start), str(r.test_end), r.train_rows, r.test_rows) for r in rows] == [
        (1, "2024-04-01", "2024-05-01", 6, 2), (2, "2024-05-01", "2024-06-01", 8, 2)]
    train, test = metrics.fold_rows(df, "2024-04-01", "2024-05-01")
    assert (train.count(), test.count()) == (6, 2)
