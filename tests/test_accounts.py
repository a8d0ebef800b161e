import datetime as dt
import itertools
import math
import random

import pytest

from closebell.operators import accounts, backtest
from closebell.operators.series import Series
from test_signals_backtest import make


def day(i):
    return dt.date(2023, 1, 1) + dt.timedelta(days=i)


def loop(rows, cash, commission=0.001, slip=0.0, check_submit=True):
    """One account, bar by bar."""
    out, pos, pending = [], 0, None
    for i, o, c, side in rows:
        fill, refused = 0, False
        if pending and pending[0] == "BUY" and not pos:
            asked = max(o * (1 + slip), pending[1]) if check_submit else o * (1 + slip)
            if cash >= asked * (1 + commission):
                fill, cash = 1, cash - o * (1 + slip) * (1 + commission)
            else:
                refused = True
        elif pending and pending[0] == "SELL" and pos:
            fill, cash = -1, cash + o * (1 - slip) * (1 - commission)
        pos += fill
        pending = (side, c) if side in ("BUY", "SELL") else None
        out.append((day(i), pos, fill, refused, cash))
    return out


def series_of(rng, n, step=2):
    at, rows = 0, []
    for _ in range(n):
        price = rng.uniform(85, 120)
        rows.append((at, price, price * rng.uniform(0.97, 1.03),
                     rng.choice([None, None, "BUY", "BUY", "SELL", "HOLD"])))
        at += rng.randint(1, step)
    return rows


@pytest.mark.parametrize("s", [Series(days=16), Series(days=None)], ids=["16d", "whole"])
@pytest.mark.parametrize("options", [{}, {"check_submit": False, "slippage_bps": 30.0}], ids=["plain", "slip"])
def test_equals_a_loop_over_bars(spark, s, options):
    rng = random.Random(11)
    walk = {f"S{k}": series_of(rng, n) for k, n in enumerate((1, 2, 40, 150, 300, 300))}
    bars, sig = make(spark, walk)
    held = accounts.limited_positions(bars, sig, cash=110.0, series=s, **options).collect()
    got = {(r.symbol, r.date): r for r in held}
    refused = filled = 0
    for symbol, rows in walk.items():
        slip = options.get("slippage_bps", 0.0) / 10_000
        for d, pos, fill, no, cash in loop(rows, 110.0, slip=slip, check_submit=options.get("check_submit", True)):
            r = got[symbol, d]
            assert (r.pos, r.fill, r.refused) == (pos, fill, no)
            assert r.cash == pytest.approx(cash, abs=1e-8) and r.cash >= 0
            refused, filled = refused + no, filled + abs(fill)
    assert refused > 10 and filled > 30 and len(held) == sum(map(len, walk.values()))


def test_rich_accounts_equal_plain_positions(spark):
    rng = random.Random(2)
    bars, sig = make(spark, {"A": series_of(rng, 200), "B": series_of(rng, 90)})
    plain = {(r.symbol, r.date): (r.pos, r.fill) for r in backtest.positions(bars, sig).collect()}
    rich = accounts.limited_positions(bars, sig, series=Series(days=32)).collect()
    assert {(r.symbol, r.date): (r.pos, r.fill) for r in rich} == plain
    assert not any(r.refused for r in rich)


def test_maps_equal_walks_from_any_state():
    rng = random.Random(7)
    for _ in range(200):
        orders = []
        for _ in range(rng.randint(0, 25)):
            price = rng.choice((10.0, 20.0, rng.uniform(5, 25)))
            orders.append((rng.randint(0, 1), price * 1.01, price, price * 0.99))
        for pos in (0, 1):
            pieces = accounts.block_map(orders, pos)
            assert pieces[0][0] == -math.inf
            assert all(a[0] < b[0] and a[1:] != b[1:] for a, b in itertools.pairwise(pieces))
            for cash in [*(rng.uniform(0, 60) for _ in range(20)), *(p[0] for p in pieces[1:])]:
                _, end, gain = [p for p in pieces if p[0] <= cash][-1]
                steps = accounts.walk(orders, pos, cash)
                want = steps[-1] if steps else (pos, 0, False, cash)
                assert (end, cash + gain) == (want[0], want[3])


def test_rich_blocks_have_one_piece_for_cash_above_their_prices():
    rng = random.Random(3)
    orders = [(rng.randint(0, 1), p * 1.001, p * 1.001, p * 0.999)
              for p in (rng.uniform(90, 110) for _ in range(400))]
    pieces = accounts.block_map(orders, 0)
    assert len(pieces) < 2 * len(orders)


def test_run_backtest_goes_on(spark):
    bars, sig = make(spark, {"A": [(0, 10.0, 10.0, "BUY"), (1, 10.0, 10.0, "BUY"), (2, 4.0, 4.0, "SELL"), (3, 5.0, 5.0, None)]})
    held, log, equity = backtest.run_backtest(bars, sig, cash=10.0, on_shortfall="refuse")
    assert [(r.pos, r.refused) for r in held.orderBy("date").collect()] == [(0, False), (0, True), (0, True), (0, False)]
    assert log.count() == 0 and {r.equity for r in equity.collect()} == {10.0}
    held, log, equity = backtest.run_backtest(
        bars, sig, cash=10.0, commission=0.0, on_shortfall="refuse", check_submit=False)
    assert [r.side for r in log.orderBy("date").collect()] == ["BUY", "SELL"]
    last = equity.orderBy("date").collect()[-1]
    assert (last.cash, last.equity, last.run_id) == (5.0, 5.0, "A")


def test_empty(spark):
    bars, sig = make(spark, {"A": [(0, 1.0, 1.0, "BUY")]})
    assert accounts.limited_positions(bars.limit(0), sig).count() == 0
