"""Accounts that refuse what they cannot pay, and go on.

With enough cash a position is the last side before it (``backtest.positions``). With little cash the
two depend on each other: whether a BUY is filled depends on the cash left by the fills before
it. A series is still cut into calendar blocks. What a block does to an account that
enters it flat or long with cash c is a piecewise map: c falls into intervals, and inside one the same
orders are filled, so the account leaves with a fixed position and c plus a fixed amount. Maps are found
for all blocks at once; one small pass over a symbol's maps gives the state each block starts
from; then every block is walked by itself.

An interval is split only where cash decides about a BUY, so a block of n bars whose account could
always pay has one. Ranges that lead to the same end are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.operators.backtest import BARS, CASH, COMMISSION, STAKE, with_signals
from closebell.operators.series import BLOCK, Series, own_rows, with_history

Order = tuple[int, float, float, float]  # 1 buy or 0 sell, cash needed, cash paid, cash received
Piece = tuple[float, int, float]  # least cash at the start, position at the end, cash gained


def block_map(orders: Iterable[Order], pos: int) -> list[Piece]:
    """What the orders of a block do to an account that enters with position ``pos``: pieces in
    the order of cash, the first from minus infinity on."""
    pieces: list[Piece] = [(-math.inf, pos, 0.0)]
    for want, need, paid, received in orders:
        after: list[Piece] = []
        for i, (low, held, gain) in enumerate(pieces):
            high = pieces[i + 1][0] if i + 1 < len(pieces) else math.inf
            if want == held:
                parts = [(low, held, gain)]
            elif want == 0:
                parts = [(low, 0, gain + received)]
            else:
                limit = need - gain  # accounts with less at the start are refused
                parts = [(low, 0, gain)] if low < limit else []
                if limit < high:
                    parts.append((max(low, limit), 1, gain - paid))
            for part in parts:
                if not after or after[-1][1:] != part[1:]:
                    after.append(part)
        pieces = after
    return pieces


def walk(orders: Iterable[Order | None], pos: int, cash: float) -> list[tuple[int, int, bool, float]]:
    """Position, fill, whether an order was refused, and cash after each order (or None). Decides by
    the same sums as ``block_map``, so both agree to the last bit."""
    out, gain = [], 0.0
    for order in orders:
        fill, refused = 0, False
        if order is not None and order[0] != pos:
            want, need, paid, received = order
            if want == 0:
                fill, gain = -1, gain + received
            elif cash >= need - gain:
                fill, gain = 1, gain - paid
            else:
                refused = True
            pos += fill
        out.append((pos, fill, refused, cash + gain))
    return out


def _orders(decided: DataFrame, series: Series, stake, commission, slippage_bps, check_submit):
    """Bars with the order that reaches them: the side decided on the symbol's bar before."""
    w = series.window()
    target = F.when(F.col("side") == "BUY", 1).when(F.col("side") == "SELL", 0)
    rows = decided.select("symbol", "date", "open", "close", target.alias("_target"))
    rows = with_history(rows, series, 1, ["close", "_target"]).select(
        "*", F.lag("_target").over(w).alias("_want"), F.lag("close").over(w).alias("_before"))
    slip = slippage_bps / 10_000
    buy, sell = F.col("open") * (1 + slip) * stake, F.col("open") * (1 - slip) * stake
    asked = F.greatest(buy, F.col("_before") * stake) if check_submit else buy
    return own_rows(rows).select(
        "symbol", BLOCK, "date", "open", "close", F.col("_want").alias("want"),
        (asked * (1 + commission)).alias("need"), (buy * (1 + commission)).alias("paid"),
        (sell * (1 - commission)).alias("received"),
    )


def _in_order(rows: pd.DataFrame) -> list[Order | None]:
    return [
        (int(want), need, paid, received) if want == want else None
        for want, need, paid, received in rows[["want", "need", "paid", "received"]]
        .astype("float64").itertuples(index=False)
    ]


def _block_maps(orders: DataFrame) -> DataFrame:
    """``symbol, _block, maps``: for both positions, (position, least cash, end, gain)."""

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        given = [o for o in _in_order(rows.sort_values("date")) if o is not None]
        maps = [{"start": pos, "low": low, "held": held, "gain": gain}
                for pos in (0, 1) for low, held, gain in block_map(given, pos)]
        return pd.DataFrame({"symbol": rows["symbol"].iloc[:1], BLOCK: rows[BLOCK].iloc[:1],
                             "maps": [maps]})

    piece = "struct<start: int, low: double, held: int, gain: double>"
    return orders.groupBy("symbol", BLOCK).applyInPandas(
        summarise, f"symbol string, {BLOCK} bigint, maps array<{piece}>")


def _start_states(orders: DataFrame, cash: float) -> DataFrame:
    """``symbol, _block, _pos, _cash`` each block starts from: a symbol's maps, one per block, applied
    one after the other."""

    def step(state, block):
        # of the pieces for this position that the cash reaches, the highest
        piece = F.array_max(F.filter(
            block["maps"], lambda m: (m["start"] == state["pos"]) & (m["low"] <= state["cash"])))
        here = F.struct(block[BLOCK].alias(BLOCK), state["pos"].alias("_pos"), state["cash"].alias("_cash"))
        return F.struct(
            piece["held"].alias("pos"), (state["cash"] + piece["gain"]).alias("cash"),
            F.array_append(state["walked"], here).alias("walked"))

    start = F.struct(
        F.lit(0).alias("pos"), F.lit(float(cash)).alias("cash"),
        F.array().cast(f"array<struct<{BLOCK}: bigint, _pos: int, _cash: double>>").alias("walked"))
    maps = _block_maps(orders).groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, "maps"))).alias("_blocks"))
    walked = F.aggregate("_blocks", start, step)
    ends = maps.select("symbol", walked.alias("_end"))
    return ends.select("symbol", F.explode("_end.walked").alias("_s")).select("symbol", "_s.*")


def limited_positions(
    bars: DataFrame,
    signals: DataFrame | None = None,
    cash: float = CASH,
    stake: float = STAKE,
    commission: float = COMMISSION,
    slippage_bps: float = 0.0,
    series: Series = BARS,
    check_submit: bool = True,
) -> DataFrame:
    """``symbol, date, open, close, pos, fill, refused, cash`` per bar, one account per symbol.

    As ``backtest.positions``, but a BUY the account cannot pay is refused: it stays flat and the
    order is gone; a later BUY tries again. What must be there is the price with commission at the
    fill and, with ``check_submit``, at the close the order was placed at. Without ``signals`` the
    bars have a ``side``. ``backtest.trades`` and ``pnl_by_symbol`` take the result as it is.
    """
    decided = bars if signals is None else with_signals(bars, signals)
    orders = _orders(decided, series, stake, commission, slippage_bps, check_submit)

    def replay(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("date")
        walked = walk(_in_order(rows), int(rows["_pos"].iloc[0]), float(rows["_cash"].iloc[0]))
        pos, fill, refused, left = zip(*walked)
        return pd.DataFrame({
            "symbol": rows["symbol"], "date": rows["date"], "open": rows["open"],
            "close": rows["close"], "pos": pos, "fill": fill, "refused": refused, "cash": left})

    started = orders.join(_start_states(orders, cash), ["symbol", BLOCK])
    return started.groupBy("symbol", BLOCK).applyInPandas(
        replay, "symbol string, date date, open double, close double, pos int, fill int, "
        "refused boolean, cash double")


def limited_equity(held: DataFrame, stake: float = STAKE) -> DataFrame:
    """``run_id`` (the symbol), ``date, cash, equity`` of ``limited_positions``."""
    return held.select(
        F.col("symbol").alias("run_id"), "date", "cash",
        (F.col("cash") + F.col("pos") * stake * F.col("close")).alias("equity"))
