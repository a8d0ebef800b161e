"""Long / flat backtest of signals on bars, as ordered operators.

A signal decided on one bar is filled at the open of the symbol's next bar, so the position
held during a bar is the side of the last BUY or SELL before it. That makes position, fills,
cash and equity running values of each series instead of an event loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebell.operators.series import BLOCK, Series, blocked, own_rows, running, with_history
from closebell.session import stage

BARS = Series()
CASH = 100_000.0
COMMISSION = 0.001  # share of the traded value
STAKE = 1


def with_signals(bars: DataFrame, signals: DataFrame) -> DataFrame:
    """``symbol, date, open, close`` of every bar and the ``side`` decided on it, or null."""
    sides = signals.select("symbol", "date", "side")
    return bars.select("symbol", "date", "open", "close").join(sides, ["symbol", "date"], "left")


def positions(
    bars: DataFrame, signals: DataFrame | None = None, series: Series = BARS
) -> DataFrame:
    """``symbol, date, open, close, pos, fill`` per bar; pos is 1 (long) or 0 (flat).

    Without ``signals`` the bars have a ``side`` already (see ``with_signals``).

    BUY counts only when flat and SELL only when long, because repeating a side changes
    nothing. ``fill`` is the change of position at this bar's open. Both positions are the last
    target of a frame that ends one or two bars back, so a block needs two values from the
    blocks before it, which travel in one small row.
    """
    target = F.when(F.col("side") == "BUY", 1).when(F.col("side") == "SELL", 0)
    decided = bars if signals is None else with_signals(bars, signals)
    rows = blocked(
        decided.select("symbol", "date", "open", "close", target.alias("_target")), series
    )
    w, last = series.window(), F.last("_target", ignorenulls=True)
    local = rows.select(
        "*", F.row_number().over(w).alias("_n"),
        *[last.over(w.rowsBetween(Window.unboundedPreceding, -back)).alias(f"_back{back}")
          for back in range(3)],
    )
    if series.days is None:
        pos, before = F.col("_back1"), F.col("_back2")
    else:
        # a block's last target, and the same without its last bar
        ends = local.groupBy(*series.parts).agg(
            F.max_by("_back0", series.order_value()).alias("_all"),
            F.max_by("_back1", series.order_value()).alias("_less"),
        )
        in_order = Window.partitionBy(*series.keys).orderBy(BLOCK)
        known = F.last("_all", ignorenulls=True)
        carry = ends.select(
            *series.parts,
            known.over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
            F.coalesce(
                F.lag("_less").over(in_order),
                known.over(in_order.rowsBetween(Window.unboundedPreceding, -2)),
            ).alias("_carry_less"),
        )
        local = local.join(carry, series.parts, "left")
        pos = F.coalesce("_back1", "_carry")
        before = F.when(F.col("_n") == 1, F.col("_carry_less")).otherwise(
            F.coalesce("_back2", "_carry"))
    pos, before = F.coalesce(pos, F.lit(0)), F.coalesce(before, F.lit(0))
    return local.select(
        "symbol", "date", "open", "close", pos.alias("pos"), (pos - before).alias("fill")
    )


def _fill_price(slippage_bps: float) -> Column:
    """The bar's open, moved against the trader."""
    return F.col("open") * (1 + F.signum(F.col("fill")) * (slippage_bps / 10_000))


def trades(
    held: DataFrame,
    stake: float = STAKE,
    commission: float = COMMISSION,
    slippage_bps: float = 0.0,
) -> DataFrame:
    """The fills of ``positions``: side, quantity, price, traded value and commission."""
    value = F.abs("fill") * stake * F.col("price")
    filled = held.where(F.col("fill") != 0).withColumn("price", _fill_price(slippage_bps))
    return filled.select(
        "date", "symbol",
        F.when(F.col("fill") > 0, "BUY").otherwise("SELL").alias("side"),
        (F.abs("fill") * stake).alias("qty"),
        "price",
        value.alias("cost"),
        (value * commission).alias("commission"),
    )


def _flows(
    held: DataFrame, stake: float, commission: float, slippage_bps: float
) -> DataFrame:
    """Adds ``_flow``, the cash moved at the open, and ``_value``, the holding at the close."""
    traded = F.col("fill") * stake * _fill_price(slippage_bps)
    return held.select(
        "*",
        (-traded - F.abs(traded) * commission).alias("_flow"),
        (F.col("pos") * stake * F.col("close")).alias("_value"),
    )


def equity_by_symbol(
    held: DataFrame,
    cash: float = CASH,
    stake: float = STAKE,
    commission: float = COMMISSION,
    slippage_bps: float = 0.0,
    series: Series = BARS,
    on_shortfall: str = "raise",
) -> DataFrame:
    """One account per symbol: ``run_id`` (the symbol), ``date, cash, equity``."""
    rows = running(
        _flows(held, stake, commission, slippage_bps), series, _moved=("sum", "_flow")
    )
    left = F.lit(cash) + F.col("_moved")
    return _funded(
        rows.select(
            F.col("symbol").alias("run_id"), "date", left.alias("cash"),
            (left + F.col("_value")).alias("equity"),
        ),
        on_shortfall,
    )


def equity_portfolio(
    held: DataFrame,
    run_id: str = "portfolio",
    cash: float = CASH,
    stake: float = STAKE,
    commission: float = COMMISSION,
    slippage_bps: float = 0.0,
    series: Series = BARS,
    on_shortfall: str = "raise",
) -> DataFrame:
    """One account over all symbols: ``run_id, date, cash, equity`` per date with any bar.

    Each bar contributes the change of its holding's value since the symbol's previous bar,
    so a symbol without a bar on some date keeps its last value there. Changes are summed
    by date before anything is ordered; no date-by-symbol grid is built.
    """
    flows = _flows(held, stake, commission, slippage_bps).select(
        *series.keys, *series.order, "_flow", "_value"
    )
    before = F.coalesce(F.lag("_value").over(series.window()), F.lit(0.0))
    moves = own_rows(
        with_history(flows, series, 1, ["_value"]).withColumn("_gain", F.col("_value") - before)
    )
    by_date = moves.groupBy("date").agg(
        F.sum("_flow").alias("_flow"), F.sum("_gain").alias("_gain")
    ).withColumn("run_id", F.lit(run_id))
    account = Series(keys=("run_id",), order=("date",), days=series.days)
    total = running(by_date, account, _moved=("sum", "_flow"), _held=("sum", "_gain"))
    left = F.lit(cash) + F.col("_moved")
    return _funded(
        total.select("run_id", "date", left.alias("cash"), (left + F.col("_held")).alias("equity")),
        on_shortfall,
    )


def _funded(equity: DataFrame, on_shortfall: str) -> DataFrame:
    """Orders the account cannot pay would be refused, which these formulas do not model
    (``accounts.limited_positions`` does): fail, or with ``flag`` mark the rows. The check is a
    filter, so it runs whatever columns a reader asks for."""
    short = F.col("cash") < 0
    if on_shortfall == "flag":
        return equity.withColumn("shortfall", short)
    stop = F.raise_error(F.lit("not enough cash for an order; raise cash or lower stake"))
    return equity.where(F.when(short, stop.cast("boolean")).otherwise(F.lit(True)))


def lowest_cash(equity: DataFrame) -> DataFrame:
    return equity.groupBy("run_id").agg(F.min("cash").alias("min_cash"))


def pnl_by_symbol(
    held: DataFrame,
    stake: float = STAKE,
    commission: float = COMMISSION,
    slippage_bps: float = 0.0,
) -> DataFrame:
    """Profit per symbol after commission: cash moved plus the last holding's value."""
    flows = _flows(held, stake, commission, slippage_bps)
    return flows.groupBy("symbol").agg(
        (F.sum("_flow") + F.max_by("_value", "date")).alias("pnl"),
        F.count_if(F.col("fill") != 0).alias("fills"),
    )


def turnover(trade_log: DataFrame, equity: DataFrame) -> DataFrame:
    """Traded value over mean equity per account; accounts without trades have 0.

    ``trade_log`` needs ``run_id``. Both sides are aggregated before they meet.
    """
    traded = trade_log.groupBy("run_id").agg(F.sum("cost").alias("traded"))
    mean = equity.groupBy("run_id").agg(F.avg("equity").alias("mean_equity"))
    return mean.join(traded, "run_id", "left").select(
        "run_id", F.coalesce("traded", F.lit(0.0)).alias("traded"),
        F.try_divide(F.coalesce("traded", F.lit(0.0)), F.col("mean_equity")).alias("turnover"),
    )


def round_trips(trade_log: DataFrame, series: Series = BARS) -> DataFrame:
    """Closed trades: each SELL with the BUY before it and the profit after commission."""
    w = series.window()
    rows = with_history(trade_log, series, 1, ["price", "commission"])
    paired = own_rows(
        rows.select(
            "*",
            F.lag("date").over(w).alias("opened"),
            F.lag("price").over(w).alias("entry"),
            F.lag("commission").over(w).alias("_fee"),
        )
    )
    profit = (
        F.col("qty") * (F.col("price") - F.col("entry")) - F.col("commission") - F.col("_fee")
    )
    return paired.where(F.col("side") == "SELL").select(
        "symbol", "opened", "date", "qty", "entry", F.col("price").alias("exit"),
        profit.alias("profit"),
    )


def scaled_by_success(
    closed: DataFrame, n: int = 20, threshold: float = 0.5, series: Series = BARS
) -> DataFrame:
    """Adds ``p_success``, the share of profitable ones among the ``n`` closed trades before
    this one, and ``scale``: p_success where it reaches ``threshold``, else 0. A symbol's
    first trade has no record and gets null and 1."""
    won = F.when(F.col("profit") > 0, 1.0).otherwise(0.0)
    rows = with_history(closed.withColumn("_won", won), series, n, ["_won"])
    rows = rows.withColumn("p_success", F.avg("_won").over(series.window().rowsBetween(-n, -1)))
    p = F.col("p_success")
    scale = F.when(p.isNull(), 1.0).when(p >= threshold, p).otherwise(0.0)
    return own_rows(rows).drop(BLOCK, "_won").withColumn("scale", scale)


def run_backtest(
    bars: DataFrame,
    signals: DataFrame,
    symbols: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    series: Series = BARS,
    **account,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(positions, trades, equity) for bars with ``start <= date <= end``.

    One account holds all symbols, and one that cannot pay stops the job. With
    ``on_shortfall="refuse"`` every symbol has an account of its own, which refuses such orders and
    goes on. Positions are staged, as they are read more than once.
    """
    if symbols is not None:
        bars = bars.where(F.col("symbol").isin(*symbols))
    if start is not None:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.where(F.col("date") <= F.lit(end).cast("date"))
    fees = {k: v for k, v in account.items() if k in ("stake", "commission", "slippage_bps")}
    if account.get("on_shortfall") == "refuse":
        from closebell.operators import accounts

        limits = {k: v for k, v in account.items() if k in ("cash", "check_submit")}
        held = stage(
            accounts.limited_positions(bars, signals, series=series, **limits, **fees), "positions")
        return held, trades(held, **fees), accounts.limited_equity(held, fees.get("stake", STAKE))
    held = stage(positions(bars, signals, series), "positions")
    return held, trades(held, **fees), equity_portfolio(held, series=series, **account)
