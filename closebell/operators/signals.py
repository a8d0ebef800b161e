"""Alpha, BUY / SELL / HOLD rule with rationale, and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebell.functions.numbers import fixed2, zero_if_missing
from closebell.operators.sentiment import zscored

# Rationale texts, with alpha, sentiment and return at two decimals.
BUY_REASON = (
    "Strong buy signal (alpha=%s) based on positive news sentiment (%s) "
    "and positive momentum (20D return=%s)."
)
SELL_REASON = (
    "Strong sell signal (alpha=%s) based on negative news sentiment (%s) "
    "and negative momentum (20D return=%s)."
)
HOLD_REASON = (
    "Hold signal (alpha=%s) due to mixed or neutral signals "
    "(news sentiment=%s, 20D return=%s)."
)


def side_of(alpha: Column, min_alpha_buy: float, max_alpha_sell: float) -> Column:
    """Strictly above or below the thresholds; anything else holds."""
    return (
        F.when(alpha > min_alpha_buy, "BUY").when(alpha < max_alpha_sell, "SELL").otherwise("HOLD")
    )


def decide(
    features: DataFrame,
    min_alpha_buy: float = 0.5,
    max_alpha_sell: float = -0.5,
    zscore: bool = False,
) -> DataFrame:
    """``date, symbol, alpha, reason, side, conf`` from r20 and news_sent.

    alpha is the mean of the two, missing or NaN values counting as 0; conf is its size.
    """
    rows = zscored(features) if zscore else features
    rows = rows.select(
        "date", "symbol",
        zero_if_missing(F.col("news_sent")).alias("news_sent"),
        zero_if_missing(F.col("r20")).alias("r20"),
    )
    rows = rows.withColumn("alpha", (F.col("news_sent") + F.col("r20")) / 2)
    side = side_of(F.col("alpha"), min_alpha_buy, max_alpha_sell)
    numbers = [fixed2(F.col(c)) for c in ("alpha", "news_sent", "r20")]
    reason = (
        F.when(F.col("side") == "BUY", F.lit(BUY_REASON))
        .when(F.col("side") == "SELL", F.lit(SELL_REASON))
        .otherwise(F.lit(HOLD_REASON))
    )
    return rows.withColumn("side", side).select(
        "date", "symbol", "alpha",
        F.call_function("format_string", reason, *numbers).alias("reason"),
        "side", F.abs("alpha").alias("conf"),
    )


def with_sides(
    rows: DataFrame, min_alpha_buy: float = 0.5, max_alpha_sell: float = -0.5
) -> DataFrame:
    """Adds the ``side`` of ``decide`` to bars with r20 and news_sent; null where r20 is."""
    alpha = (zero_if_missing(F.col("news_sent")) + zero_if_missing(F.col("r20"))) / 2
    side = side_of(alpha, min_alpha_buy, max_alpha_sell)
    return rows.withColumn("side", F.when(F.col("r20").isNotNull(), side))


def checked_side(side: Column) -> Column:
    """Upper-cased BUY or SELL; any other value fails the job."""
    upper = F.upper(side)
    wrong = F.raise_error(F.concat(F.lit("side must be BUY or SELL: "), F.coalesce(side, F.lit("null"))))
    return F.when(upper.isin("BUY", "SELL"), upper).otherwise(wrong.cast("string"))


def split_by_side(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) orders; valid ones have their side in upper case."""
    upper = F.upper("side")
    ok = F.coalesce(upper.isin("BUY", "SELL"), F.lit(False))
    valid = orders.where(ok).withColumn("side", upper)
    return valid, orders.where(~ok)


def to_orders(signals: DataFrame, qty: int = 1) -> DataFrame:
    """Signals to act on, with a whole quantity; HOLD rows give no order."""
    return signals.where(F.col("side").isin("BUY", "SELL")).select(
        "date", "symbol", "side", F.lit(qty).cast("int").alias("qty"), "reason", "conf"
    )
