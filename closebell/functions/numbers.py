"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_missing(value: Column) -> Column:
    """Null and NaN to 0. NaN first: it compares above every number, so a NaN score
    would otherwise pass any ``score > threshold`` test."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def null_if_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def fixed2(value: Column) -> Column:
    """Two decimals, rounding the exact binary value with ties to even.

    ``format_string`` rounds the shortest decimal text half up instead (1.005 -> 1.01,
    although that double lies below 1.005). The two differ only when the shortest text ends
    in 5 at the third decimal, i.e. value == k / 1000 with k ending in 5. There, the sign of
    value * 1000 - k is computed without rounding error by splitting value into a float and
    a remainder, and the next lower or higher cent is chosen. Exact below 8e12.
    """
    size = F.abs(value)
    k = F.round(size * 1000.0)
    tie = (k % 10 == 5) & (k / 1000.0 == size) & (size < 8e12)
    high = size.cast("float").cast("double")
    excess = (high * 1000.0 - k) + (size - high) * 1000.0
    lower = F.floor(k / 10)
    cents = lower + F.when(excess > 0, 1).when(excess < 0, 0).otherwise(lower % 2)
    sign = F.when(value < 0, -1.0).otherwise(1.0)
    return F.format_string("%.2f", F.when(tie, sign * cents / 100.0).otherwise(value))


def fixed4(value: Column) -> Column:
    return F.format_string("%.4f", value)


def softmax(logits: Sequence[Column]) -> list[Column]:
    """Probabilities of a row of logits; the maximum is subtracted so exp() cannot overflow."""
    top = F.greatest(*logits)
    weights = [F.exp(x - top) for x in logits]
    total = reduce(add, weights)
    return [w / total for w in weights]


def sentiment_scores(logits: Column, labels: Sequence[str]) -> tuple[Column, Column]:
    """(news_sent, news_conf) = (p_positive - p_negative, p_positive + p_negative).

    ``labels`` names the entries of the ``logits`` array; their order depends on the model.
    """
    values = [F.element_at(logits, i + 1).cast("double") for i in range(len(labels))]
    p = dict(zip(labels, softmax(values)))
    return p["positive"] - p["negative"], p["positive"] + p["negative"]
