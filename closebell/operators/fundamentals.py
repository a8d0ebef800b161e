"""Quarterly statements: keyed merge, and the values known at a decision date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebell.operators.series import Series, running
from closebell.schemas import (
    BALANCE_FIELDS,
    CASHFLOW_FIELDS,
    FUNDAMENTALS,
    INCOME_FIELDS,
    STATEMENT_FIELDS,
)


def merged(income: DataFrame, balance: DataFrame, cashflow: DataFrame) -> DataFrame:
    """One row per (symbol, date) that occurs in any statement.

    Each input has its fields plus ``symbol, date, pos``. Of several items for a date in one
    statement the one with the highest ``pos`` counts, nulls included. Union and a single
    aggregation: every field takes the value at its own statement's highest position.
    """
    parts = [(income, INCOME_FIELDS), (balance, BALANCE_FIELDS), (cashflow, CASHFLOW_FIELDS)]
    tagged = [
        df.where(F.col("date").isNotNull()).select(
            "symbol", "date", *fields, F.col("pos").alias(f"_pos{i}")
        )
        for i, (df, fields) in enumerate(parts)
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    latest = [
        F.max_by(field, f"_pos{i}").alias(field)
        for i, (_, fields) in enumerate(parts)
        for field in fields
    ]
    return union.groupBy("symbol", "date").agg(*latest).select(*FUNDAMENTALS.fieldNames())


def as_of(
    decisions: DataFrame, facts: DataFrame, series: Series | None = None
) -> DataFrame:
    """Each (symbol, date) of ``decisions`` with the latest facts dated on or before it.

    Forward only: facts and decisions are merged into one ordered series (facts first on
    equal dates) and the last fact is carried along; ``fact_date`` tells which it is.
    """
    series = series or Series(order=("date", "_rank"))
    known = facts.select(
        "symbol", "date", F.lit(0).alias("_rank"),
        F.struct(F.col("date").alias("fact_date"), *STATEMENT_FIELDS).alias("_fact"),
    )
    asked = decisions.select("symbol", "date", F.lit(1).alias("_rank"))
    merged_rows = asked.unionByName(known, allowMissingColumns=True)
    carried = running(merged_rows, series, _known=("last", "_fact"))
    return carried.where(F.col("_rank") == 1).select("symbol", "date", "_known.*")
