"""Ordered operators over many time series, safe for series of any length.

A plain ``Window.partitionBy("symbol")`` puts a whole symbol into one task. Here a
series is cut into calendar blocks, the window runs per (key, block), and what a block
needs from earlier ones travels separately as one small row per block:

* ``with_history``  bounded look-back: the last ``k`` rows before a block are added to it
* ``running``       running sum / max / last value: block totals are carried forward
* ``ewm``           exponential average: one coefficient per block is carried forward

The order key is unique per series and starts with a date, so a block holds at most
``days`` dates and a series has at most (calendar length / ``days``) block rows: the
per-series step over block rows is bounded by the calendar, not by the data.

``Series(days=None)`` keeps each series whole: one Exchange and no carry join. Use it
when series are known to be short.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = "_block"
PAST = "_past"  # true for rows copied in from earlier blocks

_LOG_LIMIT = 600.0  # exp() overflows near 709; the rest is room for the values


@dataclass(frozen=True)
class Series:
    """Which columns identify a series, how it is ordered, and the block length."""

    keys: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("date",)
    days: int | None = 512

    @property
    def parts(self) -> list[str]:
        return [*self.keys, BLOCK]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    def so_far(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def from_here(self) -> WindowSpec:
        """The same frame read backwards: this row and those after it, the last one first."""
        backwards = Window.partitionBy(*self.parts).orderBy(*[F.desc(c) for c in self.order])
        return backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def earlier_blocks(self, most: int | None = None) -> WindowSpec:
        start = Window.unboundedPreceding if most is None else -most
        return Window.partitionBy(*self.keys).orderBy(BLOCK).rowsBetween(start, -1)

    def later_blocks(self) -> WindowSpec:
        """All later blocks, the last one first."""
        return Window.partitionBy(*self.keys).orderBy(F.desc(BLOCK)).rowsBetween(
            Window.unboundedPreceding, -1)

    def order_value(self) -> Column:
        return F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)


def unkeyed(df: DataFrame, series: Series) -> DataFrame:
    """The rows without a key, which the operators below leave out: they belong to no series.
    Lake tables have none, as their writers refuse them; other callers may list them here."""
    return df.where(reduce(or_, [F.col(k).isNull() for k in series.keys]))


def blocked(df: DataFrame, series: Series) -> DataFrame:
    """Add the block number. Rows without a key belong to no series and are left out
    (``unkeyed`` has them).

    The explicit filter also keeps the branches below alike: a join would add it to one
    of them only, and Spark could not share their common shuffle any more.
    """
    if BLOCK in df.columns:
        return df
    keyed = df.where(reduce(and_, [F.col(k).isNotNull() for k in series.keys]))
    if series.days is None:
        return keyed.withColumn(BLOCK, F.lit(0).cast("bigint"))
    day = F.unix_date(F.col(series.order[0]).cast("date"))
    return keyed.withColumn(BLOCK, F.floor(day / F.lit(series.days)))


def with_history(df: DataFrame, series: Series, k: int, columns: list[str]) -> DataFrame:
    """Add to every block the ``k`` rows that precede it, marked ``_past``.

    Any window over ``series.window()`` that looks back at most ``k`` rows and reads only
    ``columns`` is then exact for the block's own rows; filter ``~_past`` afterwards.
    """
    rows = blocked(df, series)
    own = rows.withColumn(PAST, F.lit(False))
    if series.days is None:
        return own
    carried = [c for c in columns if c not in series.order]
    tails = _tails(rows, series, k, carried)
    # every block has at least one row, so the last k rows lie in the last k blocks
    before = F.flatten(F.collect_list("_tail").over(series.earlier_blocks(k)))
    past = (
        tails.select(*series.parts, before.alias("_before"))
        .select(
            *series.parts,
            F.explode(
                F.slice("_before", F.greatest(F.size("_before") - k, F.lit(0)) + 1, F.lit(k))
            ).alias("_row"),
        )
        .select(*series.parts, "_row.*", F.lit(True).alias(PAST))
    )
    return own.unionByName(past, allowMissingColumns=True)


def _tails(rows: DataFrame, series: Series, k: int, columns: list[str]) -> DataFrame:
    """The last ``k`` rows of every block as an array ``_tail``, oldest first.

    Both forms reduce rows before the shuffle: a hash aggregation for the last row alone,
    a group limit otherwise.
    """
    if k == 1 and len(series.order) == 1:
        at = series.order[0]
        last = F.struct(F.max(at).alias(at), *[F.max_by(c, at).alias(c) for c in columns])
        return rows.groupBy(*series.parts).agg(F.array(last).alias("_tail"))
    newest_first = Window.partitionBy(*series.parts).orderBy(*[F.desc(c) for c in series.order])
    return (
        rows.select(*series.parts, *series.order, *columns)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= k)
        .groupBy(*series.parts)
        .agg(F.sort_array(F.collect_list(F.struct(*series.order, *columns))).alias("_tail"))
    )


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the rows ``with_history`` added."""
    return df.where(~F.col(PAST)).drop(PAST)


# kind -> (aggregate over rows or blocks, carry merged into the block's own running value)
_RUNNING = {
    "sum": (lambda c, _: F.sum(c), lambda own, carry: F.coalesce(own + carry, own, carry)),
    "max": (lambda c, _: F.max(c), lambda own, carry: F.greatest(own, carry)),
    "product": (lambda c, _: F.product(c), lambda own, carry: F.coalesce(own * carry, own, carry)),
    "last": (
        lambda c, order: F.max_by(c, F.when(F.col(c).isNotNull(), order)),
        lambda own, carry: F.coalesce(own, carry),
    ),
}


# Read backwards, the last value so far is the earliest one of a block.
_FIRST = (lambda c, order: F.min_by(c, F.when(F.col(c).isNotNull(), order)), _RUNNING["last"][1])


def running(
    df: DataFrame, series: Series, backwards: bool = False, **specs: tuple[str, str]
) -> DataFrame:
    """Add running values from the start of each series up to the current row.

    ``out=(kind, column)`` with kind ``sum``, ``max``, ``product`` or ``last`` (last non-null
    value). ``backwards``, they run from the end of each series down to the current row.
    """
    rows = blocked(df, series)
    frame = series.from_here() if backwards else series.so_far()
    by_block = {**_RUNNING, "last": _FIRST} if backwards else _RUNNING
    over_rows = {
        out: F.last(col, ignorenulls=True) if kind == "last" else _RUNNING[kind][0](col, None)
        for out, (kind, col) in specs.items()
    }
    local = rows.select("*", *[agg.over(frame).alias(out) for out, agg in over_rows.items()])
    if series.days is None:
        return local

    ends = rows.groupBy(*series.parts).agg(
        *[by_block[kind][0](col, series.order_value()).alias(out)
          for out, (kind, col) in specs.items()]
    )
    earlier = series.later_blocks() if backwards else series.earlier_blocks()
    over_blocks = {
        out: F.last(out, ignorenulls=True) if kind == "last" else _RUNNING[kind][0](out, None)
        for out, (kind, _) in specs.items()
    }
    carry = ends.select(
        *series.parts, *[agg.over(earlier).alias(f"_c_{out}") for out, agg in over_blocks.items()]
    )
    merged = [
        _RUNNING[kind][1](F.col(out), F.col(f"_c_{out}")).alias(out)
        for out, (kind, _) in specs.items()
    ]
    return local.join(carry, series.parts, "left").select(*rows.columns, *merged)


def ewm(
    df: DataFrame, series: Series, seeds: DataFrame | None = None, **specs: tuple[str, float]
) -> DataFrame:
    """Add exponentially weighted averages ``out=(column, alpha)``, seeded with the first value.

    avg_0 = x_0, avg_t = alpha * x_t + (1 - alpha) * avg_{t-1}, over non-null values only;
    rows whose value is null get null. Writing b = 1 - alpha and n for the values seen so
    far in the block, avg = b^n * (sum(alpha * x_i * b^-i) + carry), where carry is the
    average at the end of the previous block, or x_0 at the start of the series.

    ``seeds`` (the keys, and a column for each ``out``) continues series whose earlier rows are
    not in ``df``: their first block starts from the seed, where it is not null.
    """
    if seeds is not None and series.days is None:
        raise ValueError("a continued series needs blocks")
    rates = {out: -math.log(1.0 - alpha) for out, (_, alpha) in specs.items()}
    if series.days is not None and series.days * max(rates.values()) > _LOG_LIMIT:
        raise ValueError(f"blocks of {series.days} days are too long for {specs}")
    rows = blocked(df, series)
    frame = series.so_far()

    counted = rows.select(
        "*",
        *[F.count(col).over(frame).alias(f"_n_{out}") for out, (col, _) in specs.items()],
        *[F.first(col, ignorenulls=True).over(frame).alias(f"_x0_{out}")
          for out, (col, _) in specs.items()],
    )

    def grown(out: str) -> Column:
        (col, alpha), power = specs[out], F.col(f"_n_{out}") * rates[out]
        too_long = F.raise_error(F.lit("series too long for one block: set Series(days=...)"))
        return F.when(power > _LOG_LIMIT, too_long.cast("double")).otherwise(
            alpha * F.col(col) * F.exp(power)
        )

    scaled = counted.select("*", *[grown(out).alias(f"_g_{out}") for out in specs])
    local = scaled.select(
        "*", *[F.sum(f"_g_{out}").over(frame).alias(f"_s_{out}") for out in specs]
    )

    def averages(carry: str) -> list[Column]:
        """``carry`` is the prefix of the columns a block starts from."""
        return [
            F.when(
                F.col(col).isNotNull(),
                F.exp(-rates[out] * F.col(f"_n_{out}"))
                * (F.coalesce(f"_s_{out}", F.lit(0.0)) + F.col(f"{carry}{out}")),
            ).alias(out)
            for out, (col, _) in specs.items()
        ]

    if series.days is None:
        return local.select(*rows.columns, *averages("_x0_"))

    ends = scaled.groupBy(*series.parts).agg(
        *[agg.alias(f"_{tag}_{out}")
          for out in specs
          for tag, agg in (
              ("n", F.max(f"_n_{out}")),
              ("s", F.sum(f"_g_{out}")),
              ("x0", F.max(F.when(F.col(f"_n_{out}") == 1, F.col(f"_x0_{out}")))),
          )]
    )
    carry = _carried_averages(ends, series, rates, seeds)
    return local.join(carry, series.parts, "left").select(*rows.columns, *averages("_c_"))


def _carried_averages(
    ends: DataFrame, series: Series, rates: dict[str, float], seeds: DataFrame | None = None
) -> DataFrame:
    """Per block, the averages it starts from. Walks the block rows of each series."""
    fields = ", ".join(f"_c_{out}: double" for out in rates)
    walked_type = f"array<struct<{BLOCK}: bigint, {fields}>>"

    def step(state: Column, block: Column) -> Column:
        before = {out: F.coalesce(state[out], block[f"_x0_{out}"]) for out in rates}
        after = [
            F.when(block[f"_n_{out}"] > 0,
                   F.exp(-rate * block[f"_n_{out}"]) * (block[f"_s_{out}"] + before[out]))
            .otherwise(state[out]).alias(out)
            for out, rate in rates.items()
        ]
        here = F.struct(block[BLOCK].alias(BLOCK), *[before[o].alias(f"_c_{o}") for o in rates])
        return F.struct(*after, F.array_append(state["walked"], here).alias("walked"))

    none = F.lit(None).cast("double")
    start = F.struct(
        *[(none if seeds is None else F.col(f"_seed_{out}")).alias(out) for out in rates],
        F.array().cast(walked_type).alias("walked"),
    )
    columns = [BLOCK, *[f"_{tag}_{out}" for out in rates for tag in ("n", "s", "x0")]]
    blocks = ends.groupBy(*series.keys).agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("_blocks"))
    if seeds is not None:
        blocks = blocks.join(
            seeds.select(*series.keys, *[F.col(out).alias(f"_seed_{out}") for out in rates]),
            list(series.keys), "left")
    return (
        blocks.select(*series.keys, F.explode(F.aggregate("_blocks", start, step)["walked"]).alias("_b"))
        .select(*series.keys, "_b.*")
    )
