"""Performance of equity curves, drawdown breaker, run selection, walk-forward folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebell.functions.numbers import fixed4
from closebell.functions.text import metric_label
from closebell.operators.series import Series, blocked, running

RUNS = Series(keys=("run_id",))
TRADING_DAYS = 252  # fixed value: trading days per year
METRIC_NAMES = ("total_return", "annualized_volatility", "sharpe_ratio", "max_drawdown")


def drawdowns(equity: DataFrame, series: Series = RUNS) -> DataFrame:
    """Adds ``peak``, the highest equity so far, and ``drawdown`` = equity / peak - 1."""
    rows = running(equity.select("run_id", "date", "equity"), series, peak=("max", "equity"))
    return rows.select(
        "run_id", "date", "equity", "peak",
        (F.try_divide(F.col("equity"), F.col("peak")) - 1).alias("drawdown"),
    )


def breaker(equity: DataFrame, limit: float = -0.1, series: Series = RUNS) -> DataFrame:
    """Drawdowns with ``tripped``: true where the loss from the peak goes beyond ``limit``."""
    return drawdowns(equity, series).withColumn("tripped", F.col("drawdown") < limit)


def performance(equity: DataFrame, series: Series = RUNS) -> DataFrame:
    """One row of metrics per ``run_id``; runs with fewer than two points have all zeros.

    With exactly two points there is one return, whose deviation is undefined: volatility
    and Sharpe ratio are null then. Sharpe is 0 when the deviation is 0.
    """
    rows = blocked(equity.select("run_id", "date", "equity"), series)
    local = rows.select(
        "*", F.lag("equity").over(series.window()).alias("_before"),
        F.max("equity").over(series.so_far()).alias("_peak"),
    )
    if series.days is not None:
        # what a block needs from earlier ones: their last point and their highest
        ends = rows.groupBy(*series.parts).agg(
            F.max_by("equity", "date").alias("_last"), F.max("equity").alias("_high")
        )
        earlier = series.earlier_blocks()
        carry = ends.select(
            *series.parts, F.last("_last").over(earlier).alias("_last"),
            F.max("_high").over(earlier).alias("_high"),
        )
        local = local.join(carry, series.parts, "left").withColumns({
            "_before": F.coalesce("_before", "_last"),
            "_peak": F.greatest("_peak", "_high"),
        })
    rows = local.withColumn("_ret", F.try_divide(F.col("equity"), F.col("_before")) - 1)
    drawdown = F.try_divide(F.col("equity"), F.col("_peak")) - 1
    total = F.try_divide(F.max_by("equity", "date"), F.min_by("equity", "date")) - 1
    stats = rows.groupBy("run_id").agg(
        F.count("*").alias("_n"),
        total.alias("_total"),
        F.avg("_ret").alias("_mean"),
        F.stddev_samp("_ret").alias("_std"),
        F.min(drawdown).alias("_worst"),
    )
    year = F.sqrt(F.lit(float(TRADING_DAYS)))
    sharpe = F.when(F.col("_std") == 0, 0.0).otherwise(F.col("_mean") / F.col("_std") * year)
    values = [F.col("_total"), F.col("_std") * year, sharpe, F.col("_worst")]
    return stats.select(
        "run_id",
        *[F.when(F.col("_n") < 2, 0.0).otherwise(v).alias(name)
          for name, v in zip(METRIC_NAMES, values)],
    )


def _month_summaries(equity: DataFrame) -> DataFrame:
    """One row per (run, month): points, first and last equity, moments of the returns inside the
    month, highest and lowest equity, and the worst drawdown from a peak inside the month."""
    month = F.to_date(F.date_trunc("month", "date")).alias("month")
    rows = equity.where(F.col("run_id").isNotNull() & F.col("date").isNotNull()).select(
        "run_id", month, "date", "equity")
    by_date = Window.partitionBy("run_id", "month").orderBy("date")  # at most 31 rows
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("equity").over(by_date)
    points = rows.select(
        "*", (F.try_divide(F.col("equity"), before) - 1).alias("_ret"),
        (F.try_divide(F.col("equity"), F.max("equity").over(so_far)) - 1).alias("_down"))
    return points.groupBy("run_id", "month").agg(
        F.count("*").alias("n"), F.min_by("equity", "date").alias("first"),
        F.max_by("equity", "date").alias("last"), F.count("_ret").alias("returns"),
        F.sum("_ret").alias("sum"), F.var_pop("_ret").alias("spread"),
        F.max("equity").alias("high"), F.min("equity").alias("low"), F.min("_down").alias("worst"))


def fold_metrics(equity: DataFrame, min_train_months: int = 12) -> DataFrame:
    """``run_id, fold, part, test_start, rows`` and the four metrics of every walk-forward fold.

    A run's fold is a month with points after its first ``min_train_months`` months; part ``test`` is
    that month alone, part ``train`` everything before it. Each equals ``performance`` of those rows.

    Curves are read once, for one summary per month. Summaries merge: moments of returns add up
    (the return from one month to the next joins them), and the worst drawdown of two stretches is
    the least of theirs and of the later one's lowest point against the earlier one's peak. So train
    metrics are running values over a run's months, and no row is read once per fold.
    """
    months = _month_summaries(equity)
    by_month = Window.partitionBy("run_id").orderBy("month")  # months of a run: the calendar
    earlier = by_month.rowsBetween(Window.unboundedPreceding, -1)
    step = F.try_divide(F.col("first"), F.lag("last").over(by_month)) - 1
    from_peak = F.try_divide(F.col("low"), F.max("high").over(earlier)) - 1
    rows = months.select(
        "*", F.row_number().over(by_month).alias("_month"), step.alias("_step"),
        F.least("worst", from_peak).alias("_worst"))
    rows = rows.withColumns({
        # sums of squares about zero of a month's returns and the one that leads into it
        "_count": F.col("returns") + F.col("_step").isNotNull().cast("int"),
        "_sum": F.coalesce("sum", F.lit(0.0)) + F.coalesce("_step", F.lit(0.0)),
        "_inner": F.coalesce(F.col("returns") * F.col("spread"), F.lit(0.0)),
        "_between": F.coalesce(F.try_divide(F.col("sum") * F.col("sum"), F.col("returns")), F.lit(0.0))
        + F.coalesce(F.col("_step") * F.col("_step"), F.lit(0.0)),
    })
    train = {
        "n": F.sum("n"), "first": F.first("first"), "last": F.last("last"),
        "count": F.sum("_count"), "sum": F.sum("_sum"), "inner": F.sum("_inner"),
        "between": F.sum("_between"), "worst": F.min("_worst"),
    }
    test = {
        "n": F.col("n"), "first": F.col("first"), "last": F.col("last"), "count": F.col("returns"),
        "sum": F.coalesce("sum", F.lit(0.0)), "inner": F.col("_inner"),
        "between": F.coalesce(
            F.try_divide(F.col("sum") * F.col("sum"), F.col("returns")), F.lit(0.0)),
        "worst": F.col("worst"),
    }
    parts = rows.select(
        "run_id", (F.col("_month") - min_train_months).alias("fold"),
        F.col("month").alias("test_start"),
        F.struct(F.lit("train").alias("part"), *[a.over(earlier).alias(k) for k, a in train.items()])
        .alias("a"),
        F.struct(F.lit("test").alias("part"), *[v.alias(k) for k, v in test.items()]).alias("b"),
    ).where("fold > 0").select("run_id", "fold", "test_start", F.explode(F.array("a", "b")).alias("p"))
    mean = F.try_divide(F.col("p.sum"), F.col("p.count"))
    about_mean = F.col("p.inner") + F.greatest(
        F.col("p.between") - F.col("p.sum") * mean, F.lit(0.0))
    std = F.when(F.col("p.count") > 1, F.sqrt(about_mean / (F.col("p.count") - 1)))
    year = F.sqrt(F.lit(float(TRADING_DAYS)))
    found = [
        F.try_divide(F.col("p.last"), F.col("p.first")) - 1, std * year,
        F.when(std == 0, 0.0).otherwise(mean / std * year), F.col("p.worst")]
    return parts.select(
        "run_id", "fold", "p.part", "test_start", F.col("p.n").alias("rows"),
        *[F.when(F.col("p.n") < 2, 0.0).otherwise(v).alias(name)
          for name, v in zip(METRIC_NAMES, found)])


def latest_run(runs: DataFrame) -> DataFrame:
    """The finished run with metrics that started last."""
    done = runs.where(F.col("total_return").isNotNull() & (F.col("status") == "FINISHED"))
    return done.orderBy(F.desc("start_time"), "run_id").limit(1)


def labelled(metrics: DataFrame) -> DataFrame:
    """Metrics as ``run_id, label, value`` text lines for a report."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f"metrics.{m}").alias("name"), F.col(m).alias("value"))
                  for m in METRIC_NAMES])
    )
    return metrics.select("run_id", pairs.alias("m")).select(
        "run_id", metric_label(F.col("m.name")).alias("label"), fixed4(F.col("m.value")).alias("value")
    )


def walk_forward(df: DataFrame, min_train_months: int = 12) -> DataFrame:
    """Calendar-month hold-outs: one row per fold with bounds and row counts.

    Fold months are those with data after the first ``min_train_months`` months; a fold
    trains on everything before its month. Rows are counted per month first, so the fold
    table comes from one row per month; ``fold_rows`` cuts a fold out by date.
    """
    monthly = df.groupBy(F.to_date(F.date_trunc("month", "date")).alias("test_start")).agg(
        F.count("*").alias("test_rows"), F.min("date").alias("first_date")
    )
    monthly = monthly.withColumn("_one_group_of_months", F.lit(1))
    series = Series(keys=("_one_group_of_months",), order=("test_start",), days=None)  # one row per month
    w = series.window()
    rows = running(monthly, series, _total=("sum", "test_rows"))
    rows = rows.select(
        "*",
        F.min("first_date").over(series.so_far()).alias("train_start"),
        F.row_number().over(w).alias("_month"),
    )
    return rows.where(F.col("_month") > min_train_months).select(
        (F.col("_month") - min_train_months).alias("fold"),
        "train_start",
        "test_start",
        F.add_months("test_start", 1).alias("test_end"),
        (F.col("_total") - F.col("test_rows")).alias("train_rows"),
        "test_rows",
    )


def fold_rows(df: DataFrame, test_start: str, test_end: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows before ``test_start``, and rows from it up to ``test_end``."""
    start, end = F.lit(test_start).cast("date"), F.lit(test_end).cast("date")
    return df.where(F.col("date") < start), df.where(
        (F.col("date") >= start) & (F.col("date") < end)
    )
