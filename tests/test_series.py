"""Block scans against plain pandas, on series with gaps, nulls and very uneven lengths."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from closebell.operators.series import Series, ewm, own_rows, running, with_history

LENGTHS = {"LONG": 3000, "MID": 700, "GAPS": 60, "ONE": 1}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    rows = []
    for symbol, n in LENGTHS.items():
        step = 200 if symbol == "GAPS" else 1  # several empty blocks between rows
        day = dt.date(1965, 1, 1)
        for _ in range(n):
            value = None if rng.random() < 0.05 else float(rng.normal(100, 20))
            flag = int(rng.integers(0, 2)) if rng.random() < 0.1 else None
            rows.append((symbol, day, value, flag))
            day += dt.timedelta(days=int(rng.integers(1, 1 + 2 * step)))
    return pd.DataFrame(rows, columns=["symbol", "date", "x", "flag"]).astype({"flag": "Int64"})


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [
        (r.symbol, r.date, None if pd.isna(r.x) else float(r.x), None if pd.isna(r.flag) else int(r.flag))
        for r in frame.itertuples()
    ]
    return spark.createDataFrame(rows, "symbol string, date date, x double, flag int").repartition(5)


@pytest.fixture(params=[512, 64, None], ids=["512d", "64d", "whole"])
def series(request):
    return Series(days=request.param)


def _sorted(df):
    return df.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)


def test_history_makes_lags_exact(df, frame, series):
    w = series.window()
    rows = with_history(df, series, 20, ["x"]).select(
        "*", F.lag("x", 1).over(w).alias("l1"), F.lag("x", 20).over(w).alias("l20"),
        F.count("x").over(w.rowsBetween(-19, 0)).alias("n"),
    )
    got = _sorted(own_rows(rows).select("symbol", "date", "l1", "l20", "n"))
    want = frame.sort_values(["symbol", "date"]).reset_index(drop=True)
    by = want.groupby("symbol")["x"]
    assert len(got) == len(want)
    np.testing.assert_array_equal(got["l1"], by.shift(1))
    np.testing.assert_array_equal(got["l20"], by.shift(20))
    n = by.transform(lambda s: s.notna().rolling(20, min_periods=1).sum())
    np.testing.assert_array_equal(got["n"], n)


def test_history_of_one_row(df, frame, series):
    rows = with_history(df, series, 1, ["x", "flag"])
    w = series.window()
    got = _sorted(own_rows(rows.select(
        "*", F.lag("x").over(w).alias("lx"), F.lag("date").over(w).alias("ld"))))
    by = frame.sort_values(["symbol", "date"]).reset_index(drop=True).groupby("symbol")
    np.testing.assert_array_equal(got["lx"], by["x"].shift(1))
    assert [d for d in got["ld"] if d is not None] == [d for d in by["date"].shift(1) if not pd.isna(d)]


def test_running(df, frame, series):
    got = _sorted(running(df, series, s=("sum", "x"), m=("max", "x"), f=("last", "flag")))
    want = frame.sort_values(["symbol", "date"]).reset_index(drop=True)
    by = want.groupby("symbol")
    sums = by["x"].transform(lambda s: s.fillna(0).cumsum().where(s.notna().cumsum() > 0))
    np.testing.assert_allclose(got["s"], sums, rtol=1e-12)
    np.testing.assert_array_equal(got["m"], by["x"].transform(lambda s: s.cummax().ffill()))
    np.testing.assert_array_equal(
        got["f"].astype(float), by["flag"].ffill().astype("Float64").to_numpy(float, na_value=np.nan)
    )


def _loop(values, alpha):
    out, avg = [], None
    for x in values:
        if np.isnan(x):
            out.append(np.nan)
            continue
        avg = x if avg is None else alpha * x + (1 - alpha) * avg
        out.append(avg)
    return out


def test_ewm_matches_loop(df, frame, series):
    specs = {"a": ("x", 1 / 14), "b": ("x", 2 / 10)}
    want = frame.sort_values(["symbol", "date"]).reset_index(drop=True)
    if series.days is None:  # too long for one block with the faster decay
        specs.pop("b")
    got = _sorted(ewm(df, series, **specs))
    for out, (_, alpha) in specs.items():
        expect = np.concatenate([_loop(g["x"].to_numpy(), alpha) for _, g in want.groupby("symbol")])
        np.testing.assert_allclose(got[out], expect, rtol=1e-11)


def test_ewm_refuses_what_would_overflow(df):
    with pytest.raises(ValueError):
        ewm(df, Series(days=5000), a=("x", 0.2))
    with pytest.raises(Exception, match="too long"):
        ewm(df, Series(days=None), a=("x", 0.3)).agg(F.sum("a")).collect()


def test_a_long_series_is_spread_over_tasks(df):
    """The hot symbol's rows sit in several partitions when the window runs."""
    s = Series(days=64)
    w = s.window()
    long_rows = df.where("symbol = 'LONG'")
    rows = with_history(long_rows, s, 1, ["x"]).withColumn("l", F.lag("x").over(w))
    per_task = rows.where("not _past").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 3


def test_rows_without_a_key_are_listed(spark):
    from closebell.operators.features import returns
    from closebell.operators.series import unkeyed

    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0), (None, dt.date(2024, 1, 1), 2.0)],
                               "symbol string, date date, close double")
    assert returns(df).count() == 1
    assert [r.close for r in unkeyed(df, Series()).collect()] == [2.0]
