"""One whole day from landed files to metrics, and the same again."""

import datetime as dt
import json
import os
import random

import pytest

from pyspark.sql import functions as F

from closebell.operators import features
from closebell.operators.quality import ContractError
from closebell.plans import daily
from closebell.schemas import OHLCV
from closebell.session import shared_folder
from closebell.sources import lake

RUN = "2024-03-01"


@pytest.fixture()
def landed_root(tmp_path):
    root, first = tmp_path / "landed", dt.date(2024, 1, 20)
    for symbol, drift in (("AAPL", 1.03), ("MSFT", 0.97)):
        bars, price = ["Date,Open,High,Low,Close,Volume"], 100.0
        for i in range(45):
            price *= drift
            bars.append(f"{first + dt.timedelta(days=i)},{price},{price},{price},{price},1000")
        articles = [
            {"publishedAt": f"2024-02-{d:02d}T10:00:00Z", "source": {"name": "R"}, "title": f"{word} {d}",
             "description": "", "url": f"http://x/{d}", "content": "text"}
            for d in range(20, 30) for word in ("Rise" if drift > 1 else "Fall",)]
        for kind, lines in (
            ("bars", bars),
            ("news", [json.dumps({"landed_seq": 1, "articles": articles})]),
            ("statements", [json.dumps({"landed_seq": 1, "income": [{"date": "2023-12-31", "revenue": 1.0}], "balance": [], "cashflow": []})]),
        ):
            folder = root / kind / f"symbol={symbol}"
            folder.mkdir(parents=True)
            (folder / ("f.csv" if kind == "bars" else "f.json")).write_text("\n".join(lines) + "\n")
    return str(root)


def run(spark, landed_root, root, mode="backtest"):
    def load():
        return lambda titles: [(4.0 * ("Fall" in t), 0.0, 4.0 * ("Rise" in t)) for t in titles]

    return daily.run_day(spark, landed_root, root, RUN, ["AAPL", "MSFT"], load, mode, min_alpha_buy=0.5, max_alpha_sell=-0.5)


def test_a_day(spark, landed_root, tmp_path):
    root = str(tmp_path / "lake")
    staged = shared_folder(spark).removeprefix("file://") + "/closebell"
    before = set(os.listdir(staged)) if os.path.exists(staged) else set()
    counts = run(spark, landed_root, root)
    assert counts["ohlcv_daily"] == 62 and counts["features_daily"] > 0
    assert set(os.listdir(staged) if os.path.exists(staged) else []) <= before

    def table(name):
        df = lake.read(spark, root, name)
        return sorted((tuple(r) for r in df.collect()), key=str)

    names = ("ohlcv_daily", "fundamentals", "news_norm", "sentiment_daily", "features_daily",
             "aggregated_signals", "orders", "equity_curve", "metrics")
    first = {n: table(n) for n in names}
    assert all(first.values())
    assert {r[4] for r in first["aggregated_signals"]} == {"BUY", "SELL", "HOLD"}
    assert {r[2] for r in first["orders"]} == {"BUY", "SELL"}
    assert max(r[0] for r in first["ohlcv_daily"]) == dt.date.fromisoformat(RUN)
    assert first["metrics"][0][1] > 0  # the rising symbol was bought
    run(spark, landed_root, root)
    assert {n: table(n) for n in names} == first
    assert [r[0] for r in table("runs")] == [RUN]
    lines = {r.label: r.value for r in daily.report(spark, root).collect()}
    assert lines["Total Return"] == f"{first['metrics'][0][1]:.4f}"
    daily.nightly_checks(spark, root, RUN)
    with pytest.raises(ContractError, match="out of date"):
        daily.nightly_checks(spark, root, "2024-04-01")
    scores = lake.read(spark, root, "sentiment_daily")
    lake.replace(scores.withColumn("news_sent", F.lit(1.5)), root, "sentiment_daily")
    with pytest.raises(ContractError, match="out of range"):
        daily.nightly_checks(spark, root, RUN)
    lake.replace(scores.withColumn("news_sent", F.lit(0.5)), root, "sentiment_daily")
    rows = lake.read(spark, root, "features_daily")
    lake.replace(rows.withColumn("date", F.date_add("date", 400)), root, "features_daily")
    with pytest.raises(ContractError, match="after the last bar"):
        daily.nightly_checks(spark, root, RUN)
    bars = lake.read(spark, root, "ohlcv_daily").where("symbol = 'AAPL'")
    lake.upsert_bars(bars.withColumn("close", F.col("close") + 1), root)
    with pytest.raises(ContractError, match="checksum"):
        daily.nightly_checks(spark, root, RUN)


def test_features_of_a_day_equal_those_of_the_full_series(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(5)
    price, rows = 100.0, []
    for i in range(700):
        price *= 1 + rng.uniform(-0.03, 0.03)
        day = dt.date(2022, 1, 3) + dt.timedelta(days=i)
        if day.weekday() < 5:
            rows.append((day, "A", price, price, price, price, 10))
    lake.upsert_bars(spark.createDataFrame(rows, OHLCV), root)
    daily.build_features(spark, root, "2023-10-01", "2023-11-20")
    got = {r.date: (r.r20, r.rsi14) for r in lake.read(spark, root, "features_daily").collect()}
    full = features.daily_features(lake.read(spark, root, "ohlcv_daily")).where(
        "date between date'2023-10-01' and date'2023-11-20'").collect()
    assert len(got) == len(full) > 30
    for r in full:
        assert got[r.date] == (r.r20, pytest.approx(r.rsi14, abs=1e-9))


def test_modes(spark, landed_root, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, landed_root, root, "paper")
    assert lake.read(spark, root, "orders").count() > 0
    assert lake.read(spark, root, "metrics").count() == 0
    with pytest.raises(ValueError):
        run(spark, landed_root, root, "live")
