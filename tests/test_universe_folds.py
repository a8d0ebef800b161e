import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from closebell.operators import features, metrics, universe
from closebell.operators.series import Series
from closebell.schemas import OHLCV
from closebell.sources import lake

NEWS = "ingest_seq bigint, ts timestamp, symbol string, source string, title string, description string, url string, content string"


def test_fold_metrics_equal_performance_of_the_rows(spark):
    rng = random.Random(4)
    points = []
    for run, n, step in (("a", 260, 3), ("b", 300, 1), ("flat", 150, 4), ("short", 20, 1)):
        at, value = dt.date(2023, 1, 15), 100.0
        for _ in range(n):
            value = value if run == "flat" else value * rng.uniform(0.9, 1.1)
            points.append((run, at, value))
            at += dt.timedelta(days=rng.randint(1, step))
    points.append(("b", dt.date(2025, 3, 3), 55.0))  # a fold of one point, after months without any
    df = spark.createDataFrame(points, "run_id string, date date, equity double").cache()
    got = {(r.run_id, r.fold, r.part): r for r in metrics.fold_metrics(df, 3).collect()}
    expected = 0
    for run in ("a", "b", "flat", "short"):
        months = sorted({p[1].replace(day=1) for p in points if p[0] == run})
        for fold, start in enumerate(months[3:], 1):
            rows = df.where(F.col("run_id") == run)
            after = (start + dt.timedelta(days=32)).replace(day=1)
            if fold not in (1, 2, len(months) - 3):
                expected += 2
                continue
            for part, cut in zip(("train", "test"), metrics.fold_rows(rows, str(start), str(after))):
                expected += 1
                want, r = metrics.performance(cut).first(), got[run, fold, part]
                assert (r.test_start, r.rows) == (start, cut.count())
                for name in metrics.METRIC_NAMES:
                    assert (r[name] is None) == (want[name] is None), (run, fold, part, name)
                    if want[name] is not None:
                        assert r[name] == pytest.approx(want[name], abs=1e-9)
    assert len(got) == expected and ("b", 1, "test") in got
    assert metrics.fold_metrics(df.limit(0)).count() == 0


def test_universe_sees_only_the_past(spark):
    rng = random.Random(6)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(400)), s, 1.0, 1.0, 1.0, rng.choice([1.0, 2.0, 5.0]), rng.randint(1, 9))
            for s in "ABCDEF" for _ in range(60)]
    rows = list({(r[0], r[1]): r for r in rows}.values()) + [(dt.date(2026, 1, 5), "A", 1.0, 1.0, 1.0, 1.0, 1)]
    bars = spark.createDataFrame(rows, OHLCV)
    got = {(r.month, r["rank"]): (r.symbol, round(r.adv, 9)) for r in universe.by_month(bars, 3, months=2).collect()}
    want = {}
    number = lambda d: d.year * 12 + d.month
    for month in {r[0].replace(day=1) for r in rows}:
        adv = {}
        for s in "ABCDEF":
            seen = [r[5] * r[6] for r in rows if r[1] == s and 1 <= number(month) - number(r[0]) <= 2]
            if seen:
                adv[s] = sum(seen) / len(seen)
        for k, s in enumerate(sorted(adv, key=lambda s: (-round(adv[s], 9), s))[:3], 1):
            want[month, k] = (s, round(adv[s], 9))
    assert got == want and dt.date(2026, 1, 1) not in {m for m, _ in got}
    later = bars.withColumn("volume", F.when(F.col("date") < "2024-09-01", F.col("volume")).otherwise(10**6))
    again = {(r.month, r["rank"]): (r.symbol, round(r.adv, 9)) for r in universe.by_month(later, 3, months=2).collect()}
    early = {k: v for k, v in got.items() if k[0] <= dt.date(2024, 9, 1)}
    assert early and all(again[k] == v for k, v in early.items())
    kept = universe.restrict_by_month(bars, universe.by_month(bars, 3, months=2))
    assert kept.columns == bars.columns
    assert {(r.date, r.symbol) for r in kept.collect()} == {
        (r[0], r[1]) for r in rows if r[1] in {got.get((r[0].replace(day=1), k), (None,))[0] for k in (1, 2, 3)}}


def test_titles_meet_aliases_by_the_rarest_word(spark):
    rng = random.Random(9)
    common = ["the", "of", "and", "The"]
    rows = []
    for i in range(400):
        words = [rng.choice(common + ["bank", "oil", "acme", "zeta"]) for _ in range(8)]
        rows.append((i, None, None if i % 11 else "S", "s", " ".join(words), "", "u", ""))
    aliases = [("the Acme bank", "A"), ("of zeta", "Z"), ("the oil and zeta", "O"), ("the", "T"), ("acme bank", "B"), ("nowhere acme", "N")]
    news = spark.createDataFrame(rows, NEWS)
    names = spark.createDataFrame(aliases, "alias string, symbol string")
    want = {}
    for r in rows:
        words = re.findall(r"\w+", r[4].lower())
        hits = []
        for alias, symbol in aliases:
            a = alias.lower().split()
            hits += [(i, -len(a), symbol) for i in range(len(words)) if words[i:i + len(a)] == a]
        want[r[0]] = r[2] or (min(hits)[2] if hits else None)
    got = {r.ingest_seq: r.symbol for r in universe.map_to_symbols(news, names).collect()}
    assert got == want
    split = names.select(universe._words("alias").alias("_alias"), F.col("symbol").alias("_to"))
    titles = news.select(universe._words("title").alias("_title"))
    anchored = {r["_to"]: (r["_word"], r["_at_word"]) for r in universe.anchors(split, titles).collect()}
    assert "N" not in anchored and anchored["T"] == ("the", 0)
    assert all(anchored[k][0] != "the" for k in "AZOB")


def bar(i, symbol, close):
    return (dt.date(2024, 1, 1) + dt.timedelta(days=i), symbol, close, close, close, close, 1)


def test_the_last_commit_wins(spark, tmp_path):
    """A write that began first and is published last is what readers see."""
    path, schema = str(tmp_path / "t"), OHLCV
    lake.write_atomic(spark.createDataFrame([bar(0, "A", 0.0)], schema), path, schema)
    publish, waiting = lake._publish, []

    def later(rows, *args):
        waiting.append((rows, *args))

    lake._publish = later
    try:
        lake.write_atomic(spark.createDataFrame([bar(0, "A", 2.0)], schema), path, schema)
    finally:
        lake._publish = publish
    lake.write_atomic(spark.createDataFrame([bar(0, "A", 1.0)], schema), path, schema)
    assert lake.read_table(spark, path, schema).first().close == 1.0
    publish(*waiting[0])
    assert lake.read_table(spark, path, schema).first().close == 2.0
    assert lake.last_commit(spark, path) == 3


@pytest.mark.parametrize("partitions", [(), ("date",)])
def test_interleaved_upserts_both_show(spark, tmp_path, partitions):
    root = str(tmp_path)
    path = lake.path_of(root, "ohlcv_daily")
    lake.upsert_bars(spark.createDataFrame([bar(0, "A", 1.0), bar(0, "B", 1.0)], OHLCV), root, partitions)
    write, done = lake.write_atomic, []

    def interrupted(*args, **kwargs):
        if not done:  # another writer comes between reading and publishing
            done.append(True)
            lake.upsert_bars(spark.createDataFrame([bar(0, "C", 3.0)], OHLCV), root, partitions)
        return write(*args, **kwargs)

    lake.write_atomic = interrupted
    try:
        lake.upsert_bars(spark.createDataFrame([bar(0, "B", 2.0)], OHLCV), root, partitions)
    finally:
        lake.write_atomic = write
    rows = {(r.symbol, r.close) for r in lake.read_table(spark, path, OHLCV).collect()}
    assert rows == {("A", 1.0), ("B", 2.0), ("C", 3.0)}
    base = lake.last_commit(spark, path)
    lake.write_atomic(spark.createDataFrame([bar(0, "D", 4.0)], OHLCV), path, OHLCV, partitions)
    with pytest.raises(lake.Conflict):
        lake.write_atomic(spark.createDataFrame([bar(0, "E", 4.0)], OHLCV), path, OHLCV, partitions, base=base)
    assert {r.symbol for r in lake.read_table(spark, path, OHLCV).collect()} == {"D"}


def test_bucketed_bars_are_not_shuffled(spark, tmp_path):
    rows = [bar(i, s, 1.0 + i) for i in range(40) for s in "ABC"]
    bars = lake.save_bucketed(
        spark.createDataFrame(rows, OHLCV), f"bucketed_{tmp_path.name.replace('-', '_')}", 4)
    try:
        w = Series().window()
        from closebell.operators.series import blocked

        first = blocked(bars, Series()).withColumn("before", F.lag("close").over(w))
        plan = first._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan
        want = {(r.symbol, r.date): r.r20 for r in features.trailing_return(spark.createDataFrame(rows, OHLCV)).collect()}
        assert {(r.symbol, r.date): r.r20 for r in features.trailing_return(bars).collect()} == want
        joined = bars.groupBy("symbol").agg(F.max("close").alias("top")).join(bars, "symbol")
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql(f"drop table if exists bucketed_{tmp_path.name.replace('-', '_')}")
