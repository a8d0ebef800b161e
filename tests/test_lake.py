import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from closebell import schemas
from closebell.operators import fundamentals, news, quality
from closebell.schemas import EQUITY, NEWS_NORM, NEWS_RAW, OHLCV
from closebell.session import drop_staged, shared_folder, stage
from closebell.sources import lake, landed
from closebell.streaming import news as streaming

D = dt.date(2024, 1, 1)


def bar(i, symbol, close):
    return (D + dt.timedelta(days=i), symbol, close, close, close, close, 10)


def rows_of(df, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.collect())


@pytest.mark.parametrize("partitions", [None, ("date", "symbol")], ids=["by date", "by date and symbol"])
def test_upsert_keeps_other_symbols_and_is_idempotent(spark, tmp_path, partitions):
    root = str(tmp_path)
    lake.upsert_bars(spark.createDataFrame([bar(0, "A", 1.0), bar(0, "B", 2.0), bar(1, "A", 3.0)], OHLCV), root, partitions)
    again = spark.createDataFrame([bar(0, "A", 9.0), bar(2, "C", 4.0)], OHLCV)
    want = [("2024-01-01", "A", "9.0"), ("2024-01-01", "B", "2.0"), ("2024-01-02", "A", "3.0"), ("2024-01-03", "C", "4.0")]
    for _ in range(2):
        lake.upsert_bars(again, root, partitions)
        got = lake.read(spark, root, "ohlcv_daily")
        assert got.schema.fieldNames() == OHLCV.fieldNames()
        assert rows_of(got, "date", "symbol", "close") == want


def test_loaders_views_and_missing_tables(spark, tmp_path):
    root = str(tmp_path)
    assert lake.read(spark, root, "features_daily").count() == 0
    lake.upsert_bars(spark.createDataFrame([bar(i, s, 1.0) for i in range(5) for s in "ABC"], OHLCV), root)
    got = lake.load_ohlcv(spark, root, ["A", "C"], "2024-01-02", "2024-01-03")
    assert rows_of(got, "date", "symbol") == [("2024-01-02", "A"), ("2024-01-02", "C"), ("2024-01-03", "A"), ("2024-01-03", "C")]
    many = [f"S{i}" for i in range(500)] + ["B"]
    assert lake.load_ohlcv(spark, root, many, "2024-01-01", "2024-01-01").count() == 1
    lake.register_views(spark, root)
    assert spark.sql("select count(*) n from ohlcv_daily").first().n == 15
    assert spark.sql("select count(*) n from aggregated_signals").first().n == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "In(symbol" in plan


def test_recursive_scan(spark, tmp_path):
    df = spark.createDataFrame([bar(0, "A", 1.0)], OHLCV)
    for name in ("x/2024-01-01/A.parquet", "x/y/z"):
        df.write.parquet(str(tmp_path / name))
    assert lake.read_files(spark, str(tmp_path / "x"), OHLCV).count() == 2


def test_writes_check_the_contract(spark, tmp_path):
    df = spark.createDataFrame([bar(0, "A", 1.0)], OHLCV)
    for wrong in (df.drop("open"), df.withColumn("more", F.lit(1)), df.withColumn("volume", F.lit("x"))):
        with pytest.raises(ValueError, match="schema drift"):
            lake.write_atomic(wrong, str(tmp_path / "t"), OHLCV)
    assert not os.path.exists(tmp_path / "t")


def test_fundamentals_lie_sorted(spark, tmp_path):
    rows = [(s, D + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(9, -1, -1) for s in "BA"]
    lake.replace_fundamentals(spark.createDataFrame(rows, schemas.FUNDAMENTALS).repartition(4), str(tmp_path))
    got = lake.read(spark, str(tmp_path), "fundamentals")
    for part in got.rdd.glom().collect():
        keys = [(r.symbol, r.date) for r in part]
        assert keys == sorted(keys)
    assert got.count() == 20


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([bar(i % 3, f"S{i}", float(i)) for i in range(60)], OHLCV)
    lake.write_atomic(df, path, OHLCV, ["date"], rows_per_file=4)
    before = rows_of(df, "date", "symbol", "close")

    def files():
        stale = {(r.version, str(r.date)) for r in lake.stale_versions(spark, path, OHLCV, ["date"]).collect()}
        live = 0
        for folder, _, names in os.walk(path + "/data"):
            parts = dict(p.split("=") for p in folder.split("/") if "=" in p)
            if (parts.get("version"), parts.get("date")) not in stale:
                live += sum(f.endswith(".parquet") for f in names)
        return live

    many = files()
    lake.compact(spark, path, OHLCV, ["date"], where="date = date'2024-01-01'")
    some = files()
    lake.compact(spark, path, OHLCV, ["date"])
    assert many > some > files() == 3
    assert rows_of(lake.read_table(spark, path, OHLCV), "date", "symbol", "close") == before


def fails_midway(df):
    """Writes some rows, then stops."""
    bad = df.limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(9999))).alias("n"), "*").drop("n")
    stop = F.when(F.col("_n") > 5000, F.raise_error(F.lit("midway")).cast("boolean")).otherwise(F.lit(True))
    return bad.withColumn("_n", F.monotonically_increasing_id()).where(stop).drop("_n")


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    bars = spark.createDataFrame([bar(i, s, 1.0) for i in range(3) for s in "AB"], OHLCV)
    facts = spark.createDataFrame([("A", D, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], schemas.FUNDAMENTALS)
    runs = spark.createDataFrame([("a", 0.1, 0.2, 0.3, -0.1)], schemas.METRICS)
    lake.upsert_bars(bars, root)
    lake.replace_fundamentals(facts, root)
    lake.record_run(spark, root, runs, "2024-01-01")
    equity = spark.createDataFrame([("r", D, 1.5)], EQUITY)
    lake.replace(equity, root, "equity_curve")
    before = {n: rows_of(lake.read(spark, root, n), *lake.read(spark, root, n).columns)
              for n in ("ohlcv_daily", "fundamentals", "runs", "equity_curve")}
    staged = shared_folder(spark)
    writes = (
        lambda: lake.upsert_bars(fails_midway(bars), root),
        lambda: lake.replace_fundamentals(fails_midway(facts), root),
        lambda: lake.upsert_fundamentals(fails_midway(facts), root),
        lambda: lake.record_run(spark, root, fails_midway(runs), "2024-01-02"),
        lambda: lake.replace(fails_midway(equity), root, "equity_curve"),
        lambda: lake.write_atomic(fails_midway(bars), lake.path_of(root, "ohlcv_daily"), OHLCV, ["date"]),
    )
    def left():
        return sum(len(fs) for d, _, fs in os.walk(staged.removeprefix("file://")) if "upsert" in d)

    held = left()
    for write in writes:
        with pytest.raises(Exception, match="midway"):
            write()
        for n, rows in before.items():
            got = lake.read(spark, root, n)
            assert rows_of(got, *got.columns) == rows
    assert left() == held  # staged tables go, also after errors
    lake.replace(equity.limit(0), root, "equity_curve")
    assert lake.read(spark, root, "equity_curve").count() == 0


def test_null_keys_are_refused(spark, tmp_path):
    df = spark.createDataFrame([bar(0, "A", 1.0), bar(0, None, 1.0)], OHLCV)
    with pytest.raises(Exception, match="null key"):
        lake.upsert_bars(df, str(tmp_path))


def test_partial_statements_keep_the_others(spark, tmp_path):
    root, columns = str(tmp_path), schemas.FUNDAMENTALS
    lake.upsert_fundamentals(spark.createDataFrame([(s, D, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for s in "AB"], columns), root)
    lake.upsert_fundamentals(spark.createDataFrame([("A", D, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0)], columns), root)
    assert rows_of(lake.read(spark, root, "fundamentals"), "symbol", "revenue") == [("A", "2.0"), ("B", "1.0")]


def test_equity_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("r", D, 1.5), ("r", D + dt.timedelta(days=1), 2.25)], EQUITY)
    lake.write_equity_csv(df, str(tmp_path / "c"))
    assert rows_of(lake.read_equity_csv(spark, str(tmp_path / "c"), "r"), *EQUITY.fieldNames()) == rows_of(df, *EQUITY.fieldNames())


def test_stage_uses_the_named_folder(spark):
    folder = shared_folder(spark)
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    files = staged.inputFiles()
    assert all(folder in f for f in files)
    assert drop_staged(spark) >= 1
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def put(root, kind, symbol, name, lines):
    folder = root / kind / f"symbol={symbol}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_landed_bars(spark, tmp_path):
    put(tmp_path, "bars", "A", "a.csv", [
        "Date,Open,High,Low,Close,Volume", "2024-01-01,1,2,0.5,1.5,100", "2024-01-02T00:00:00Z,2,3,1,2.5,200", "2024-01-03,9,9,9,9,9"])
    put(tmp_path, "bars", "B", "b.csv", ["Date,Open,High,Low,Close,Volume"])
    put(tmp_path, "bars", "C", "c.csv", ["Volume,Date, close ,High,Low,Open", "7,2024-01-01,1,3,0,2", "7,2024-01-01,one,3,0,2", "7,soon,1,3,0,2"])
    put(tmp_path, "bars", "D", "d.csv", ["2024-01-01,1,2,0.5,1.5,100"])
    bad = landed.quarantine(spark, str(tmp_path / "bars"), "bars")
    assert rows_of(bad, "symbol", "broken") == [
        ("C", "7,2024-01-01,one,3,0,2"), ("C", "7,soon,1,3,0,2"), ("D", "2024-01-01,1,2,0.5,1.5,100")]
    byname = landed.read_bars(spark, str(tmp_path / "bars"), "2024-01-01", "2024-01-03", ["C"])
    assert rows_of(byname, "open", "high", "low", "close", "volume") == [("2.0", "3.0", "0.0", "1.0", "7")]
    got = landed.read_bars(spark, str(tmp_path / "bars"), "2024-01-01", "2024-01-03", ["A", "B"])
    assert schemas.schema_drift(got, OHLCV) == []
    assert rows_of(got, "date", "symbol", "close", "volume") == [
        ("2024-01-01", "A", "1.5", "100"), ("2024-01-02", "A", "2.5", "200")]


def test_landed_statements_merge(spark, tmp_path):
    put(tmp_path, "st", "A", "1.json", [{
        "landed_seq": 1,
        "income": [{"date": "2024-03-31", "revenue": 1.0, "netIncome": 2.0, "eps": 3.0},
                   {"date": "2024-03-31", "revenue": 5.0, "netIncome": None, "eps": 4.0},
                   {"date": "", "revenue": 7.0}, {"revenue": 8.0}],
        "balance": [{"date": "2024-06-30", "totalAssets": 10.0, "totalLiabilities": 4.0}],
        "cashflow": [{"date": "2024-03-31", "cashFlowFromOperatingActivities": 6.0}]}])
    put(tmp_path, "st", "A", "2.json", [{"landed_seq": 2, "income": [{"date": "2024-03-31", "revenue": 6.0, "eps": 1.0}]}])
    put(tmp_path, "st", "BAD", "1.json", [{"landed_seq": 1, "income": [{"date": "2024-03-31", "revenue": 1.0}]}, "{oops"])
    root = str(tmp_path / "st")
    got = fundamentals.merged(*landed.read_statements(spark, root)).orderBy("date").collect()
    assert [(r.symbol, str(r.date), r.revenue, r.netIncome, r.eps, r.totalAssets, r.cashFlowFromOperatingActivities) for r in got] == [
        ("A", "2024-03-31", 6.0, None, 1.0, None, 6.0),
        ("A", "2024-06-30", None, None, None, 10.0, None)]
    assert [(r.symbol, r.broken) for r in landed.quarantine(spark, root, "statements").collect()] == [("BAD", "{oops")]


def test_as_of_looks_back_only(spark):
    facts = fundamentals.merged(
        spark.createDataFrame([("A", D, 1.0, 1.0, 1.0, 0), ("A", D + dt.timedelta(days=900), 2.0, 2.0, 2.0, 0)],
                              "symbol string, date date, revenue double, netIncome double, eps double, pos int"),
        spark.createDataFrame([], "symbol string, date date, totalAssets double, totalLiabilities double, pos int"),
        spark.createDataFrame([], "symbol string, date date, cashFlowFromOperatingActivities double, pos int"))
    asked = spark.createDataFrame(
        [(s, D + dt.timedelta(days=i)) for s in ("A", "B") for i in (-1, 0, 899, 900, 2000)], "symbol string, date date")
    got = fundamentals.as_of(asked, facts)
    assert [r.revenue for r in got.orderBy("symbol", "date").collect()] == [None, 1.0, 1.0, 2.0, 2.0] + [None] * 5
    assert tuple(quality.causality_violations(got).first()) == (10, 0)


def article(ts, title, **more):
    return {"publishedAt": ts, "source": {"name": "R"}, "title": title, "description": "d", "url": "u", "content": "C", **more}


@pytest.fixture()
def news_root(tmp_path):
    put(tmp_path, "news", "A", "1.json", [{"landed_seq": 1, "articles": [
        article("2024-01-01T23:30:00-05:00", "next day"), article("2024-01-02T10:00:00Z", "one"),
        article("2024-01-02T10:00:00Z", "ONE"), article("2024-01-02T11:00:00Z", "zwei", language="de"),
        article("2024-01-05T10:00:00Z", "late")]}])
    put(tmp_path, "news", "B", "1.json", [{"landed_seq": 1, "articles": [article("2024-01-02T10:00:00Z", "one")]}])
    put(tmp_path, "news", "C", "1.json", ["not json"])
    return str(tmp_path / "news")


def test_landed_news(spark, news_root):
    got = landed.read_news(spark, news_root, ["B", "A", "C"], "2024-01-02T00:00:00Z", "2024-01-03T23:59:59Z")
    assert got.schema.fieldNames() == NEWS_RAW.fieldNames()
    assert rows_of(got, "ingest_seq", "symbol", "title") == [
        (str(n), s, t) for n, s, t in (
            (1 << 20, "B", "one"), ((1 << 46) + (1 << 20), "A", "next day"),
            ((1 << 46) + (1 << 20) + 1, "A", "one"), ((1 << 46) + (1 << 20) + 2, "A", "ONE"))]
    kept = news.normalised(got)
    assert rows_of(kept, "symbol", "title", "text") == [("A", "next day", "c"), ("B", "one", "c")]


def test_no_article_is_lost(spark, tmp_path):
    many = [article("2024-01-02T10:00:00Z", f"t{i}") for i in range(730)]
    for k in range(3):
        put(tmp_path, "news", "A", f"{k}.json", [{"landed_seq": k, "articles": many}])
    got = landed.read_news(spark, str(tmp_path / "news"), ["A"], "2024-01-01", "2024-01-09")
    assert got.count() == got.select("ingest_seq").distinct().count() == 3 * 730


def test_streamed_news_agree_with_batch(spark, news_root, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        streaming.write(streaming.landed_lines(spark, news_root), out, checkpoint).awaitTermination(120)
        return spark.read.parquet(f"{out}/news")

    got = run()
    assert rows_of(got, "title") == [("late",), ("next day",), ("one",), ("zwei",)]
    put(tmp_path, "news", "B", "2.json", [{"landed_seq": 2, "articles": [
        article("2024-01-05T12:00:00Z", "new"), article("2024-01-05T10:00:00Z", "Late"),
        article("2001-01-05T10:00:00Z", "years late")]}])
    assert run().count() == 6  # however late, and copies of earlier batches are known
    assert set(NEWS_NORM.fieldNames()) <= set(got.columns)
    assert rows_of(spark.read.parquet(f"{out}/rejected"), "symbol", "broken") == [("C", "not json")]


def test_quality_checks(spark):
    df = spark.createDataFrame([(D, "A", 1.5, 0.5), (D, "A", None, 2.0), (D, None, -0.5, None)],
                               "date date, symbol string, news_sent double, news_conf double")
    assert rows_of(quality.null_counts(df), "column", "nulls", "rows") == [
        ("date", "0", "3"), ("news_conf", "1", "3"), ("news_sent", "1", "3"), ("symbol", "1", "3")]
    assert rows_of(quality.duplicate_keys(df, ["date", "symbol"]), "symbol", "rows") == [("A", "2")]
    assert rows_of(quality.out_of_range(df, quality.SENTIMENT_BOUNDS), "column", "violations") == [
        ("news_conf", "1"), ("news_sent", "1")]
    fresh = quality.freshness(df, "2024-01-04", 2).first()
    assert (fresh.age_days, fresh.fresh) == (3, False)
    assert quality.freshness(df.limit(0), "2024-01-04", 2).first().fresh is False
    with pytest.raises(quality.ContractError, match="null keys in symbol"):
        quality.require(df, df.schema, ["date", "symbol"])
    with pytest.raises(quality.ContractError, match="duplicate"):
        quality.require(df.where("symbol is not null"), df.schema, ["date", "symbol"])
    with pytest.raises(quality.ContractError, match="missing column"):
        quality.require(df, OHLCV)
    quality.require(df.limit(1), df.schema, ["date", "symbol"])


def test_checksums_and_row_counts(spark, tmp_path):
    df = spark.createDataFrame([bar(i % 2, f"S{i}", float(i)) for i in range(40)], OHLCV)
    a = rows_of(quality.checksums(df, ["date"]), "date", "rows", "checksum")
    assert a == rows_of(quality.checksums(df.repartition(7), ["date"]), "date", "rows", "checksum")
    assert a != rows_of(quality.checksums(df.withColumn("close", F.col("close") + 1), ["date"]), "date", "rows", "checksum")
    counted, seen = quality.observed(df, "bars")
    counted.write.parquet(str(tmp_path / "x"))
    assert seen.get["rows"] == 40


def test_runs_are_recorded_once(spark, tmp_path):
    one = spark.createDataFrame([("a", 0.1, 0.2, 0.3, -0.1)], schemas.METRICS)
    two = spark.createDataFrame([("b", 0.2, 0.2, 0.3, -0.1)], schemas.METRICS)
    root = str(tmp_path)
    lake.record_run(spark, root, one, "2024-01-01")
    lake.record_run(spark, root, two, "2024-01-02", "FAILED")
    lake.record_run(spark, root, one.withColumn("total_return", F.lit(0.5)), "2024-01-03")
    assert rows_of(lake.read(spark, root, "runs"), "run_id", "status", "total_return") == [
        ("a", "FINISHED", "0.5"), ("b", "FAILED", "0.2")]


def test_registry():
    assert {"ohlcv_daily", "news_norm", "features_daily", "orders"} <= set(schemas.list_datasets())
    assert schemas.get_schema("ohlcv_daily") == OHLCV
