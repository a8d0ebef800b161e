import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from closebell.operators import features, news, sentiment
from closebell.schemas import NEWS_NORM, NEWS_RAW

T = dt.datetime(2024, 1, 2, 10)


def raw(spark, rows):
    """rows: (seq, symbol, source, title)"""
    return spark.createDataFrame(
        [(n, T, s, src, title, "D", f"u{n}", f"Text {n}") for n, s, src, title in rows], NEWS_RAW)


ROWS = [
    (0, "AAPL", "R", "Rise http://a.b/c"),
    (1, "MSFT", "R", "RISE "),       # same but for case and address
    (2, "AAPL", None, "One"),
    (3, "AAPL", None, "Two"),
    (4, None, "R", None),
    (5, "AAPL", "R", None),          # null titles are equal
    (6, "AAPL", "S", "Rise "),       # other source
]


def seqs(df):
    return sorted(r.ingest_seq for r in df.collect())


def test_first_copy_survives_across_symbols(spark):
    df = raw(spark, ROWS)
    assert seqs(news.deduplicated(df)) == [0, 2, 3, 4, 6]
    assert seqs(news.deduplicated(df, keep="latest")) == [1, 2, 3, 5, 6]
    assert seqs(news.deduplicated(df, by_symbol=True)) == [0, 1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        news.deduplicated(df, keep="any")


def test_survivors_do_not_depend_on_partitioning(spark):
    df = raw(spark, [(n, "A", "R", f"t{n % 7}") for n in range(500)])
    for parts in (1, 3, 16):
        assert seqs(news.deduplicated(df.repartition(parts))) == list(range(7))


def test_a_text_copied_into_most_rows_is_combined_before_the_shuffle(spark):
    df = raw(spark, [(n, "A", "R", "same") for n in range(3000)]).repartition(4)
    plan = news.deduplicated(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(ingest_seq" in plan and "Window" not in plan and "SortAggregate" not in plan
    assert seqs(news.deduplicated(df)) == [0]


def test_normalised_contract(spark):
    rows = news.normalised(raw(spark, ROWS[3:5])).orderBy("title").collect()
    assert rows[0].asDict() == {
        "ts": T, "symbol": "UNKNOWN", "source": "R", "title": None, "text": "text 4", "url": "u4"}
    empty = news.normalised(raw(spark, []))
    assert empty.schema.fieldNames() == NEWS_NORM.fieldNames() and empty.count() == 0


def test_news_returns_keep_unmatched_news(spark):
    r = spark.createDataFrame([(T.date(), "AAPL", 0.1)], "date date, symbol string, r20 double")
    rows = news.with_returns(news.normalised(raw(spark, ROWS[:5])), r).collect()
    assert sorted((x.symbol, x.r20 is not None) for x in rows) == [
        ("AAPL", True), ("AAPL", True), ("AAPL", True), ("UNKNOWN", False)]


def load_words():
    def load():  # nested, so that it is sent to the workers by value
        def model(titles):
            assert len(titles) <= 2  # the batch size asked for
            return [(0.0, 0.0, float("rise" in t.lower())) for t in titles]

        return model

    return load


def test_scoring_calls_the_model_in_batches(spark):
    df = raw(spark, ROWS).coalesce(1)
    rows = sentiment.score_news(df, load_words(), batch=2, keep=("ingest_seq", "ts", "symbol")).collect()
    got = {r.ingest_seq: r for r in rows}
    e = math.e
    spread = sentiment.score_news(df, load_words(), batch=2, tasks=3)
    assert spread.rdd.getNumPartitions() == 3 and spread.count() == 7
    assert len(got) == 7 and got[4].news_sent == 0.0  # a null title scores as empty text
    assert got[0].news_sent == pytest.approx((e - 1) / (e + 2))
    assert got[0].news_conf == pytest.approx((e + 1) / (e + 2))
    assert sentiment.score_news(raw(spark, []), load_words()).count() == 0


def scores(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, symbol string, news_sent double, news_conf double")


def test_daily_and_two_day_sentiment(spark):
    day = dt.timedelta(days=1)
    df = scores(spark, [(T, "A", 0.5, 1.0), (T, "A", -0.1, 0.5), (T + day, "A", 0.2, 0.3)])
    daily = sentiment.daily(df).orderBy("date").collect()
    assert [(r.news_sent, r.headlines) for r in daily] == [(pytest.approx(0.2), 2), (0.2, 1)]
    two = {str(r.date): (round(r.news_sent, 9), r.headlines) for r in sentiment.two_day(df).collect()}
    assert two == {"2024-01-02": (0.2, 2), "2024-01-03": (0.2, 3), "2024-01-04": (0.2, 1)}


def test_zscore_is_across_symbols_of_a_day(spark):
    d = T.date()
    df = spark.createDataFrame(
        [(d, "A", 1.0, 0.0), (d, "B", 3.0, 0.0), (d + dt.timedelta(1), "A", 2.0, 0.0), (d, "C", None, 0.0)],
        "date date, symbol string, news_sent double, r20 double")
    got = {(r.date == d, r.symbol): r.news_sent for r in sentiment.zscored(df).collect()}
    assert got[True, "A"] == pytest.approx(-1 / math.sqrt(2)) and got[True, "B"] == pytest.approx(1 / math.sqrt(2))
    assert got[False, "A"] is None and got[True, "C"] is None


def test_one_model_load_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").write(str(os.getpid()))
        return lambda titles: [(0.0, 0.0, 1.0)] * len(titles)

    df = raw(spark, ROWS * 20).repartition(24)
    assert sentiment.score_news(df, load).count() == 140
    workers = [open(p).read() for p in tmp_path.iterdir()]
    assert len(workers) == len(set(workers))


def test_logits_of_a_wrong_width_fail(spark):
    def load():
        return lambda titles: [(0.0, 1.0)] * len(titles)

    with pytest.raises(Exception, match="3 logits"):
        sentiment.score_news(raw(spark, ROWS), load).count()


def test_names_of_several_words(spark):
    from closebell.operators import universe

    aliases = spark.createDataFrame(
        [("Big Apple", "AAPL"), ("big", "BIG"), ("apple rises", "X"), ("AT&T", "T"), ("", "E"), (None, "N")],
        "alias string, symbol string")
    rows = [(0, None, "R", "Big  apple rises"), (1, "MSFT", "R", "big apple"), (2, None, "R", "the big-apple"),
            (3, None, "R", "at t falls"), (4, None, "R", "an apple"), (5, None, "R", None), (6, None, "R", "Apple rises")]
    got = {r.ingest_seq: r.symbol for r in universe.map_to_symbols(raw(spark, rows), aliases).collect()}
    assert got == {0: "AAPL", 1: "MSFT", 2: "AAPL", 3: "T", 4: None, 5: None, 6: "X"}
