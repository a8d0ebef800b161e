"""Physical plans: what is shuffled, read and broadcast."""

import re

import pytest

from closebell.operators import features, news
from closebell.operators.series import Series
from closebell.plans import queries
from closebell.schemas import OHLCV
from closebell.sources import derived

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan(df))


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "bars")
    queries.market(spark, SF).write.parquet(path)
    return spark.read.schema(OHLCV).parquet(path)


def test_whole_series_features_need_one_shuffle(spark, bars):
    assert len(shuffles(features.daily_features(bars, Series(days=None)))) == 1


def test_block_scan_shares_its_shuffle(spark, bars):
    df = features.momentum(bars)
    df.collect()
    assert "ReusedExchange" in plan(df).split("== Initial Plan ==")[0]


def test_features_read_three_columns(spark, bars):
    for scan in re.findall(r"ReadSchema: struct<([^>]*)>", plan(features.momentum(bars))):
        assert scan == "close:double" or set(re.findall(r"(\w+):", scan)) <= {"symbol", "close", "date"}


def test_symbol_filter_reaches_the_scan_through_the_window(spark, bars):
    df = features.trailing_return(bars, series=Series(days=None)).where("symbol = 'click'")
    assert "EqualTo(symbol,click)" in plan(df)


def test_bars_combine_before_the_shuffle(spark):
    p = plan(derived.bars_brand(spark, SF))
    assert p.index("partial_min_by") > p.index("Exchange hashpartitioning") and "Window" not in p


def test_news_lookups_are_subqueries_without_a_limit(spark):
    p = plan(derived.news_raw(spark, SF))
    assert "Join" not in p and "Limit" not in p and "limit=" not in p
    days = derived.news_raw(spark, SF).select("ts").distinct().count()
    assert days > 60


def test_texts_are_neither_sorted_nor_gathered_by_key(spark):
    p = plan(news.normalised(derived.news_raw(spark, SF)))
    assert "SortAggregate" not in p


def test_only_wanted_news_columns_are_shuffled(spark):
    p = plan(news.deduplicated(derived.news_raw(spark, SF), columns=("ingest_seq", "ts")))
    assert "content" not in p
