"""The same results when one part, event type, customer or text holds a third of all rows."""

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_module
from oracle_check import TABLES, compare, connect

SF = "/root/testdata/sf0.001"
NAMES = (
    "bars_daily", "rsi14", "news_dedup", "news_norm", "news_returns", "sentiment_daily",
    "sentiment_t1_t0", "alias_mapping", "fundamentals_asof", "positions", "equity_portfolio",
)


def _hot(table, column):
    """A third of the rows get the first row's value."""
    n = len(table)
    third = pa.array([i % 3 == 0 for i in range(n)])
    values = table[column].combine_chunks()
    return table.set_column(
        table.schema.get_field_index(column), column, pc.if_else(third, values[0], values)
    )


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    hot = {
        "lineitem": ["l_partkey"], "events": ["event_type"], "orders": ["o_custkey"],
        "documents": ["text", "lang", "n_chars"],
    }
    for name in TABLES:
        table = pq.read_table(f"{SF}/{name}.parquet")
        for column in hot.get(name, ()):
            table = _hot(table, column)
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, skewed, name):
    df = entry_module.queries()[name](spark, skewed)
    assert compare(df, connect(skewed), entry_module.oracle_sql()[name]) is None


def test_without_broadcast_joins(spark, skewed):
    """All joins shuffled, as with large tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for name in ("bars_daily", "news_returns", "metrics", "fundamentals_asof"):
            df = entry_module.queries()[name](spark, skewed)
            assert compare(df, connect(skewed), entry_module.oracle_sql()[name]) is None
    finally:
        for key in settings:
            spark.conf.unset(key)
