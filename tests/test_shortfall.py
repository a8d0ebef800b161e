"""One account that buys more than it has cash for."""

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_module
from oracle_check import TABLES, compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dear(tmp_path_factory):
    """Bars of brands cost 97 times as much."""
    folder = tmp_path_factory.mktemp("dear")
    for name in TABLES:
        table = pq.read_table(f"{SF}/{name}.parquet")
        if name == "lineitem":
            at = table.schema.get_field_index("l_extendedprice")
            table = table.set_column(at, "l_extendedprice", pc.multiply(table["l_extendedprice"], 97.0))
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


def test_portfolio_has_every_date_whatever_the_cash(spark, dear):
    df = entry_module.queries()["equity_portfolio"](spark, dear)
    assert df.columns == ["run_id", "date", "cash", "equity"]
    assert df.where("cash < 0").count() > 0
    assert compare(df, connect(dear), entry_module.oracle_sql()["equity_portfolio"]) is None
