"""Dataset contracts: schema, keys, partitioning and freshness of every lake table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _F, _L, _T = StringType(), DateType(), DoubleType(), LongType(), TimestampType()

OHLCV = _struct(date=_D, symbol=_S, open=_F, high=_F, low=_F, close=_F, volume=_L)

# Statement fields keep the vendor's names.
INCOME_FIELDS = ("revenue", "netIncome", "eps")
BALANCE_FIELDS = ("totalAssets", "totalLiabilities")
CASHFLOW_FIELDS = ("cashFlowFromOperatingActivities",)
STATEMENT_FIELDS = (*INCOME_FIELDS, *BALANCE_FIELDS, *CASHFLOW_FIELDS)
FUNDAMENTALS = _struct(symbol=_S, date=_D, **{f: _F for f in STATEMENT_FIELDS})

NEWS_RAW = _struct(
    ingest_seq=_L, ts=_T, symbol=_S, source=_S, title=_S, description=_S, url=_S, content=_S
)
NEWS_NORM = _struct(ts=_T, symbol=_S, source=_S, title=_S, text=_S, url=_S)
HEADLINE_SCORES = _struct(ts=_T, symbol=_S, news_sent=_F, news_conf=_F)
SENTIMENT = _struct(date=_D, symbol=_S, news_sent=_F, news_conf=_F)
FEATURES = _struct(date=_D, symbol=_S, r20=_F, rsi14=_F, news_sent=_F, news_conf=_F, sector=_S)
SIGNALS = _struct(date=_D, symbol=_S, alpha=_F, reason=_S, side=_S, conf=_F)
ORDERS = _struct(date=_D, symbol=_S, side=_S, qty=IntegerType(), reason=_S, conf=_F)
EQUITY = _struct(run_id=_S, date=_D, equity=_F)
METRICS = _struct(
    run_id=_S, total_return=_F, annualized_volatility=_F, sharpe_ratio=_F, max_drawdown=_F
)
RUNS = _struct(
    run_id=_S, start_time=_T, status=_S,
    total_return=_F, annualized_volatility=_F, sharpe_ratio=_F, max_drawdown=_F,
)
CHECKSUMS = _struct(date=_D, rows=_L, checksum=_L)
BAR_KEYS = _struct(symbol=_S, date=_D)
MOMENTUM = _struct(block=_L, symbol=_S, date=_D, r20=_F, rsi14=_F)
MOMENTUM_STATES = _struct(
    symbol=_S, block=_L, tail=ArrayType(_struct(date=_D, close=_F)), up=_F, down=_F
)
TITLE_SCORES = _struct(model=_S, title_key=_S, scored_on=_D, news_sent=_F, news_conf=_F)

# Landed files, as the vendors send them.
LANDED_BARS = _struct(Date=_S, Open=_F, High=_F, Low=_F, Close=_F, Volume=_L)
LANDED_STATEMENTS = _struct(
    landed_seq=_L,
    income=ArrayType(_struct(date=_S, **{f: _F for f in INCOME_FIELDS})),
    balance=ArrayType(_struct(date=_S, **{f: _F for f in BALANCE_FIELDS})),
    cashflow=ArrayType(_struct(date=_S, **{f: _F for f in CASHFLOW_FIELDS})),
)
LANDED_NEWS = _struct(
    landed_seq=_L,
    articles=ArrayType(
        _struct(
            publishedAt=_S, source=_struct(name=_S), title=_S, description=_S,
            url=_S, content=_S, language=_S,
        )
    ),
)


@dataclass(frozen=True)
class Dataset:
    """One lake table. ``path`` is relative to the lake root."""

    schema: StructType
    path: str
    keys: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    date_column: str = "date"
    max_age_days: int = 4  # a long weekend

    @property
    def format(self) -> str:
        return "parquet"


DATASETS: dict[str, Dataset] = {
    "ohlcv_daily": Dataset(OHLCV, "ohlcv", ("date", "symbol"), ("date",)),
    "ohlcv_checksums": Dataset(CHECKSUMS, "ohlcv_checksums", ("date",)),
    "bar_changes": Dataset(BAR_KEYS, "bar_changes"),
    "momentum_daily": Dataset(MOMENTUM, "features/momentum", ("symbol", "date"), ("block",)),
    "momentum_states": Dataset(
        MOMENTUM_STATES, "features/momentum_states", ("symbol", "block"), ("block",)),
    "title_scores": Dataset(
        TITLE_SCORES, "title_scores", ("model", "title_key"), ("scored_on",), "scored_on"),
    "fundamentals": Dataset(FUNDAMENTALS, "fundamentals", ("symbol", "date"), max_age_days=120),
    "news_raw": Dataset(NEWS_RAW, "news_raw", ("ingest_seq",), date_column="ts"),
    "news_norm": Dataset(NEWS_NORM, "news_norm", date_column="ts"),
    "sentiment_daily": Dataset(SENTIMENT, "sentiment_daily", ("date", "symbol")),
    "features_daily": Dataset(FEATURES, "features/daily", ("date", "symbol")),
    "aggregated_signals": Dataset(SIGNALS, "aggregated_signals", ("date", "symbol")),
    "orders": Dataset(ORDERS, "orders", ("date", "symbol")),
    "equity_curve": Dataset(EQUITY, "equity_curve", ("run_id", "date")),
    "metrics": Dataset(METRICS, "metrics", ("run_id",)),
    "runs": Dataset(RUNS, "runs", ("run_id",), date_column="start_time"),
}


def list_datasets() -> dict[str, Dataset]:
    return dict(DATASETS)


def get_schema(name: str) -> StructType:
    return DATASETS[name].schema


def schema_drift(df: DataFrame, schema: StructType) -> list[str]:
    """Differences between a frame and a contract, in words; empty when they agree."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    return (
        [f"missing column {n}" for n in want if n not in have]
        + [f"unexpected column {n}" for n in have if n not in want]
        + [f"column {n} is {have[n].simpleString()}, expected {want[n].simpleString()}"
           for n in want if n in have and have[n].simpleString() != want[n].simpleString()]
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in contract order; raises when a column is missing, extra or mistyped."""
    drift = schema_drift(df, schema)
    if drift:
        raise ValueError("schema drift: " + "; ".join(drift))
    return df.select(*schema.fieldNames())

