"""The registered queries: every operator over inputs derived from the given tables.

Where several branches read bars, positions or closed trades, these are staged, as the lake tables are in a
daily run: the raw tables are then scanned once however many branches follow.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from closebell.functions import text
from closebell.operators import (
    accounts,
    backtest,
    features,
    fundamentals,
    metrics,
    news,
    quality,
    resumed,
    sentiment,
    signals,
    universe,
)
from closebell.schemas import STATEMENT_FIELDS
from closebell.session import stage
from closebell.sources import derived, landed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The prices of the derived brand bars move less than single stocks; tighter thresholds
# give signals on both sides.
RULE = {"min_alpha_buy": 0.1, "max_alpha_sell": -0.1}
# ... and cost up to 50,000 apiece.
CASH = 2_000_000.0


def query(*exact: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, or ``name``.

    Its float columns are rounded to 6 decimals, except ``exact`` ones: those come from
    single values by plain arithmetic and are equal to the last bit, while sums and
    exponentials depend on the order of addition.
    """

    def register(build: Query) -> Query:
        QUERIES[name or build.__name__] = lambda spark, sf_dir: rounded(
            build(spark, sf_dir), exact
        )
        return build

    return register


def rounded(df: DataFrame, exact: tuple[str, ...] = ()) -> DataFrame:
    """Adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[(F.round(f.name, 6) + F.lit(0.0)).alias(f.name)
          if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in exact
          else F.col(f.name)
          for f in df.schema]
    )


def coarser(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Fewer decimals for large values, whose last digits depend on the order of addition."""
    return df.select(
        *[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


# All symbols of the derived news, in the order articles are numbered in.
SYMBOLS = (
    "click", "error", "purchase", "signup", "view",
    *(f"Brand#{n}" for n in range(1, 26)),
)

PRICES = ("open", "high", "low", "close")
HEADLINE = ("ingest_seq", "ts", "symbol", "source", "title", "url")
TRADE = ("price", "cost", "commission")


# --- inputs -----------------------------------------------------------------------------


def market(spark, sf_dir) -> DataFrame:
    """Bars of event types and part brands."""
    return derived.bars_events(spark, sf_dir).unionByName(derived.bars_brand(spark, sf_dir))


def ohlcv(spark, sf_dir) -> DataFrame:
    return stage(market(spark, sf_dir), "ohlcv_daily")


def headline_scores(spark, sf_dir) -> DataFrame:
    """Every normalised headline with its scores, which are null where there is no vector."""
    raw = derived.news_raw(spark, sf_dir)
    kept = news.deduplicated(raw, columns=("ingest_seq", "ts", "symbol"))
    scores = sentiment.scored(derived.headline_logits(spark, sf_dir))
    return kept.select(
        "ingest_seq", "ts", F.coalesce("symbol", F.lit(news.UNKNOWN)).alias("symbol")
    ).join(scores, "ingest_seq", "left")


def sectors(spark, sf_dir) -> DataFrame:
    parts = derived.table(spark, sf_dir, "part")
    return parts.groupBy(F.col("p_brand").alias("symbol")).agg(F.min("p_type").alias("sector"))


def rule_inputs(spark, sf_dir) -> DataFrame:
    """What the rule reads: r20 and daily sentiment."""
    rows = features.trailing_return(market(spark, sf_dir))
    return features.with_sentiment(rows, sentiment.daily(headline_scores(spark, sf_dir)))


def decided_bars(spark, sf_dir) -> DataFrame:
    """``symbol, date, open, close`` of every bar and the side decided on it."""
    bars = market(spark, sf_dir).select("symbol", "date", "open", "close")
    rows = features.with_sentiment(
        features.with_return(bars), sentiment.daily(headline_scores(spark, sf_dir)))
    return signals.with_sides(rows, **RULE).select("symbol", "date", "open", "close", "side")


def held_of(spark, sf_dir) -> DataFrame:
    return stage(positions(spark, sf_dir), "positions")


def equity_of(spark, sf_dir) -> DataFrame:
    return backtest.equity_by_symbol(held_of(spark, sf_dir), cash=CASH)


def order_days(spark, sf_dir) -> DataFrame:
    """Every (segment, order date): the decision points statements are looked up for."""
    orders = derived.table(spark, sf_dir, "orders")
    customers = derived.table(spark, sf_dir, "customer")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_mktsegment").alias("symbol"), F.to_date("o_orderdate").alias("date"))
        .distinct()
    )


# --- bars and features ------------------------------------------------------------------


@query(*PRICES)
def bars_daily(spark, sf_dir):
    return market(spark, sf_dir)


@query(*PRICES)
def bars_range(spark, sf_dir):
    picked = ["Brand#11", "Brand#12", "click"]
    return features.bars_between(market(spark, sf_dir), picked, "1996-01-01", "1996-12-31")


@query("r20")
def r20(spark, sf_dir):
    return features.trailing_return(market(spark, sf_dir))


@query()
def rsi14(spark, sf_dir):
    rows = features.momentum(market(spark, sf_dir))
    return rows.where(F.col("rsi14").isNotNull()).select("date", "symbol", "rsi14")


@query("r20")
def features_incremental(spark, sf_dir):
    """The features of one month, rebuilt: they equal those of the full series."""
    return features.features_between(market(spark, sf_dir), "1997-03-01", "1997-03-31")


@query("r20")
def features_daily(spark, sf_dir):
    rows = features.daily_features(market(spark, sf_dir))
    rows = features.with_sentiment(rows, sentiment.daily(headline_scores(spark, sf_dir)))
    return features.with_sector(rows, sectors(spark, sf_dir))


@query("simple_return")
def log_returns(spark, sf_dir):
    return features.returns(market(spark, sf_dir)).where(F.col("log_return").isNotNull())


@query()
def sma20(spark, sf_dir):
    return features.moving_average(market(spark, sf_dir)).where(F.col("sma").isNotNull())


@query()
def rolling_vol20(spark, sf_dir):
    return features.rolling_volatility(market(spark, sf_dir)).where(F.col("vol").isNotNull())


@query()
def macd(spark, sf_dir):
    return coarser(features.macd(market(spark, sf_dir)), 4, "macd", "macd_signal")


@query()
def atr14(spark, sf_dir):
    return features.average_true_range(market(spark, sf_dir))


@query(*PRICES)
def adjusted_bars(spark, sf_dir):
    """A two-for-one split of every brand at the start of 1998."""
    bars = ohlcv(spark, sf_dir)
    factors = bars.where("date < date'1998-01-01'").select(
        "symbol", "date", F.lit(0.5).alias("factor")
    )
    return features.adjusted(bars, factors)


@query()
def adjustment_factors(spark, sf_dir):
    bars = ohlcv(spark, sf_dir)
    return features.adjustment_factors(bars, derived.corporate_actions(bars))


@query()
def adjusted_from_actions(spark, sf_dir):
    """Bars before splits and dividends, made comparable with those after."""
    bars = ohlcv(spark, sf_dir)
    adjusted = features.adjusted_by_actions(bars, derived.corporate_actions(bars))
    # halves of the last digit, which splits make often, are rounded one way
    return coarser(adjusted.withColumns({c: F.col(c) + 1e-9 for c in PRICES}), 4, *PRICES)


@query("r20")
def features_resumed(spark, sf_dir):
    """Features of all bars from March 1997 on and of the blocks they lie in, continued from the
    stored states of a run over the bars before."""
    bars = ohlcv(spark, sf_dir)
    new = F.col("date") >= F.lit("1997-03-01").cast("date")
    old = bars.where(~new)
    none = spark.createDataFrame([], resumed.STATE)
    states = stage(resumed.momentum_from(old, none, old)[1], "momentum-states")
    rows, _ = resumed.momentum_from(bars, states, bars.where(new))
    return rows.where(F.col("r20").isNotNull()).select("date", "symbol", "r20", "rsi14")


@query(*PRICES)
def liquid_bars(spark, sf_dir):
    return features.liquid(market(spark, sf_dir), min_volume=50.0)


@query()
def top_adv_universe(spark, sf_dir):
    return universe.top_by_dollar_volume(market(spark, sf_dir), 10)


@query()
def universe_by_month(spark, sf_dir):
    ranked = universe.by_month(market(spark, sf_dir), 10)
    return coarser(ranked.withColumn("adv", F.col("adv") + 1e-7), 4, "adv")


@query(*PRICES)
def universe_bars_by_month(spark, sf_dir):
    """Bars of the ten symbols most traded in the three months before."""
    bars = ohlcv(spark, sf_dir)
    return universe.restrict_by_month(bars, universe.by_month(bars, 10))


@query(*PRICES)
def universe_bars(spark, sf_dir):
    bars = ohlcv(spark, sf_dir)
    return universe.restrict(bars, universe.top_by_dollar_volume(bars, 10))


# --- news and sentiment -----------------------------------------------------------------


@query()
def news_clean(spark, sf_dir):
    raw = news.cleaned(derived.news_raw(spark, sf_dir))
    return raw.select("ingest_seq", "title_clean", "description_clean", "content_clean")


@query()
def url_strip(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.clean(F.col("html")).alias("text"))


@query()
def symbol_strip(spark, sf_dir):
    docs = derived.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.strip_symbols(F.col("text")).alias("text"))


@query()
def stopword_strip(spark, sf_dir):
    docs = derived.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.strip_stopwords(F.col("text")).alias("text"))


@query()
def landed_news(spark, sf_dir):
    """All articles of landed lines; the symbol with broken lines is left out."""
    lines = derived.news_lines(spark, sf_dir)
    found = landed.parse_news(lines, SYMBOLS, "1900-01-01", "2999-12-31")
    return found.select("ingest_seq", "ts", "symbol", "source", "title", "url")


@query(*STATEMENT_FIELDS)
def landed_statements(spark, sf_dir):
    return fundamentals.merged(*landed.parse_statements(derived.statement_lines(spark, sf_dir)))


@query("open", "high", "low", "close")
def landed_bars(spark, sf_dir):
    lines = derived.bar_lines(market(spark, sf_dir))
    return landed.sound_bars(landed.parse_bars(lines), "1900-01-01", "2999-12-31")


@query()
def quarantine(spark, sf_dir):
    """Unreadable landed lines per kind and symbol."""
    kinds = {
        "bars": derived.bar_lines(market(spark, sf_dir)),
        "news": derived.news_lines(spark, sf_dir),
        "statements": derived.statement_lines(spark, sf_dir),
    }
    found = [
        landed.broken(lines, kind).groupBy("symbol").agg(F.count("*").alias("lines"))
        .withColumn("kind", F.lit(kind))
        for kind, lines in kinds.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query()
def news_dedup(spark, sf_dir):
    return news.deduplicated(derived.news_raw(spark, sf_dir), columns=HEADLINE)


@query()
def news_dedup_by_symbol(spark, sf_dir):
    return news.deduplicated(derived.news_raw(spark, sf_dir), by_symbol=True, columns=HEADLINE)


@query()
def news_dedup_latest(spark, sf_dir):
    return news.deduplicated(derived.news_raw(spark, sf_dir), keep="latest", columns=HEADLINE)


@query()
def news_norm(spark, sf_dir):
    return news.normalised(derived.news_raw(spark, sf_dir))


@query("r20")
def news_returns(spark, sf_dir):
    r = features.trailing_return(market(spark, sf_dir))
    return news.with_returns(news.normalised(derived.news_raw(spark, sf_dir)), r)


@query()
def alias_mapping(spark, sf_dir):
    """Symbols for articles without one; aliases are the pairs of words in benchmark texts."""
    items = derived.table(spark, sf_dir, "benchmark")
    words = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    pairs = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)),
    )
    aliases = items.select(
        F.explode(pairs).alias("alias"),
        F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("symbol"),
    )
    mapped = universe.map_to_symbols(derived.news_raw(spark, sf_dir), aliases)
    return mapped.select("ingest_seq", "symbol", "title")


@query()
def sentiment_scores(spark, sf_dir):
    return sentiment.scored(derived.headline_logits(spark, sf_dir))


@query()
def sentiment_daily(spark, sf_dir):
    return sentiment.daily(headline_scores(spark, sf_dir))


@query()
def sentiment_t1_t0(spark, sf_dir):
    return sentiment.two_day(headline_scores(spark, sf_dir))


# A stand-in for a language model: counts of words, as logits.
GOOD = r"\b(?:and|with|la|der|el)\b"
BAD = r"\b(?:of|the|le|die|de)\b"


@query()
def sentiment_model(spark, sf_dir):
    def load():
        good, bad = re.compile(GOOD, re.ASCII), re.compile(BAD, re.ASCII)

        def model(titles):
            low = [t.lower() for t in titles]
            return [(len(bad.findall(t)), 1.0, len(good.findall(t))) for t in low]

        return model

    return sentiment.score_news(
        derived.news_raw(spark, sf_dir), load, keep=("ingest_seq", "ts", "symbol")
    )


# --- fundamentals -----------------------------------------------------------------------


@query(*STATEMENT_FIELDS)
def fundamentals_merge(spark, sf_dir):
    return fundamentals.merged(*derived.statements(spark, sf_dir))


@query(*STATEMENT_FIELDS)
def fundamentals_asof(spark, sf_dir):
    return fundamentals.as_of(
        order_days(spark, sf_dir), fundamentals.merged(*derived.statements(spark, sf_dir)))


# --- decisions and backtest -------------------------------------------------------------


@query(name="signals")
def signals_daily(spark, sf_dir):
    return signals.decide(rule_inputs(spark, sf_dir), **RULE)


@query()
def signals_zscore(spark, sf_dir):
    rows = stage(rule_inputs(spark, sf_dir), "features_daily")
    return signals.decide(rows, zscore=True)


@query()
def orders(spark, sf_dir):
    placed = signals.to_orders(signals.decide(rule_inputs(spark, sf_dir), **RULE))
    return signals.split_by_side(placed)[0]


@query(*PRICES)
def positions(spark, sf_dir):
    return backtest.positions(decided_bars(spark, sf_dir))


@query(*TRADE)
def trades(spark, sf_dir):
    return backtest.trades(positions(spark, sf_dir))


@query(*TRADE)
def trades_slippage(spark, sf_dir):
    return backtest.trades(positions(spark, sf_dir), stake=2, slippage_bps=5)


@query()
def equity_curve(spark, sf_dir):
    account = backtest.equity_by_symbol(held_of(spark, sf_dir), cash=CASH)
    return coarser(account, 2, "cash", "equity")


@query()
def equity_portfolio(spark, sf_dir):
    """One account over however many symbols there are: what it lacks is cash below 0."""
    account = backtest.equity_portfolio(held_of(spark, sf_dir), cash=CASH, on_shortfall="flag")
    return coarser(account.drop("shortfall"), 2, "cash", "equity")


# Too little for the dearer bars: some orders are refused.
SMALL_CASH = 1_500.0


@query(*PRICES)
def equity_refused(spark, sf_dir):
    """Accounts with little cash: what they hold, refuse and are worth."""
    held = accounts.limited_positions(decided_bars(spark, sf_dir), cash=SMALL_CASH)
    equity = F.col("cash") + F.col("pos") * F.col("close")
    return coarser(held.select(
        "symbol", "date", "pos", "fill", "refused", "cash", equity.alias("equity")),
        2, "cash", "equity")


@query()
def pnl_by_symbol(spark, sf_dir):
    return backtest.pnl_by_symbol(held_of(spark, sf_dir))


@query()
def turnover(spark, sf_dir):
    held = held_of(spark, sf_dir)
    log = backtest.trades(held).withColumn("run_id", F.col("symbol"))
    return backtest.turnover(log, backtest.equity_by_symbol(held, cash=CASH))


@query("entry", "exit", "profit")
def closed_trades(spark, sf_dir):
    return backtest.round_trips(stage(trades(spark, sf_dir), "trades"))


@query("profit")
def position_scaling(spark, sf_dir):
    closed = backtest.round_trips(stage(trades(spark, sf_dir), "trades"))
    return backtest.scaled_by_success(stage(closed, "closed"), n=5).select(
        "symbol", "date", "profit", "p_success", "scale"
    )


@query(name="metrics")
def performance(spark, sf_dir):
    return metrics.performance(equity_of(spark, sf_dir))


@query()
def metric_labels(spark, sf_dir):
    return metrics.labelled(metrics.performance(equity_of(spark, sf_dir)))


@query()
def drawdown_breaker(spark, sf_dir):
    curve = metrics.breaker(equity_of(spark, sf_dir), limit=-0.005)
    return coarser(curve, 2, "equity", "peak")


@query()
def latest_run(spark, sf_dir):
    """Runs start on their last bar's day; those of brands ending in 1 have failed."""
    equity = equity_of(spark, sf_dir)
    started = equity.groupBy("run_id").agg(F.max("date").cast("timestamp").alias("start_time"))
    status = F.when(F.col("run_id").endswith("1"), "FAILED").otherwise("FINISHED")
    runs = metrics.performance(equity).join(started, "run_id").withColumn("status", status)
    return metrics.latest_run(runs)


@query()
def walk_forward(spark, sf_dir):
    return metrics.walk_forward(market(spark, sf_dir))


@query()
def fold_metrics(spark, sf_dir):
    """Train and test metrics of every walk-forward fold of every account, in whole cents."""
    return metrics.fold_metrics(coarser(equity_of(spark, sf_dir), 2, "equity"))


# --- quality ----------------------------------------------------------------------------


@query()
def quality_nulls(spark, sf_dir):
    return quality.null_counts(derived.news_raw(spark, sf_dir))


@query()
def quality_keys(spark, sf_dir):
    lines = derived.table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query()
def quality_ranges(spark, sf_dir):
    scores = sentiment.scored(derived.headline_logits(spark, sf_dir))
    return quality.out_of_range(scores, {"news_sent": (-0.2, 0.2), "news_conf": (0.0, 0.7)})


@query()
def quality_freshness(spark, sf_dir):
    return quality.freshness(market(spark, sf_dir), "2024-02-01", 4)


@query()
def causality_violations(spark, sf_dir):
    """Decisions moved 45 days back, so that some come before the facts they used."""
    known = fundamentals.as_of(
        order_days(spark, sf_dir), fundamentals.merged(*derived.statements(spark, sf_dir)))
    return quality.causality_violations(known.withColumn("date", F.date_sub("date", 45)))


@query()
def quality_checksums(spark, sf_dir):
    """Checksums per day, of which those from 1997 on are taken anew and the others kept."""
    bars = ohlcv(spark, sf_dir)
    cents = [(F.round(F.col(c) * 100)).cast("long") for c in PRICES]
    row = quality.portable_hash(F.col("symbol"), *cents, F.col("volume"))
    late = F.col("date") >= F.lit("1997-01-01").cast("date")
    recorded = stage(quality.checksums(bars.where(~late), ["date"], row), "checksums")
    return quality.updated_checksums(bars, recorded, bars.where(late), "date", row)
