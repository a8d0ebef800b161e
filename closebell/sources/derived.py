"""Bars, statements and news derived from the order, event and document tables.

The star-schema tables hold no market data, so these views give the operators inputs of
the right shape that grow with the tables. Open and close are ``min_by`` / ``max_by``
aggregates rather than row numbers: they combine before the shuffle, so a symbol that
holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up once, not by a job for every read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _bars(rows: DataFrame, price: str, order: Column, volume: Column) -> DataFrame:
    # date first: the aggregation sorts, and dates compare faster than similar names
    return rows.groupBy("date", "symbol").agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.cast("bigint").alias("volume"),
    ).select("date", "symbol", "open", "high", "low", "close", "volume")


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol per event type; the value of its events as price."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"),
        "ts", "event_id", "value",
    )
    return _bars(events, "value", F.struct("ts", "event_id"), F.count("*"))


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol per part brand; the unit price of its line items, by ship date."""
    lines = table(spark, sf_dir, "lineitem")
    brands = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("symbol")
    )
    trades = lines.join(brands, "l_partkey").select(
        "symbol", F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    )
    # order key and line number alone are not unique
    order = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    return _bars(trades, "price", order, F.sum("l_quantity"))


def corporate_actions(bars: DataFrame) -> DataFrame:
    """``symbol, date, split, dividend``: every 15 March a dividend of a fiftieth of the year's lowest
    price; two new shares for one on 4 July of a symbol's third year, three on 15 March of its fifth."""
    years = bars.groupBy("symbol", F.year("date").alias("y")).agg(F.min("low").alias("low"))
    dividends = years.select(
        "symbol", F.make_date("y", F.lit(3), F.lit(15)).alias("date"),
        F.lit(None).cast("double").alias("split"), (F.col("low") / 50).alias("dividend"))
    first = years.groupBy("symbol").agg(F.min("y").alias("y"))
    splits = first.select("symbol", F.explode(F.array(
        F.struct(F.make_date(F.col("y") + 2, F.lit(7), F.lit(4)).alias("date"), F.lit(2.0).alias("split")),
        F.struct(F.make_date(F.col("y") + 4, F.lit(3), F.lit(15)).alias("date"), F.lit(3.0).alias("split")),
    )).alias("s")).select("symbol", "s.date", "s.split", F.lit(None).cast("double").alias("dividend"))
    return dividends.unionByName(splits)


def _listed(*parts: DataFrame) -> Column:
    """All distinct values of the parts' first columns, as one sorted array.

    A scalar subquery: for days it is bounded by the calendar, for symbols by the universe.
    """
    values = [p.select(F.col(p.columns[0]).alias("v")).distinct() for p in parts]
    together = reduce(DataFrame.unionByName, values)
    return together.agg(F.sort_array(F.collect_set("v")).alias("v")).scalar()


def _pick(listed: Column, number: Column) -> Column:
    return F.element_at(listed, (F.pmod(number, F.size(listed)) + 1).cast("int"))


def news_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles, dated over all days and tagged with all symbols of the bars.

    The first line of a text is the title, all others are the description.
    """
    events, lines = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    days = _listed(events.select(F.to_date("ts")), lines.select(F.to_date("l_shipdate")))
    symbols = _listed(
        events.select("event_type"), table(spark, sf_dir, "part").select("p_brand")
    )
    title = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ingest_seq"),
        _pick(days, F.col("n_chars")).cast("timestamp").alias("ts"),
        F.when(F.col("doc_id") % 17 != 0, _pick(symbols, F.col("doc_id"))).alias("symbol"),
        F.when(F.col("doc_id") % 23 != 0, F.col("lang")).alias("source"),
        title.alias("title"),
        F.substring("text", F.char_length(title) + 2, F.char_length("text")).alias("description"),
        F.concat(F.lit("http://example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
    )


def headline_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three model outputs per embedded article (negative, neutral, positive): the sums of every
    third entry of its vector, from the first, second and third on."""
    def third(start: int) -> Column:
        entries = F.filter("embedding", lambda _, i: i % 3 == start)
        return F.aggregate(entries, F.lit(0.0), lambda a, x: a + x.cast("double"))

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("ingest_seq"), F.array(*[third(i) for i in range(3)]).alias("logits")
    )


def _orders_by_quarter(spark: SparkSession, sf_dir: str, months_late: int) -> DataFrame:
    """Orders by segment, quarter (of the day ``months_late`` months on) and position: every month
    of a quarter brings a new item for it, of which the last counts."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    reported = F.add_months(F.to_date("o_orderdate"), months_late)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_mktsegment").alias("symbol"),
        F.to_date(F.date_trunc("quarter", reported)).alias("date"),
        F.month(reported).alias("pos"),
    )


def statements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Income, balance sheet and cash flow per market segment. Balances come a quarter and cash
    flows two quarters late, so the first and last dates lack some of them."""

    def exact_sum(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")

    income = _orders_by_quarter(spark, sf_dir, 0).agg(
        exact_sum("o_totalprice").alias("revenue"),
        F.count("*").cast("double").alias("netIncome"),
        F.max("o_totalprice").alias("eps"),
    )
    balance = _orders_by_quarter(spark, sf_dir, 3).agg(
        exact_sum("c_acctbal").alias("totalAssets"),
        F.min("c_acctbal").alias("totalLiabilities"),
    )
    cashflow = _orders_by_quarter(spark, sf_dir, 6).agg(
        F.min("o_totalprice").alias("cashFlowFromOperatingActivities")
    )
    return income, balance, cashflow


def _broken(line: Column, where: Column) -> Column:
    """The line, cut off where the condition holds."""
    return F.when(where, F.concat(F.lit("{oops "), line)).otherwise(line)


def news_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``symbol, value``: the articles as landed lines; some of the symbol ``view`` are broken."""
    raw = news_raw(spark, sf_dir).where(F.col("symbol").isNotNull())
    article = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.struct(F.col("source").alias("name")).alias("source"),
        "title", "description", "url", "content",
        F.when(F.col("ingest_seq") % 3 != 0, F.coalesce("source", F.lit("en"))).alias("language"),
    )
    line = F.to_json(F.struct(
        F.col("ingest_seq").alias("landed_seq"), F.array(article).alias("articles")
    ))
    broken = (F.col("symbol") == "view") & (F.col("ingest_seq") % 7 < 3)
    return raw.select("symbol", _broken(line, broken).alias("value"))


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``symbol, value``: one landed line for each item of a statement, some without a date; those
    of the symbol ``MACHINERY`` are broken. Positions are the landed order."""
    lines = []
    for kind, items in zip(("income", "balance", "cashflow"), statements(spark, sf_dir)):
        fields = [c for c in items.columns if c not in ("symbol", "date", "pos")]
        dated = items.unionByName(items.withColumn("date", F.lit(None).cast("date")))
        item = F.struct(F.coalesce(F.col("date").cast("string"), F.lit("")).alias("date"), *fields)
        line = F.to_json(F.struct(F.col("pos").alias("landed_seq"), F.array(item).alias(kind)))
        lines.append(dated.select(
            "symbol", _broken(line, F.col("symbol") == "MACHINERY").alias("value")))
    return reduce(DataFrame.unionByName, lines)


def bar_lines(bars: DataFrame) -> DataFrame:
    """``file, symbol, value``: bars as CSV lines, a file per symbol. Symbols that end in an odd
    digit have their columns in another order; closes of volumes divisible by 97 are unreadable."""
    close = F.when(F.col("volume") % 97 == 0, "x").otherwise(F.col("close").cast("string"))
    prices = [F.col(c).cast("string") for c in ("open", "high", "low")]
    day, volume = F.col("date").cast("string"), F.col("volume").cast("string")
    odd = F.col("symbol").rlike("[13579]$")
    plain = F.concat_ws(",", day, *prices, close, volume)
    other = F.concat_ws(",", volume, close, day, *reversed(prices))
    lines = bars.select(
        F.col("symbol").alias("file"), "symbol", F.when(odd, other).otherwise(plain).alias("value"))
    header = F.when(odd, "Volume,Close,Date,Low,High,Open").otherwise("Date,Open,High,Low,Close,Volume")
    heads = bars.select("symbol").distinct().select(
        F.col("symbol").alias("file"), "symbol", header.alias("value"))
    return heads.unionByName(lines)
