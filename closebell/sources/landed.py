"""Landed vendor files: bars, quarterly statements and news.

Layout: ``<root>/symbol=<SYMBOL>/*`` per kind of data, so the symbol of a file is known
even when its content is unreadable. Readers give the lines of files, parsers turn lines
into rows and take them from anywhere. What a parser cannot read goes to ``quarantine``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from closebell.functions.dates import day_part, utc_date, utc_timestamp
from closebell.schemas import LANDED_BARS, LANDED_NEWS, LANDED_STATEMENTS, NEWS_RAW, OHLCV

BROKEN = "_broken"
# Places of the parts of an article's number: symbol, landed record, article in the record.
_RECORDS, _ARTICLES = 1 << 26, 1 << 20


def read_lines(
    spark: SparkSession, root: str, symbols: Sequence[str] | None = None
) -> DataFrame:
    """``file, symbol, value`` of all lines below ``root``."""
    lines = spark.read.schema("value string, symbol string").text(root).select(
        F.col("_metadata.file_path").alias("file"), "symbol", "value"
    )
    return lines if symbols is None else lines.where(F.col("symbol").isin(*symbols))


# --- bars --------------------------------------------------------------------------------


def parse_bars(lines: DataFrame) -> DataFrame:
    """Columns of ``OHLCV`` plus ``_broken``, the text of a line that cannot be read.

    Cells are found by the names in the file's header line, in any order and case. A line is
    broken without a date, with a number that is none, or in a file without a header.
    """
    names = [c.lower() for c in LANDED_BARS.fieldNames()]
    cells = F.transform(F.split("value", ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    rows = lines.where(F.trim("value") != "").withColumn("_cells", cells)
    lower = F.transform("_cells", lambda c: F.lower(c))
    is_head = F.array_contains(lower, "date") & F.array_contains(lower, "close")
    heads = rows.where(is_head).groupBy("file").agg(F.min(lower).alias("_names"))
    placed = rows.where(~is_head).join(heads, "file", "left")

    def cell(name: str) -> Column:
        at = F.array_position("_names", name)
        return F.when(at > 0, F.try_element_at("_cells", at.cast("int")))

    read = {"date": utc_date(cell("date"))}
    for name in names[1:]:
        read[name] = cell(name).try_cast(OHLCV[name].dataType)
    wrong = read["date"].isNull() | F.col("_names").isNull()
    for name in names[1:]:
        filled = F.coalesce(cell(name), F.lit("")) != ""
        wrong = wrong | (filled & read[name].isNull())
    return placed.select(
        read["date"].alias("date"), "symbol", *[read[n].alias(n) for n in names[1:]],
        F.when(F.coalesce(wrong, F.lit(True)), F.col("value")).alias(BROKEN),
    )


def sound_bars(parsed: DataFrame, start: str, end: str) -> DataFrame:
    """The readable bars with ``start <= date < end``.

    ``end`` is a parameter of the job, never today's date, so that reruns give the same rows.
    """
    return parsed.where(
        F.col(BROKEN).isNull()
        & (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))
    ).drop(BROKEN)


def read_bars(
    spark: SparkSession, root: str, start: str, end: str, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Daily bars of landed CSV files with a header line."""
    return sound_bars(parse_bars(read_lines(spark, root, symbols)), start, end)


# --- JSON lines --------------------------------------------------------------------------


def parse_json(lines: DataFrame, schema: StructType) -> DataFrame:
    """``symbol``, ``record`` and ``_broken`` (the text of a line that cannot be read)."""
    with_broken = StructType([*schema.fields, StructField(BROKEN, StringType())])
    record = F.from_json(
        "value", with_broken, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    )
    return lines.select("symbol", record.alias("record")).select(
        "symbol", "record", F.col(f"record.{BROKEN}").alias(BROKEN)
    )


def _sound_symbols(parsed: DataFrame) -> DataFrame:
    """Records of the symbols that have no unreadable record at all."""
    bad = parsed.where(F.col(BROKEN).isNotNull()).select("symbol").distinct()
    return parsed.join(bad, "symbol", "left_anti")


def broken(lines: DataFrame, kind: str) -> DataFrame:
    """The unreadable lines, ``symbol, broken``. ``kind``: ``bars``, ``statements`` or ``news``."""
    if kind == "bars":
        parsed = parse_bars(lines)
    else:
        parsed = parse_json(lines, {"statements": LANDED_STATEMENTS, "news": LANDED_NEWS}[kind])
    return parsed.where(F.col(BROKEN).isNotNull()).select("symbol", F.col(BROKEN).alias("broken"))


def quarantine(
    spark: SparkSession, root: str, kind: str, symbols: Sequence[str] | None = None
) -> DataFrame:
    return broken(read_lines(spark, root, symbols), kind)


def parse_statements(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Income, balance and cash flow items with their landed position ``pos``.

    A symbol with any unreadable record is left out whole; ``quarantine`` lists it.
    """
    landed = _sound_symbols(parse_json(lines, LANDED_STATEMENTS)).select("symbol", "record")

    def items(statement: str) -> DataFrame:
        exploded = landed.select(
            "symbol", F.col("record.landed_seq").alias("seq"),
            F.posexplode(f"record.{statement}").alias("at", "item"),
        )
        dated = exploded.where(F.col("item.date").isNotNull() & (F.col("item.date") != ""))
        return dated.select(
            "symbol", F.struct("seq", "at").alias("pos"), "item.*"
        ).withColumn("date", utc_date(F.col("date")))

    return items("income"), items("balance"), items("cashflow")


def read_statements(
    spark: SparkSession, root: str, symbols: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return parse_statements(read_lines(spark, root, symbols))


def parse_news(
    lines: DataFrame, symbols: Sequence[str], start_ts: str, end_ts: str, language: str = "en"
) -> DataFrame:
    """Flattened articles in ``NEWS_RAW`` shape, all that the lines hold.

    Date bounds are inclusive days; articles without a language count as ``language``.
    ``ingest_seq`` is made of the symbol's place among those asked for, the landed record's
    number and the article's place in it: unique, in landed order, and the same on every rerun.
    """
    landed = _sound_symbols(parse_json(lines.where(F.col("symbol").isin(*symbols)), LANDED_NEWS))
    articles = landed.select(
        "symbol", F.col("record.landed_seq").alias("seq"),
        F.posexplode("record.articles").alias("at", "a"),
    ).select("symbol", "seq", "at", utc_timestamp(F.col("a.publishedAt")).alias("ts"), "a")
    day = F.to_date("ts")
    wanted = articles.where(
        day.between(F.lit(day_part(start_ts)).cast("date"), F.lit(day_part(end_ts)).cast("date"))
        & (F.coalesce("a.language", F.lit(language)) == language)
    )
    rank = F.array_position(F.array(*[F.lit(s) for s in symbols]), F.col("symbol")) - 1
    number = (rank * _RECORDS + F.col("seq")) * _ARTICLES + F.col("at")
    fits = F.col("seq").between(0, _RECORDS - 1) & (F.col("at") < _ARTICLES)
    stop = F.raise_error(F.lit("landed_seq missing or too large to number an article"))
    return wanted.select(
        F.when(fits, number).otherwise(stop.cast("bigint")).alias("ingest_seq"),
        "ts", "symbol", F.col("a.source.name").alias("source"),
        "a.title", "a.description", "a.url", "a.content",
    ).select(*NEWS_RAW.fieldNames())


def read_news(
    spark: SparkSession,
    root: str,
    symbols: Sequence[str],
    start_ts: str,
    end_ts: str,
    language: str = "en",
) -> DataFrame:
    return parse_news(read_lines(spark, root, symbols), symbols, start_ts, end_ts, language)
