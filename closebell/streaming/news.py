"""Continuous variant of news cleaning for landed files that keep arriving."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from closebell.functions.dates import utc_timestamp
from closebell.functions.text import article_key, clean
from closebell.operators.news import UNKNOWN
from closebell.schemas import LANDED_NEWS
from closebell.session import stage, staging
from closebell.sources.landed import BROKEN, parse_json

KEY = "_key"


def landed_lines(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """``symbol, value``: newly landed JSON lines."""
    return (
        spark.readStream.schema("value string, symbol string")
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(root)
    )


def articles(parsed: DataFrame) -> DataFrame:
    """Cleaned articles with their key, one per key: the first by symbol, record and place."""
    flat = parsed.select(
        "symbol", F.col("record.landed_seq").alias("seq"),
        F.posexplode("record.articles").alias("at", "a"),
    ).select(
        utc_timestamp(F.col("a.publishedAt")).alias("ts"), "symbol", "seq", "at",
        F.col("a.source.name").alias("source"), "a.title", "a.content", "a.url",
    )
    keyed = flat.withColumn(KEY, article_key(F.col("ts"), F.col("source"), F.col("title")))
    first = keyed.groupBy(KEY).agg(
        F.min_by(F.struct("ts", "symbol", "source", "title", "content", "url"),
                 F.struct("symbol", "seq", "at")).alias("r")
    ).select(KEY, "r.*")
    return first.select(
        "ts", F.coalesce("symbol", F.lit(UNKNOWN)).alias("symbol"), "source", "title",
        clean(F.col("content")).alias("text"), "url", KEY, F.to_date("ts").alias("date"),
    )


def write(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append articles not seen before to ``<path>/news``, one folder per day, and unreadable lines
    to ``<path>/rejected``; stops when all landed files are read.

    What was seen is the table itself, so an article is recognised and none is dropped, however
    late it comes. A batch that is repeated after a failure finds its rows there already.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            parsed = stage(parse_json(batch, LANDED_NEWS), "news-batch")
            found = articles(parsed.where(F.col(BROKEN).isNull()))
            try:
                known = spark.read.parquet(f"{path}/news").select(KEY)
                found = found.join(known, KEY, "left_anti")
            except AnalysisException as missing:
                if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
            found.write.mode("append").partitionBy("date").parquet(f"{path}/news")
            rejected = parsed.where(F.col(BROKEN).isNotNull())
            rejected.select("symbol", F.col(BROKEN).alias("broken")).write.mode("append").parquet(
                f"{path}/rejected")

    return (
        lines.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
