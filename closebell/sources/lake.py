"""The Parquet lake: views, loaders and writers that replace what they touch at once or not at all.

A table is a folder with ``data/version=<id>/...`` and ``log``. A write adds a version of the
partitions it touches (or of the whole table, without partitions) beside the old ones, and then
publishes a single small file that lists them under the next number of the log. Publishing is a rename that
fails if the number is taken, so commits are ordered by when they were published, not by when their
jobs began, and a job that fails midway leaves no trace in what readers see. Readers take the version
with the highest commit of each partition. A write that builds on what it has read (``upsert``,
``compact``) must be the very next commit; if another came between, it starts over from there, so
neither is lost. ``stale_versions`` lists what no reader uses any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from closebell.schemas import DATASETS, conform
from closebell.session import stage, staging

VERSION = "version"
COMMIT = "commit"
ATTEMPTS = 10  # of a write that builds on what it has read


class Conflict(RuntimeError):
    """Another write was published since the table was read."""


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """What a missing input reads as: no rows, the right columns."""
    return spark.createDataFrame([], schema)


def path_of(root: str, name: str) -> str:
    return f"{root}/{DATASETS[name].path}"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log with the ``commit`` number of each row, or None when nothing was published yet."""
    try:
        log = spark.read.parquet(f"{path}/log")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.parquet$", 1)
    return log.select("*", number.cast("long").alias(COMMIT))


def _live(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest version of each partition, or None when nothing was published yet. The log
    itself tells by which columns the table is partitioned."""
    log = _log(spark, path)
    if log is None:
        return None
    partitions = [c for c in log.columns if c not in (VERSION, COMMIT)]
    return log.groupBy(*partitions).agg(F.max_by(VERSION, COMMIT).alias(VERSION))


def last_commit(spark: SparkSession, path: str) -> int:
    """The number of the last published write; 0 when there is none."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return 0
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return max((int(n.split(".")[0]) for n in names if n.endswith(".parquet")), default=0)


def _publish(rows: DataFrame, path: str, version: str, base: int | None) -> None:
    """Make ``rows`` the next commit of the log; with ``base``, only if that is still the last one."""
    spark = rows.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    as_path = jvm.org.apache.hadoop.fs.Path
    pending = f"{path}/pending/{version}"
    rows.coalesce(1).write.parquet(pending)
    folder = as_path(pending)
    system = folder.getFileSystem(conf)
    system.mkdirs(as_path(f"{path}/log"))
    [made] = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().endswith(".parquet")]
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    no_options = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        while True:
            number = (last_commit(spark, path) if base is None else base) + 1
            try:  # fails if the target exists
                files.rename(made, files.makeQualified(as_path(f"{path}/log/{number:012d}.parquet")), no_options)
                return
            except Py4JJavaError as taken:
                if "FileAlreadyExistsException" not in str(taken.java_exception):
                    raise
                if base is not None:
                    raise Conflict(f"{path} has changed since commit {base}") from taken
    finally:
        system.delete(folder, True)


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All versions of all rows."""
    return spark.read.schema(
        StructType([*schema.fields, StructField(VERSION, StringType())])
    ).parquet(f"{path}/data")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The published rows of a table, or an empty frame with its schema.

    Filters reach the scan; the join with the log, a row per partition, prunes old versions.
    """
    live = _live(spark, path)
    if live is None:
        return empty(spark, schema)
    rows = _stored(spark, path, schema).join(live, live.columns, "left_semi")
    return rows.select(*schema.fieldNames())


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, path_of(root, name), DATASETS[name].schema)


def stale_versions(
    spark: SparkSession, path: str, schema: StructType, partitions: Sequence[str] = ()
) -> DataFrame:
    """``version, *partitions`` of folders that hold no published rows and may be deleted once
    no reader that began earlier is left."""
    held = _stored(spark, path, schema).select(VERSION, *partitions).distinct()
    live = _live(spark, path)
    return held if live is None else held.join(live, [VERSION, *partitions], "left_anti")


def read_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All Parquet files below ``path``, at any depth, whatever the folders are called."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def register_views(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> None:
    """One temporary view per lake table, for SQL access."""
    for name in names or DATASETS:
        read(spark, root, name).createOrReplaceTempView(name)


def for_symbols(df: DataFrame, symbols: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given symbols: a pushed-down IN list, or a semi join with a frame of them."""
    if not isinstance(symbols, DataFrame):
        return df.where(F.col("symbol").isin(*symbols))
    return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")


def _load(spark, root, name, symbols, start, end) -> DataFrame:
    column = DATASETS[name].date_column
    kind = DATASETS[name].schema[column].dataType.simpleString()
    rows = read(spark, root, name).where(
        F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    )
    return for_symbols(rows, symbols)


def load_ohlcv(spark, root, symbols, start_date, end_date) -> DataFrame:
    return _load(spark, root, "ohlcv_daily", symbols, start_date, end_date)


def load_fundamentals(spark, root, symbols, start_date, end_date) -> DataFrame:
    return _load(spark, root, "fundamentals", symbols, start_date, end_date)


def load_features_daily(spark, root, symbols, start_date, end_date) -> DataFrame:
    return _load(spark, root, "features_daily", symbols, start_date, end_date)


def load_news_norm(spark, root, symbols, start_ts, end_ts) -> DataFrame:
    return _load(spark, root, "news_norm", symbols, start_ts, end_ts)


def write_atomic(
    df: DataFrame,
    path: str,
    schema: StructType,
    partitions: Sequence[str] = (),
    rows_per_file: int = 0,
    keys: Sequence[str] = (),
    base: int | None = None,
) -> None:
    """Replace a table, or with ``partitions`` the partitions that occur in ``df``.

    With ``base`` (see ``last_commit``) the write fails with ``Conflict`` if another one was published
    since; without, the last one to be published counts.

    Rows are rebalanced by partition first: one file instead of one per task for a small
    partition, while adaptive execution splits a partition too large for one task. A null in
    one of ``keys`` fails the job. ``df`` may read the same table.
    """
    spark = df.sparkSession
    rows = conform(df, schema)
    stop = F.raise_error(F.lit(f"null key in a row for {path}"))
    rows = rows.withColumns({
        k: F.when(F.col(k).isNull(), stop.cast(schema[k].dataType)).otherwise(F.col(k))
        for k in keys
    })
    if partitions:
        rows = rows.hint("rebalance", *partitions)
    version = uuid.uuid4().hex
    rows.withColumn(VERSION, F.lit(version)).write.mode("append").option(
        "compression", "zstd"
    ).option("maxRecordsPerFile", rows_per_file).partitionBy(VERSION, *partitions).parquet(
        f"{path}/data"
    )
    if partitions:
        written = _stored(spark, path, schema).where(F.col(VERSION) == version).select(
            VERSION, *partitions
        ).distinct()
    else:
        written = spark.createDataFrame([(version,)], StructType([StructField(VERSION, StringType())]))
    _publish(written, path, version, base)


def replace(df: DataFrame, root: str, name: str) -> None:
    """Replace a whole lake table."""
    dataset = DATASETS[name]
    write_atomic(df, path_of(root, name), dataset.schema, keys=dataset.keys)


def upsert(
    df: DataFrame,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    partitions: Sequence[str],
) -> None:
    """Insert or replace rows by key; rows of other keys stay.

    When every key column is a partition column, replacing the partitions is enough. With a
    coarser layout (one folder per date, or none) a partition also holds rows of other keys,
    which are read from the touched partitions and written back with the new rows.
    """
    spark = df.sparkSession
    new = conform(df, schema)
    if set(keys) <= set(partitions):
        write_atomic(new, path, schema, partitions, keys=keys)
        return
    with staging(spark):
        new = stage(new, "upsert-new")
        for _ in range(ATTEMPTS):
            base = last_commit(spark, path)
            old = read_table(spark, path, schema)
            if partitions:
                old = old.join(new.select(*partitions).distinct(), list(partitions), "left_semi")
            kept = old.join(new.select(*keys), list(keys), "left_anti")
            try:
                write_atomic(kept.unionByName(new), path, schema, partitions, keys=keys, base=base)
                return
            except Conflict:
                continue  # merge with what was published meanwhile
        raise Conflict(f"{path} kept changing during {ATTEMPTS} attempts")


def upsert_bars(df: DataFrame, root: str, partitions: Sequence[str] | None = None) -> None:
    """Upsert bars by (date, symbol). One folder per date unless ``partitions`` says else."""
    dataset = DATASETS["ohlcv_daily"]
    upsert(df, path_of(root, "ohlcv_daily"), dataset.schema, dataset.keys,
           dataset.partitions if partitions is None else partitions)


def upsert_fundamentals(df: DataFrame, root: str) -> None:
    """Upsert statements by (symbol, date)."""
    dataset = DATASETS["fundamentals"]
    upsert(df, path_of(root, "fundamentals"), dataset.schema, dataset.keys, dataset.partitions)


def replace_fundamentals(df: DataFrame, root: str) -> None:
    """Whole replacement, laid out so that one symbol's statements lie together."""
    laid_out = df.repartitionByRange("symbol", "date").sortWithinPartitions("symbol", "date")
    replace(laid_out, root, "fundamentals")


def changed_rows(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of ``new`` that are not stored alike, nulls being equal to nulls."""
    new, stored = new.alias("new"), stored.alias("stored")
    alike = reduce(and_, [
        F.col(f"new.`{c}`").eqNullSafe(F.col(f"stored.`{c}`")) for c in new.columns])
    return new.join(stored, alike, "left_anti")


def save_bucketed(
    df: DataFrame, name: str, buckets: int, by: str = "symbol", order: Sequence[str] = ("symbol", "date"),
    mode: str = "overwrite",
) -> DataFrame:
    """Write a catalog table in buckets of ``by``, sorted inside, and read it.

    Joins and windows by that column, and by it and others, start from the buckets: no shuffle. A
    table that many jobs read by symbol is shuffled once, when it is written.
    """
    rows = df.repartition(buckets, by)  # one file per bucket
    rows.write.mode(mode).bucketBy(buckets, by).sortBy(*order).saveAsTable(name)
    return df.sparkSession.table(name)


def record_run(
    spark: SparkSession, root: str, metrics: DataFrame, started: str, status: str = "FINISHED"
) -> None:
    """Add the metrics of runs to the table of runs; a rerun replaces its own row."""
    dataset = DATASETS["runs"]
    rows = metrics.select(
        "*", F.lit(started).cast("timestamp").alias("start_time"), F.lit(status).alias("status")
    ).select(*dataset.schema.fieldNames())
    upsert(rows, path_of(root, "runs"), dataset.schema, dataset.keys, dataset.partitions)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partitions: Sequence[str] = (),
    where: str | None = None,
    rows_per_file: int = 5_000_000,
) -> None:
    """Rewrite a table, or the partitions ``where`` selects, into few large files. Fails with
    ``Conflict`` if another write is published meanwhile."""
    base = last_commit(spark, path)
    rows = read_table(spark, path, schema)
    rows = rows.where(where) if where else rows
    packed = rows if partitions else rows.hint("rebalance")
    write_atomic(packed, path, schema, partitions, rows_per_file, base=base)


def write_equity_csv(df: DataFrame, path: str) -> None:
    """An equity curve as ``Date, PortfolioValue`` lines with a header."""
    df.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("equity").alias("PortfolioValue")
    ).orderBy("Date").write.mode("overwrite").option("header", True).csv(path)


def read_equity_csv(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    landed = (
        spark.read.schema("Date date, PortfolioValue double").option("header", True).csv(path)
    )
    return landed.select(
        F.lit(run_id).alias("run_id"), F.col("Date").alias("date"),
        F.col("PortfolioValue").alias("equity"),
    )
