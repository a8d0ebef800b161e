"""Quality rules judged per document and per host.

Every document gets rule statistics over its whole text. Rule failures are counted per host, a
host's failure rate is shrunk towards the corpus by an empirical beta prior, and the verdict on
the host is joined back to its documents.

Defined results: a null or empty text has no words and fails. A null host counts as the host
``''``. An empty table gives an empty result. Repeated rows are judged one by one. Extra columns
stay; ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
``base_failed``, ``rule_failed``, ``host_rate`` and ``kept`` are replaced if they exist.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from closebell.session import stage

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """The five statistics of one text. ``bytes.split`` cuts at exactly the six ASCII spaces."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return 0, 0, len(raw) - len(raw.translate(None, _SYMBOLS)), 0, 0
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    seen = Counter(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(seen) < len(words) - 2:
        end = 0  # words before this position are counted already
        for i, window in enumerate(zip(words, words[1:], words[2:])):
            if seen[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


@F.pandas_udf(StructType([StructField(c, LongType()) for c in STATS]))
def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=STATS, dtype="int64")


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five statistics, from one pass over the texts."""
    kept = [c for c in docs.columns if c not in STATS]
    return docs.select(*kept, _stats(F.col(text)).alias("_s")).select(*kept, "_s.*")


def base_failure(min_words: int = 50, max_repeated_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words")
    )


def rule_failure(min_words: int = 50, max_repeated_percent: int = 50) -> Column:
    """Any rule failed: the base ones, symbols over a tenth of the word characters, or mean
    word length outside 2 to 20."""
    return (
        base_failure(min_words, max_repeated_percent)
        | (10 * F.col("n_symbols") > F.col("word_chars"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 20 * F.col("n_words"))
    )


def host_rates(judged: DataFrame, host: str = "_host", failed: str = "rule_failed") -> DataFrame:
    """``host, n_docs, n_failed, host_rate``: the posterior mean of each host's failure rate.

    The beta prior has the corpus failure rate as mean and the strength that the spread of the
    hosts' rates calls for (method of moments, between 1 and a million documents). Counts are
    combined before the shuffle, so a host with a third of all rows is as cheap as any other;
    one row of four sums reaches the driver.
    """
    hosts = judged.groupBy(host).agg(
        F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
        F.sum(F.col("n_docs") * rate * rate).alias("square"), F.count("*").alias("hosts"),
    ).first()
    mean = total.f / total.n if total.n else 0.5
    spread = total.square / total.n - mean * mean if total.n else 0.0
    # what binomial sampling alone adds to the weighted spread
    noise = mean * (1 - mean) * total.hosts / total.n if total.n else 0.0
    between = spread - noise
    strength = mean * (1 - mean) / between - 1 if between > 0 else 1e6
    strength = min(max(strength, 1.0), 1e6)
    posterior = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", posterior)


def judge(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_host_rate: float = 0.5,
    min_words: int = 50,
    max_repeated_percent: int = 50,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``carry`` columns, statistics, ``base_failed``, ``rule_failed``, ``host_rate``, ``kept``.

    A document is kept unless it fails a base rule or its host's shrunk failure rate is above
    ``max_host_rate``. Texts are read once: statistics go to a staged table without them, which
    both the host counts and the result read.
    """
    hosted = docs.select(*carry, F.col(host).alias("_host"), F.col(text).alias("_text"))
    stats = with_stats(hosted, "_text").drop("_text").withColumns({
        "_host": F.coalesce(F.col("_host").cast("string"), F.lit("")),
        "base_failed": base_failure(min_words, max_repeated_percent),
        "rule_failed": rule_failure(min_words, max_repeated_percent),
    })
    stats = stage(stats, "host-quality")
    rates = host_rates(stats).select("_host", "host_rate")
    return stats.join(rates, "_host").withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)
    )


def keep_good(docs: DataFrame, host: str = "source", text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns. Rows with one ``doc_id``
    stay or go by their own text: the verdict is computed beside the text, not joined by id."""
    max_rate = rules.pop("max_host_rate", 0.5)
    verdicts = judge(docs, host, text, max_rate, carry=(), **rules)
    bad = verdicts.where(F.col("host_rate") > max_rate).select("_host").distinct()
    bad = stage(bad, "bad-hosts")  # its size is known before the texts would be shuffled to meet it
    # whole rows travel as one column, so that no name of theirs can clash
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), _stats(F.col(text)).alias("_s"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
    ).select("_row", "_host", "_s.*")
    good = rows.where(~base_failure(**rules)).join(bad, "_host", "left_anti")
    return good.select("_row.*")
