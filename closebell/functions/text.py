"""Text expressions. All are native columns except Unicode normalisation."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL pattern, and how missing values read once turned into text.
URL_PATTERN = r"https?://\S+|www\.\S+"
NULL_TEXT = "None"
NULL_TEXT_LOWER = "none"

# Words without meaning for headlines; finance terms are kept on purpose.
LIGHT_STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "its",
    "of", "on", "or", "that", "the", "this", "to", "was", "were", "with",
)


def strip_urls(text: Column) -> Column:
    # (?U): without it \S is ASCII-only in Java and swallows no-break spaces
    return F.regexp_replace(text, "(?U)" + URL_PATTERN, "")


def clean(text: Column, null_as_text: bool = False) -> Column:
    """Lower case without URLs. Null stays null, or reads "none" with ``null_as_text``."""
    cleaned = strip_urls(F.lower(text))
    return F.coalesce(cleaned, F.lit(NULL_TEXT_LOWER)) if null_as_text else cleaned


def article_key(ts: Column, source: Column, title: Column) -> Column:
    """sha256 over time, source and cleaned title.

    Every part is made non-null first: concat with one null is null, which would give
    all articles without a source the same key.
    """
    return F.sha2(
        F.concat(
            F.coalesce(ts.cast("string"), F.lit(NULL_TEXT)),
            F.coalesce(source, F.lit(NULL_TEXT)),
            clean(title, null_as_text=True),
        ),
        256,
    )


def strip_symbols(text: Column) -> Column:
    """Letters, digits and the signs figures need; every run of anything else is one space."""
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}$%.+-]+", " "))


def strip_stopwords(text: Column) -> Column:
    words = F.split(text, r"\s+")
    return F.array_join(F.filter(words, lambda w: ~F.lower(w).isin(*LIGHT_STOPWORDS)), " ")


def unicode_normalised(text: Column, form: str = "NFKC") -> Column:
    """Unicode normal form; Spark has no built-in for it, so Arrow batches go to Python."""

    @F.pandas_udf("string")
    def normalise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda s: unicodedata.normalize(form, s), na_action="ignore")

    return normalise(text)


def metric_label(name: Column) -> Column:
    """``metrics.sharpe_ratio`` -> ``Sharpe Ratio``."""
    return F.initcap(F.replace(F.replace(name, F.lit("metrics."), F.lit("")), F.lit("_"), F.lit(" ")))
