import math
import random
import struct

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from closebell.functions import dates, numbers, text


def _one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def _formatted(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(numbers.fixed2(F.col("x"))).collect()]


def test_fixed2_on_ties_and_neighbours(spark):
    rng = random.Random(3)
    ties = [k / 1000 for k in rng.sample(range(5, 4_000_000, 10), 3000)]
    ties += [0.125, 2.675, 1.005, 0.42500000000000004, 0.065, 0.375, 0.625, 0.005, 0.015, 0.0, -0.0]
    near = [math.nextafter(t, d) for t in ties[:500] for d in (-math.inf, math.inf)]
    values = ties + near + [-t for t in ties] + [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    assert _formatted(spark, values) == ["%.2f" % v for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False, allow_subnormal=False), min_size=50, max_size=200))
def test_fixed2_on_any_floats(spark, values):
    assert _formatted(spark, values) == ["%.2f" % v for v in values]


def test_missing_numbers_become_zero(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.25,)], "x double")
    got = [r[0] for r in df.select(numbers.zero_if_missing(F.col("x"))).collect()]
    assert got == [0.0, 0.0, 0.25]


def test_scores_survive_large_logits(spark):
    logits = F.array(F.lit(1000.0), F.lit(-1000.0), F.lit(999.0))
    sent, conf = numbers.sentiment_scores(logits, ("negative", "neutral", "positive"))
    row = _one(spark, sent=sent, conf=conf)
    e = math.exp(-1)
    assert row.sent == pytest.approx((e - 1) / (e + 1)) and row.conf == pytest.approx(1.0)
    sent, conf = numbers.sentiment_scores(logits, ("positive", "negative", "neutral"))
    assert _one(spark, sent=sent).sent == pytest.approx(1 / (1 + e))


def test_clean_lowers_and_strips_urls(spark):
    row = _one(
        spark,
        a=text.clean(F.lit("See HTTPS://x.Y/z?q=1 and www.News.com/a now")),
        b=text.clean(F.lit("http://a.b Next")),
        c=text.clean(F.lit(None).cast("string")),
        d=text.clean(F.lit(None).cast("string"), null_as_text=True),
    )
    assert row.a == "see  and  now"
    assert row.b == " next"  # a no-break space ends the address, as any space does
    assert row.c is None and row.d == "none"


def test_article_key_keeps_null_parts_apart(spark):
    null = F.lit(None).cast("string")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    row = _one(
        spark,
        a=text.article_key(ts, null, F.lit("One")),
        b=text.article_key(ts, null, F.lit("Two")),
        c=text.article_key(ts, null, F.lit("ONE http://x.y")),
        d=text.article_key(ts, null, F.lit("one ")),
        e=text.article_key(null.cast("timestamp"), null, null),
    )
    assert row.a is not None and row.e is not None and len(row.a) == 64
    assert row.a != row.b and row.c == row.d


def test_symbol_and_stopword_strip(spark):
    row = _one(
        spark,
        a=text.strip_symbols(F.lit("  Profit: +5% (€3.20) — “up” again!")),
        b=text.strip_stopwords(F.lit("The profit of the bank rose in June")),
    )
    assert row.a == "Profit +5% 3.20 up again"
    assert row.b == "profit bank rose June"


def test_unicode_forms(spark):
    row = _one(
        spark,
        a=text.unicode_normalised(F.lit("ﬁne ①")),
        b=text.unicode_normalised(F.lit("é"), "NFC"),
        c=text.unicode_normalised(F.lit(None).cast("string")),
    )
    assert (row.a, row.b, row.c) == ("fine 1", "é", None)


def test_metric_label(spark):
    assert _one(spark, a=text.metric_label(F.lit("metrics.max_drawdown"))).a == "Max Drawdown"


def test_offsets_are_cut_in_utc(spark):
    late = F.lit("2024-03-01T23:30:00-05:00")
    row = _one(spark, a=dates.utc_date(late), b=dates.utc_date(F.lit("soon")), c=dates.utc_date(F.lit("2024-03-01")))
    assert (str(row.a), row.b, str(row.c)) == ("2024-03-02", None, "2024-03-01")
    assert dates.day_part("2024-01-31T23:59:59Z") == "2024-01-31"
    assert dates.days_before("2024-03-01", 30) == "2024-01-31"
