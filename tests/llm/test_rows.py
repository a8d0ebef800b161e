"""Row keys: equal rows share one, all others do not; dropping and deduplicating by key."""

from pyspark.sql import functions as F

from closebell.llm import rows as R
from closebell.llm.words import parts


def test_keys_tell_rows_apart(spark):
    values = [(1, "a", None), (1, None, "a"), (None, "a", "a"), (1, "a", ""), (1, "=", None), (1, "-", None), (11, "", None),
              (1, "1", None), (1, "a", None)]
    docs = spark.createDataFrame(values, "doc_id long, text string, `_key` string").withColumn(
        "tags", F.array(F.col("text"))).withColumn("odd.name", F.lit(None).cast("double"))
    keyed = R.keyed(docs)
    assert keyed.select("_key").distinct().count() == len(values) - 1
    assert keyed.select("_row.*").columns == docs.columns
    again = {r[0] for r in R.keyed(docs.repartition(5)).select("_key").collect()}
    assert again == {r[0] for r in keyed.select("_key").collect()}


def test_without_keeps_one_of_each_repeated_row(spark):
    docs = spark.createDataFrame([(i % 7, "t" * (i % 7)) for i in range(70)], "doc_id long, text string")
    keyed = R.keyed(docs)
    of = lambda *ids: keyed.where(F.col("_row.doc_id").isin(*ids)).select("_key").distinct()
    left = R.without(keyed, of(1, 2), of(3)).select("_row.*").groupBy("doc_id").count()
    assert {r.doc_id: r["count"] for r in left.collect()} == {0: 10, 3: 1, 4: 10, 5: 10, 6: 10}
    assert R.without(keyed, of(99), of(99)).count() == 70


def test_parts_of_a_text_hold_all_its_words():
    raw = b" ab  cde\nf " * 50 + b"x" * 100 + b" tail"
    for size in (1, 7, 64, 10_000):
        found = list(parts(raw, size))
        assert b"".join(found) == raw
        assert [w for p in found for w in p.split()] == raw.split()
    assert list(parts(b"")) == [b""]
