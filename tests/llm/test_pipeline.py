"""The whole pipeline against its stages done plainly, and registered queries against their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline
from closebell.llm import decontaminate, mixing, secrets
from closebell.llm.host_quality import text_stats
from closebell.llm.queries import MIX, ORACLES, QUERIES
from oracle_check import compare, connect
from tests.llm.test_mixing import plan
from tests.llm.test_simhash import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_pipeline_equals_its_stages_done_plainly(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    kept = []
    for r in rows:
        n, _, _, _, repeated = text_stats(r["text"])
        if n >= 50 and 100 * repeated <= 50 * n:
            kept.append(r)
    classes = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in kept])}
    kept = [r for r in kept if classes[r["doc_id"]] == r["doc_id"]]
    items = [(r.item_id, decontaminate.normalise(r.text))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index([x for x in items if len(x[1]) >= decontaminate.MIN_BYTES], 0.1)
    bad = {t for t, *_ in decontaminate.find(index, [decontaminate.normalise(r["text"]) for r in kept])}
    kept = [r for i, r in enumerate(kept) if i not in bad]
    for r in kept:
        clean = secrets.masked(r["text"])
        if clean != r["text"]:
            r["text"], r["n_chars"] = clean, len(clean)
    sized = [(r["doc_id"], (f"domain{int(r['source'][3:]) % 4}", r["lang"], r["source"]),
              text_stats(r["text"])[0]) for r in kept]
    total = int(sum(t for *_, t in sized) * MIX["fraction"])
    want = plan(sized, MIX["weights"], total, MIX["max_epochs"], MIX["seed"])
    by_id = {r["doc_id"]: r for r in kept}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.epoch): r.taken for r in got} == want
    for r in got:
        whole = by_id[r.doc_id]["text"]
        assert whole.startswith(r.text) and text_stats(r.text)[0] == r.taken
        assert r.n_chars == by_id[r.doc_id]["n_chars"]
    assert 0 < len(kept) < len(rows) and bad


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][-1].startswith("mixing")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
