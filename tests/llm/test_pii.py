"""Personal data: patterns as stated, and what the skip chains add."""

import hashlib
import random
import re

from closebell.llm import pii as P
from closebell.llm.queries import QUERIES

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated(text):
    """The patterns word for word, matches that fail dropped."""
    found = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and P.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


def test_patterns_on_random_text():
    rng = random.Random(7)
    pieces = ["@", ".", "-", " ", "+", "(", ")", "1", "22", "255", "256", "4111111111111111", "a", "é",
              "b.c", "x@y.zz", "10.0.0.1", "+49 30 1234567", "%", "\n", "٣", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(text) == stated(text), text


def test_chains_add_what_repeats(spark):
    field = P.fit([f"call +1 (974) 555-{i:04d} or write a{i}@b.example" for i in range(200)])
    text = "call +1 (974) 555-3436 now. later 974-555-3436, 12345678 or 555-3436."
    added = [text[s:e] for _, s, e, base in P.pii_spans(text, field) if not base]
    assert added == ["974-555-3436", "555-3436"]
    assert P.pii_spans("5551234 and 5551234", field) == []  # nothing observed, nothing added
    assert P.pii_spans(None, field) == P.pii_spans("", field) == []
    unfitted = P.fit([])
    assert [s[3] for s in P.pii_spans(text, unfitted)][0]


def test_grouped_numbers_are_linked_and_every_candidate_is_decoded():
    field = P.fit([f"call +1 (974) 555-{i:04d} or write a{i}@b.example" for i in range(200)]
                  + [f"pay with 4111 1111 1111 1111 or at +49 30 {i:04d} 5678" for i in range(50)])

    def added(text):
        return [text[s:e] for _, s, e, base in P.pii_spans(text, field) if not base]

    assert added("call +49 30 1234 5678 now, later 030 1234 5678 or in 2020 1234 5678") == [
        "030 1234 5678", "1234 5678"]
    assert added("card 4111 1111 1111 1111 and then 4111.1111.1111.1111 again") == [
        "4111.1111.1111.1111"]
    assert added("call +1 555 123 4567 now, later (555) 123-4567 and 123 4567.") == [
        "(555) 123-4567", "123 4567"]
    # no pattern's match in the document
    assert added("call 974-555-3436 now, later 974-555-3436 again") == ["974-555-3436"] * 2
    assert added("about 12345678 since 2021-03-17 and 2021-03-17, 5551234 or 12 34 56") == []


def test_message_passing_equals_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    n = len(P.LABELS)
    field = P.Field(rng.normal(size=(P.N_FEATURES, n)), rng.normal(size=(n, n)),
                    (lambda s: s + s.T)(rng.normal(size=(n, n))))
    g = P.Graph([(0, 1)] * 4, [[0, 3], [0, 5], [0], [0, 7]], np.array([-1, 2, -1, -1]),
                np.array([[0, 1], [1, 2]]), np.array([[1, 3]]))  # a tree: exact
    total = np.zeros((4, n))
    for y in itertools.product(range(n), repeat=4):
        if y[1] != 2:
            continue
        score = sum(field.node[f, y[i]].sum() for i, f in enumerate(g.features))
        score += sum(field.chain[y[a], y[b]] for a, b in g.chain)
        score += sum(field.skip[y[a], y[b]] for a, b in g.skip)
        for i in range(4):
            total[i, y[i]] += np.exp(score)
    assert np.allclose(P.marginals(g, field, rounds=500), total / total.sum(axis=1, keepdims=True),
                       atol=1e-3)


def test_long_texts_end():
    field = P.Field.prior()
    for text in ("9" * 300_000, "a" * 300_000 + "@", "@a" * 100_000, "+1" + "(" * 200_000,
                 "x 5551234 " * 30_000 + "+1 5551234"):
        P.pii_spans(text, field)


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a@b.cd", 2, 3)], "doc_id long, text string, pii int, kind int")
    row = P.find(docs, P.Field.prior()).first()
    assert row.kind == 3 and row.pii[0].kind == "email"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.find(empty, P.train(empty)).count() == 0


def test_whole_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op3_pii"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        base, r = stated(text), got[d]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == k for s in base) for k in P.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_long_runs_of_numbers_take_linear_time():
    """A table of numbers is one run of digit groups; links and messages grow with it, no faster."""
    import time

    def seconds(n):
        text = " ".join(str(i * 7919 % 100_000) for i in range(n))
        start = time.process_time()
        g = P.graph(text, P.base_spans(text))
        P.marginals(g, P.Field.prior(), rounds=3)
        return time.process_time() - start

    seconds(500)
    assert seconds(24_000) < 14 * seconds(4_000)


def test_messages_do_not_depend_on_how_edges_are_cut(monkeypatch):
    text = "call 974-555-3436 or +1 974 555 3436, mail a.b@c.de; later 974 555 3436 and a.b@c.de " * 5
    g = P.graph(text, P.base_spans(text))
    whole = P.marginals(g, P.Field.prior())
    monkeypatch.setattr(P, "_EDGES_AT_ONCE", 3)
    assert (P.marginals(g, P.Field.prior()) == whole).all()
