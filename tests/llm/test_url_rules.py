"""URL rules against plain Python: host rules, and mined rules by counting every token set."""

import itertools
import random
import re

from closebell.llm import url_rules as U
from closebell.llm.queries import QUERIES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def by_hand(url, rules=U.HOST_RULES):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


ODD = [None, "", "no scheme", "http://", "http://NET", "http://net/", "https://A.Example.NET/en/x?q#f",
       "http://example.net/enx", "x://example.com/de/?a", "http://example.org/fr/1", "a://b://c/d",
       "http://h?x=/en/", "http://exampleénet/", "http://xnet/", "http://u:p@m.net:80/", "ftp://a.org/FR/"]


def test_host_rules(spark):
    pages = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in U.judge(pages, labels).collect()}
    assert len(got) == len(ODD)
    for i, url in enumerate(ODD):
        host, path, rule, verdict = by_hand(url)
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), url


def mined_by_counting(rows, min_count, min_confidence, min_lift):
    """Minimal token sets of up to four tokens, from all subsets of every transaction."""
    n, bad = len(rows), sum(b for _, b in rows)
    seen, hits = {}, {}
    for tokens, is_bad in rows:
        for k in range(1, 5):
            for c in itertools.combinations(sorted(tokens), k):
                seen[c] = seen.get(c, 0) + 1
                hits[c] = hits.get(c, 0) + is_bad
    good = {frozenset(c) for c, h in hits.items()
            if h >= min_count and h / seen[c] >= min_confidence
            and h / seen[c] / (bad / n) >= min_lift}
    return {c for c in good if not any(o < c for o in good)}


def labelled_pages(n=400):
    rng, rows = random.Random(5), []
    for i in range(n):
        words = rng.sample(["casino", "win", "news", "blog"], 2)
        words.sort()
        bad = ({"casino", "win"} == set(words) and rng.random() < 0.95) or rng.random() < 0.1
        rows.append((i, f"http://{words[0]}.test/{words[1]}", bad))
    return rows


def test_mined_rules(spark):
    rows = labelled_pages()
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame(
        [(i, 1, int(b)) for i, _, b in rows] + [(0, None, None), (10**6, 0, 1)],
        "doc_id long, quality int, toxic int")
    mined = U.mine(U.labelled(pages, labels), min_count=10).collect()
    plain = [({f"h:{u.split('/')[2].split('.')[0]}", "h:test", f"p:{u.split('/')[3]}"}, b)
             for _, u, b in rows]
    assert {frozenset(r.tokens) for r in mined} == mined_by_counting(plain, 10, 0.8, 1.5) != set()
    verdicts = {r.page_id: r.verdict for r in U.judge(pages, labels, min_count=10).collect()}
    for i, url, _ in rows:
        assert verdicts[i] == ("block" if "casino" in url and "win" in url else "allow")


def test_no_labels_no_pages(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), labels).count() == 0
    copies = spark.createDataFrame(
        [(1, "http://a.net/", 3), (1, "http://a.net/", 3)], "page_id long, url string, host int")
    assert [r.verdict for r in U.judge(copies, labels).collect()] == ["block", "block"]


def test_whole_query(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id", "url").collect()}
    got = QUERIES["op5_url_rules"](spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = by_hand(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict:
            assert r.verdict == verdict
        else:
            assert r.verdict == ("block" if r.mined_rule is not None else "allow")
