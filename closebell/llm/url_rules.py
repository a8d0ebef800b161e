"""URL filters: host rules by hand, and association rules mined from labelled pages.

URL tokens of labelled pages and their label are the transactions of Spark's FP-growth. Rules
``tokens -> bad`` that reach the support and the confidence become blocking rules; of these only
minimal ones stay. Pages are matched through an inverted index from token to rules: a rule fires
when all its tokens are found. Everything is DataFrame code.

Defined results: a null url, or one without ``://``, has empty host and path, no tokens and no rule,
and is allowed. Repeated urls are judged once and joined back, so copies share the verdict. Without
labelled pages nothing is mined. A page with several labels is bad if one of them is. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebell.session import stage

# verdict, host, path
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(rest(url), "^[^/?#]*([^?#]*)", 1)


def host_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = HOST_RULES
) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one. The list is short and
    stated by hand, so it is an expression, not a join."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fits = [
        ((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ranked
    ]
    rule = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ranked)])
    verdict = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ranked)])
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct lower-case words of the url, marked by the part they stand in."""
    after = F.lower(rest(url))
    parts = {
        "h": F.regexp_extract(after, "^[^/?#]*", 0),
        "p": F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1),
        "q": F.regexp_extract(after, "(?s)[?#].*$", 0),
    }

    def marked(part: str, text: Column) -> Column:
        found = F.filter(F.split(text, "[^a-z0-9]+"), lambda w: w != "")
        return F.transform(found, lambda w: F.concat(F.lit(f"{part}:"), w))

    return F.array_distinct(F.concat(*[marked(p, t) for p, t in parts.items()]))


def labelled(pages: DataFrame, labels: DataFrame, page_id: str = "page_id") -> DataFrame:
    """``items``: url tokens and the label of every labelled page."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    verdicts = labels.groupBy(F.col("doc_id").alias(page_id)).agg(
        F.max(F.coalesce(bad, F.lit(False))).alias("_bad"))
    return pages.select(page_id, "url").join(verdicts, page_id).select(
        F.concat(
            tokens(F.col("url")), F.array(F.when(F.col("_bad"), BAD).otherwise("label:good"))
        ).alias("items")
    )


def mine(
    transactions: DataFrame, min_share: float = 0.002, min_count: int = 25,
    min_confidence: float = 0.8, min_lift: float = 1.5,
) -> DataFrame:
    """``rule_id, tokens, confidence, support``: minimal rules whose consequent is bad.

    Support is at least ``min_share`` of the transactions and ``min_count`` of them. FP-growth
    brings the frequent single tokens to the driver, of which there are at most the mean number
    of tokens in a url divided by ``min_share``.
    """
    spark = transactions.sparkSession
    schema = "rule_id long, tokens array<string>, confidence double, support double"
    n = transactions.count()
    if not n:
        return spark.createDataFrame([], schema)
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(min_share, min_count / n)),
        minConfidence=min_confidence,
    ).fit(transactions)
    found = model.associationRules.where(
        (F.element_at("consequent", 1) == BAD) & (F.col("lift") >= min_lift)
        & ~F.array_contains("antecedent", "label:good")
    ).select(F.sort_array("antecedent").alias("tokens"), "confidence", "support")
    found = found.withColumn("rule_id", F.xxhash64("tokens"))
    # a rule is not minimal if another one's tokens are all among its own: by inverted index
    listed = found.select("rule_id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    inside = listed.alias("s").join(listed.alias("l"), "token").where("s.n < l.n").groupBy(
        F.col("s.rule_id").alias("small"), F.col("l.rule_id").alias("rule_id")
    ).agg(F.count("*").alias("hits"), F.max("s.n").alias("n")).where("hits = n")
    return found.join(inside, "rule_id", "left_anti").select(
        "rule_id", "tokens", "confidence", "support")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule_id, confidence``: the strongest rule that fires on each distinct url, for those
    that have one. Tokens meet the rules in the inverted index before anything is shuffled by url."""
    index = rules.select(
        "rule_id", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    held = urls.select("url", F.explode(tokens(F.col("url"))).alias("token"))
    fired = held.join(index, "token").groupBy("url", "rule_id").agg(
        F.count("*").alias("hits"), F.max("n").alias("n"), F.max("confidence").alias("confidence")
    ).where("hits = n")
    return fired.groupBy("url").agg(
        F.max(F.struct("confidence", "rule_id")).alias("_best")
    ).select("url", "_best.rule_id", "_best.confidence")


def judge(
    pages: DataFrame, labels: DataFrame, page_id: str = "page_id",
    rules: Sequence[tuple[str, str, str]] = HOST_RULES, **mining,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule`` for every page: the host rule's verdict
    where one fits, else block if a mined rule fires, else allow."""
    mined = stage(mine(labelled(pages, labels, page_id), **mining), "url-rules")
    urls = pages.select("url").where("url is not null").distinct()
    fired = match(urls, mined).select("url", F.col("rule_id").alias("mined_rule"))
    rule, verdict = host_rule(F.col("host"), F.col("path"), rules)
    return pages.select(page_id, "url").join(fired, "url", "left").select(
        page_id, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "mined_rule"
    ).select(
        page_id, F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "mined_rule",
    ).select(
        page_id, "host", "path", rule.alias("rule"),
        F.coalesce(
            verdict, F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
        ).alias("verdict"),
        "mined_rule",
    )
