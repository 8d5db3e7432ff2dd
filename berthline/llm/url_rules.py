"""URL verdicts: given rules by host and path, and association rules mined from what they label.

1. A URL is cut into tokens: scheme, host labels, path segments, query pairs, fragment.
2. The given rules label the URLs they fit.  Spark's FP-growth mines the frequent token combinations of all
   distinct URLs, labelled or not, with the label as one more item.  A combination that occurs with a label
   often enough (support) and in nearly all of its URLs (confidence) is an association rule.  URLs
   without a label count against a rule, so it says more than that no other URL of its kind was labelled.
3. Rules are matched by an inverted index: each is posted under its rarest token, joined to the URLs
   that have this token, and kept if all its other tokens are there.  The surest rule decides; without one a URL is allowed.

A URL is mined and judged once however often it occurs, so a hot URL is one transaction and one match.  All its frequent
tokens are mined.  FP-growth lists all their subsets, so tokens that the same URLs have are mined as one, the last in text order:
a combination with others of them has the same URLs and labels, and an evidence before it.  A caller may ask for fewer
features by `tokens_per_url`, those that tell most about the labels.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from berthline.llm.base import keep

# scheme, host, path, query, fragment
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# URLs that must have a combination with its label: so many, and so many in a thousand of all.
LEAST_URLS = 8
LEAST_PER_MILLE = 5
# Per cent of a combination's URLs that must have the label.
CONFIDENCE = 90
# Tokens of a URL that the SQL lists the subsets of; the operator has no such bound unless it is asked for.
TOKENS_PER_URL = 10
LABEL = "!"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def tokens_of(url: Column) -> Column:
    """All different tokens of a URL; none without `://`."""
    whole = F.regexp_extract(url, URL, 0)
    scheme, host, path, query, fragment = (F.regexp_extract(url, URL, n) for n in range(1, 6))

    def marked(kind: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(kind), w))

    lists = [
        marked("s:", F.array(F.translate(scheme, UPPER, LOWER))),
        marked("h:", F.split(F.translate(host, UPPER, LOWER), r"\.")),
        marked("p:", F.split(path, "/")),
        marked("q:", F.split(query, "&")),
        marked("f:", F.array(fragment)),
    ]
    return F.when(whole != "", F.array_distinct(F.concat(*lists))).otherwise(F.array().cast("array<string>"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) of rules stated in code."""
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule))) for rule in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("rule")).select("rule.*")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) for each of the distinct `urls` (url, host, path) that a rule fits: the longest, ties to the last in text order.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    told = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), F.col("verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = urls.select("url", "path", F.explode(suffixes).alias("suffix")).join(told, "suffix").filter(F.startswith("path", "start"))
    text = F.concat("suffix", "start")
    best = F.max(F.struct(F.length(text).alias("length"), text.alias("rule"), "verdict"))
    return met.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def mine(
    urls: DataFrame,
    least_urls: int = LEAST_URLS,
    least_per_mille: int = LEAST_PER_MILLE,
    confidence: int = CONFIDENCE,
    tokens_per_url: int | None = None,
) -> DataFrame:
    """(tokens, verdict, hits, n, rarest): association rules of the distinct `urls` (url, tokens, verdict; null: no label).

    Of tokens that the same URLs have only the last in text order is named, unless `tokens_per_url` bounds a URL's tokens.
    tokens: sorted; n: URLs with all of them; hits: those with the verdict; rarest: the token of fewest URLs, ties to the first in text order.
    """
    spark = urls.sparkSession
    sums = urls.groupBy("verdict").count().collect()
    total = sum(r["count"] for r in sums)
    labels = {r["verdict"]: r["count"] for r in sums if r["verdict"] is not None}
    if not labels:
        return spark.createDataFrame([], "tokens array<string>, verdict string, hits long, n long, rarest string")
    least = max(least_urls, -(-total * least_per_mille // 1000))
    each = urls.select("url", "verdict", F.explode("tokens").alias("token"))
    # How far a token's URLs are from having the labels that all URLs have.
    with_label = {v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).cast("double") for v in labels}
    n = F.count("*").cast("double")
    apart = [F.abs(hits * F.lit(float(total)) - n * F.lit(float(labels[v]))) for v, hits in with_label.items()]
    telling = F.greatest(*apart) if len(apart) > 1 else apart[0]
    # 128 bits that tell which URLs have a token.
    extents = [F.bit_xor(F.xxhash64(*salt, "url")).alias(name) for name, salt in (("mark", []), ("other_mark", [F.lit(1)]))]
    counts = each.groupBy("token").agg(F.count("*").alias("urls"), telling.alias("telling"), *extents).filter(F.col("urls") >= least)
    if tokens_per_url is None:
        counts = counts.groupBy("urls", "mark", "other_mark").agg(F.max(F.struct("token", "telling")).alias("last")).select("last.token", "urls", "last.telling")
    counts = keep(counts.select("token", "urls", "telling"), "tokens")
    held = each.join(counts, "token").groupBy("url", "verdict").agg(F.sort_array(F.collect_list(F.struct((-F.col("telling")).alias("down"), "token"))).alias("held"))
    chosen = F.transform("held" if tokens_per_url is None else F.slice("held", 1, tokens_per_url), lambda t: t["token"])
    label = F.when(F.col("verdict").isNotNull(), F.array(F.concat(F.lit(LABEL), F.col("verdict")))).otherwise(F.array().cast("array<string>"))
    transactions = keep(held.select(F.concat(chosen, label).alias("items")), "transactions")
    n_transactions = transactions.count()
    if not n_transactions:
        return spark.createDataFrame([], "tokens array<string>, verdict string, hits long, n long, rarest string")
    # Half a URL less, since the miner rounds the share of a whole count up.
    miner = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, (least - 0.5) / n_transactions)), minConfidence=confidence / 100)
    miner.setNumPartitions(int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = keep(miner.fit(transactions).freqItemsets.filter(F.col("freq") >= least), "itemsets")
    marks = F.filter("items", lambda t: F.startswith(t, F.lit(LABEL)))
    sets = found.select(F.sort_array(F.filter("items", lambda t: ~F.startswith(t, F.lit(LABEL)))).alias("tokens"), F.substring(F.get(marks, F.lit(0)), 2, 1 << 30).alias("verdict"), "freq")
    hits = sets.filter("verdict is not null and size(tokens) > 0").withColumnRenamed("freq", "hits")
    whole = sets.filter("verdict is null").select("tokens", F.col("freq").alias("n"))
    rules = hits.join(whole, "tokens").filter(F.col("hits") * 100 >= F.col("n") * confidence)
    rare = rules.select("tokens", F.explode("tokens").alias("token")).distinct().join(counts, "token")
    rare = rare.groupBy("tokens").agg(F.min(F.struct("urls", "token"))["token"].alias("rarest"))
    return keep(rules.join(rare, "tokens").select("tokens", "verdict", "hits", "n", "rarest"), "rules")


def matched(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """(url, verdict, evidence) for the distinct `urls` (url, tokens) that a mined rule fits: the surest, then the most frequent, ties to the last in text order."""
    posted = mined.withColumnsRenamed({"rarest": "token", "tokens": "needed"})
    met = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(posted, "token")
    met = met.filter(F.size(F.array_except("needed", "tokens")) == 0)
    sure = F.struct((F.col("hits").cast("double") / F.col("n").cast("double")).alias("sure"), "hits", "verdict", F.array_join("needed", " ").alias("evidence"))
    return met.groupBy("url").agg(F.max(sure).alias("best")).select("url", "best.verdict", "best.evidence")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", page_id: str = "page_id", url: str = "url", **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict, evidence) for every row of `pages`.

    rule: the given rule that decides, as host and path, else null.  evidence: the tokens of the mined rule that
    decides, else null.  verdict: the given rule's, else the mined rule's, else `otherwise`.
    Null URLs and URLs without `://` have an empty host and path and no token, so they get `otherwise`.  Repeated rows are
    repeated in the result; an empty table gives none; without labelled URLs nothing is mined; other columns are not read.
    """
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    urls = named.filter("url is not null").select("url").distinct()
    urls = keep(urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens_of(F.col("url")).alias("tokens")), "urls")
    given = ruled(urls, rules)
    labelled = keep(urls.join(given, "url", "left"), "labelled")
    mined = mine(labelled.select("url", "tokens", "verdict"), **limits)
    guessed = matched(labelled.filter("rule is null"), mined).withColumnRenamed("verdict", "guess")
    decided = labelled.join(guessed, "url", "left").select("url", "host", "path", "rule", F.coalesce("verdict", "guess", F.lit(otherwise)).alias("verdict"), "evidence")
    told = named.join(decided, "url", "left")
    return told.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"), "evidence")
