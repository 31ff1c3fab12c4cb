"""URL filters (5): host rules first; for the other urls, association rules that Spark's FP-growth mines
from labelled urls. Rules are pruned by support and confidence and matched through an inverted index
from their rarest token class."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenloom.llm.common import ascii_lower, table

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Share of the labelled urls that a token combination must have, and the share of blocked ones among those.
MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.6
#: Fewest bad urls that must show a combination, whatever their share: so with fewer labels there are no rules.
MIN_COUNT = 25


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict); null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels and whole path parts, digits as #; query keys; the scheme."""
    host, path = host_of(url), path_of(url)
    plain = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    parts = lambda c, sep, mark: F.transform(F.filter(F.split(plain(c), sep), lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, r"(?s)^([^=]*)", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    return F.array_distinct(F.concat(parts(host, "[.]", "h:"), parts(path, "/", "p:"), keys, scheme))


def _token_classes(known: DataFrame, need: int) -> DataFrame:
    """known(row, bad, tokens) to (token, cls, n, n_bad) of the tokens in at least `need` bad urls. Tokens that stand in
    the same urls are one class, named by the least of them; two 64-bit sums over those urls tell."""
    rows = known.select("bad", F.xxhash64("row").cast("decimal(20,0)").alias("a"), F.xxhash64("row", F.lit(5)).cast("decimal(20,0)").alias("b"), F.explode("tokens").alias("token"))
    sums = rows.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("n_bad") >= need)
    sums = table(sums, "url-tokens")
    names = sums.groupBy("n", "n_bad", "a", "b").agg(F.min("token").alias("cls"))
    return table(sums.join(names, ["n", "n_bad", "a", "b"]).select("token", "cls", "n", "n_bad"), "url-token-classes")


def _held(tokens: DataFrame, key: str, classes: DataFrame) -> DataFrame:
    """tokens(key, tokens) to (key, held): the classes that each has a token of."""
    parted = tokens.select(key, F.explode("tokens").alias("token")).join(classes.select("token", "cls"), "token")
    return parted.groupBy(key).agg(F.collect_set("cls").alias("held"))


def _fits(held: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """(key, rule columns) for each rule all of whose classes are held. Rules are indexed by their rarest class."""
    met = held.select(key, "held", F.explode("held").alias("rarest")).join(rules, "rarest")
    return met.where(F.forall("classes", lambda c: F.array_contains("held", c))).drop("held", "rarest")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """labelled(url, bad boolean) to token classes and rules (rarest, classes, confidence, support): a url with a token
    of each class is bad with that confidence. A rule has at least `min_count` bad urls and the share `min_support`
    of all; fewer labels give no rules. Null urls and labels are left out; repeated rows count.

    A class that is a rule by itself is not combined, as its combinations block no further url, and tokens that
    always stand together are one class; so what FP-growth combines are a url's tokens that say too little alone."""
    plain = labelled.where("url is not null and bad is not null").select(F.col("url").cast("string").alias("url"), "bad").withColumn("row", F.monotonically_increasing_id())
    known = table(plain.select("row", "bad", tokens_of(F.col("url")).alias("tokens")), "labelled-urls")
    n, n_bad = known.agg(F.count("*"), F.count_if("bad")).first()
    need = max(min_count, math.ceil(min_support * n), 1)
    classes = _token_classes(known, need)
    each = classes.groupBy("cls").agg(F.first("n").alias("n"), F.first("n_bad").alias("n_bad"))
    confidence = (F.col("n_bad") / F.col("n")).alias("confidence")
    alone = each.where(F.col("n_bad") >= min_confidence * F.col("n")).select(F.col("cls").alias("rarest"), F.array("cls").alias("classes"), confidence, (F.col("n_bad") / F.lit(max(n, 1))).alias("support"))
    if n_bad < need:
        return classes, alone
    weak = classes.where(F.col("n_bad") < min_confidence * F.col("n"))
    held = table(_held(known.select("row", "tokens"), "row", weak), "url-classes")
    bad = held.join(known.where("bad").select("row"), "row", "left_semi").select(F.col("held").alias("items"))
    # Trees are grown for groups of classes apart; by default there would be as many tasks as files of bad urls, often one.
    tasks = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    growth = FPGrowth(minSupport=min(1.0, (need - 0.5) / n_bad), minConfidence=1.0, itemsCol="items", numPartitions=tasks)
    found = growth.fit(table(bad, "bad-urls")).freqItemsets.where("size(items) > 1")
    sets = found.select(F.array_sort("items").alias("classes"), F.col("freq").alias("n_bad"))
    rarest = sets.select("classes", "n_bad", F.explode("classes").alias("cls")).join(each.select("cls", "n"), "cls").groupBy("classes", "n_bad").agg(F.min_by("cls", F.struct("n", "cls")).alias("rarest"))
    rarest = table(rarest, "url-itemsets")
    counted = _fits(held, "row", rarest).groupBy("classes", "n_bad").agg(F.count("*").alias("n"))
    good = counted.where(F.col("n_bad") >= min_confidence * F.col("n")).join(rarest.select("classes", "rarest"), "classes")
    return classes, alone.union(good.select("rarest", "classes", confidence, (F.col("n_bad") / F.lit(n)).alias("support")))


def match(urls: DataFrame, classes: DataFrame, rules: DataFrame) -> DataFrame:
    """urls(url) to (url, confidence): the distinct urls that some rule fits, with the best rule's confidence."""
    held = _held(urls.distinct().select("url", tokens_of(F.col("url")).alias("tokens")), "url", classes)
    return _fits(held, "url", rules).groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, confidence (of the mined rule that decided, else
    null). labelled(url, bad).

    The longest fitting host rule decides; else a mined rule blocks; else the url is allowed. A null url,
    or one without ://, has an empty host and path and is allowed unless mined rules fit; without
    labelled urls nothing is mined. Repeated rows give repeated rows; other columns are ignored."""
    url = F.col(url_col).cast("string")
    parted = pages.select(F.col(id_col), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    classes, mined = mine_rules(labelled, min_support, min_confidence, min_count)
    open_urls = parted.where("ruled is null and url is not null").select("url")
    blocked = table(match(open_urls, classes, table(mined, "url-rules")), "blocked-urls")
    return parted.join(blocked, "url", "left").select(
        id_col, "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("confidence")).alias("confidence"))
