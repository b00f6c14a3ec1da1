"""URL filters: fixed host and path rules, and association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import ready, stored, tasks
from pressloom.operators.duplicates import free_name

#: a rule with more items is compared with its parts by an inverted index; it decides the work only
NAMED_ITEMS = 8
#: the item that stands for the label; tokens have a mark of their part before them
BAD = "bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "rule_id bigint, items array<string>, confidence double, support double"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule is (verdict, host with path), as ("block", "example.com/de/"). It fits its host and all subdomains, if the path
    starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: labels of the host, words of the path that are not numbers, each marked by its part."""
    name, rest = host(url), path(url)
    labels = F.filter(F.split(name, r"[.\-]"), lambda t: t != "")
    words = F.filter(F.split(F.lower(rest), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), lambda t: (t != "") & ~t.rlike("^[0-9]+$"))
    return F.array_distinct(
        F.concat(
            F.when(name == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("h:"), name))),
            F.transform(labels, lambda t: F.concat(F.lit("l:"), t)),
            F.transform(words, lambda t: F.concat(F.lit("p:"), t)),
        )
    )


def mine(labelled: DataFrame, min_support: float = 0.0005, min_confidence: float = 0.6, min_bad: int = 5) -> DataFrame:
    """Stored rules (rule_id, items, confidence, support) from rows (url, bad): URLs with all items are mostly bad, by a
    confidence of more than one half, and no rule rests on fewer than `min_bad` bad URLs, whatever the support is.

    Spark's FP-growth runs on the labelled URLs, each with the tokens that are frequent among bad ones and its label as one
    more item. A set that is frequent with the label is frequent without it, so both numbers of a rule are the miner's. Tokens
    that stand in the same URLs are mined as one and told apart afterwards: repeated templates, however long, are one item.
    Rules of which a part is a rule with no less confidence are left out. Nothing bounds a URL's tokens or a rule's items. Null
    URLs and labels take no part; without rows there are no rules.
    """
    spark = labelled.sparkSession
    ready(spark)
    rows = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select(tokens(F.col("url")).alias("items"), F.col("bad").cast("bigint").alias("bad"))
    rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "labelled-urls")
    total = rows.count()
    least = max(min_bad, 1, math.ceil(min_support * total))
    seen = rows.select("id", "bad", F.explode("items").alias("item"))
    # the URLs of a token, as their number and 128 bits of their ids
    urls = (F.count("*").alias("n"), F.sum("bad").alias("n_bad"), *[F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"urls_{k}") for k in (0, 1)])
    counts = seen.groupBy("item").agg(*urls).where(F.col("n_bad") >= least)
    alike = Window.partitionBy("n", "n_bad", "urls_0", "urls_1")
    frequent = stored(counts.select("item", F.min("item").over(alike).alias("name")), "items")
    named = seen.join(frequent.where("item = name"), "item")
    baskets = named.groupBy("id").agg(F.collect_list("item").alias("items"), F.max("bad").alias("bad"))
    baskets = stored(baskets.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")), "baskets")
    mined = baskets.count()
    if mined == 0:
        return spark.createDataFrame([], RULE_SCHEMA)
    miner = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / mined, numPartitions=tasks(spark))
    sets = stored(miner.fit(baskets).freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "frequent-sets")
    is_bad = F.array_contains("items", BAD)
    with_label = sets.where(is_bad & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad"))
    found = sets.where(~is_bad).join(with_label, "items")
    found = found.select("items", (F.col("bad") / F.col("freq")).alias("confidence"), (F.col("bad") / F.lit(total)).alias("support"))
    found = _better_than_with_one_less(stored(found, "sets-with-bad"), min_confidence)
    rules = found.join(_worse_than_a_part(found), "items", "left_anti")
    rules = _by_all_names(rules, frequent)
    return stored(rules.select(F.xxhash64("items").alias("rule_id"), "items", "confidence", "support"), "rules")


def _better_than_with_one_less(sets: DataFrame, min_confidence: float) -> DataFrame:
    """Stored sets with enough confidence, and more than with any one of their items left out. All parts of a set are sets.

    A rule that is left out here has a part with no less confidence, and so, going on from part to part, one that stays.
    """
    rules = sets.where(F.col("confidence") >= min_confidence)
    less = rules.where(F.size("items") > 1).select("items", "confidence", F.explode("items").alias("item"))
    less = less.select("items", "confidence", F.array_remove("items", F.col("item")).alias("part"))
    parts = rules.select(F.col("items").alias("part"), F.col("confidence").alias("at_least"))
    worse = less.join(parts, "part").where("at_least >= confidence").select("items").distinct()
    return stored(rules.join(worse, "items", "left_anti"), "rules-found")


def _by_all_names(rules: DataFrame, frequent: DataFrame) -> DataFrame:
    """A rule for each choice among the tokens that its items stand for."""
    names = frequent.groupBy("name").agg(F.array_sort(F.collect_list("item")).alias("tokens"))
    choice = rules.withColumn("name", F.explode("items")).join(names, "name")
    choice = choice.groupBy("items").agg(F.first("confidence").alias("confidence"), F.first("support").alias("support"), F.collect_list("tokens").alias("choices"))
    empty = F.array(F.array().cast("array<string>"))
    one_more = lambda sets, ts: F.flatten(F.transform(sets, lambda s: F.transform(ts, lambda t: F.array_append(s, t))))
    chosen = choice.select(F.explode(F.aggregate("choices", empty, one_more)).alias("items"), "confidence", "support")
    return chosen.withColumn("items", F.array_sort("items"))


def _worse_than_a_part(found: DataFrame) -> DataFrame:
    """The items of the rules of which a part is a rule with no less confidence.

    A short rule's parts are looked up by name; those of a long one, which has too many, by an inverted index of their items.
    """
    smaller = found.select(F.col("items").alias("part"), F.col("confidence").alias("at_least"))
    short = found.where(F.size("items") <= NAMED_ITEMS).withColumn("part", F.explode(_parts("items"))).join(smaller, "part")
    index = smaller.withColumn("item", F.explode("part"))
    long = found.where(F.size("items") > NAMED_ITEMS).withColumn("item", F.explode("items")).join(index, "item").groupBy("items", "confidence", "part", "at_least")
    long = long.agg(F.count("*").alias("n")).where("n = size(part)")
    columns = ("items", "confidence", "part", "at_least")
    return short.select(*columns).union(long.select(*columns)).where("at_least >= confidence AND size(part) < size(items)").select("items").distinct()


def _parts(items: str) -> Column:
    """All subsets of a short array (at most NAMED_ITEMS), in its order."""
    empty = F.array(F.array().cast("array<string>"))
    return F.aggregate(items, empty, lambda sets, x: F.concat(sets, F.transform(sets, lambda s: F.concat(s, F.array(x)))))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule_id): the rules of which a URL has all items, by an inverted index from item to rules.

    Only distinct URLs are looked up. The index is joined by size: broadcast if its files are small, else shuffled.
    """
    index = rules.select("rule_id", F.size("items").alias("wanted"), F.explode("items").alias("item"))
    held = urls.select("url").where("url IS NOT NULL").distinct().select("url", F.explode(tokens(F.col("url"))).alias("item"))
    return held.join(index, "item").groupBy("url", "rule_id").agg(F.count("*").alias("n"), F.first("wanted").alias("wanted")).where("n = wanted").select("url", "rule_id")


def judge(pages: DataFrame, fixed: list[tuple[str, str]], rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of `pages` with `host`, `path`, `rule` and `verdict` (allow or block).

    The longest fixed rule that fits decides; else a URL that any mined rule matches is blocked, others are allowed. A null
    URL or one without `://` has an empty host and path and is allowed. Columns named like the new ones are replaced.
    """
    ready(pages.sparkSession)
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    kept, text, hit = [F.col(f"`{c}`") for c in own], free_name(pages, "_url"), free_name(pages, "_hit")
    named = pages.select(*kept, F.col(f"`{url}`").alias(text), host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    blocked = match(named.select(F.col(text).alias("url")), rules).select(F.col("url").alias(text)).distinct().withColumn(hit, F.lit(True))
    mined = F.when(F.col(hit), "block").otherwise("allow")
    return named.join(blocked, text, "left").select(*kept, "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"))
