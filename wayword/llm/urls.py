"""Filters for URLs: given rules, and rules mined from labelled URLs.

A URL becomes the set of the tokens of its host and its path. Tokens that are in the same labelled URLs say the same and
are one item, named by the smallest of them; a rule asks for any token of each of its items. An item that only bad URLs
have is a rule by itself, and no rule needs it besides others. FP-growth finds the combinations of the other items that
enough of the URLs labelled bad have, however many are labelled; these are counted over all labelled URLs, and
association rules with the label as their consequent are kept by confidence, unless a more general rule is as confident.
An inverted index holds every rule under the tokens of its rarest item: a URL looks up its tokens there and is compared
with these rules only.

Null URLs and URLs without ``://`` have an empty host and path, no token, and are allowed. Every row of a repeated URL
gets the same verdict. Without labelled URLs no rule is mined. Other columns are passed on; a clash with a column that
is added is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, materialise_counted, scratch_path
from .arrow import no_clash
from .components import by_count

# The share of a rule's URLs that are labelled bad, at the least.
MIN_CONFIDENCE = 0.6

# So many labelled bad URLs are needed for a rule, however many are labelled: fewer may be chance.
MIN_COUNT = 10

# Bytes of rules up to which they are broadcast.
RULE_BYTES = 16_000_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, in lower case (A to Z only)."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.translate(F.regexp_extract(after, r"\A[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as ``struct<rule, verdict>``; null if none does.

    A rule is written as host and path, such as ``example.org/es/``, with its verdict. It fits its host and all
    subdomains where the path starts with its own. The rules are looked up by the ends of the host.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append((slash + rest, rule, verdict))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    if not by_host:
        return nothing
    entries = [
        x
        for name, listed in by_host.items()
        for x in (
            F.lit(name),
            F.array(*[
                F.struct(F.lit(p).alias("path"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"))
                for p, r, v in listed
            ]),
        )
    ]
    table = F.create_map(*entries)
    labels = F.split(host, r"\.", -1)
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    known = F.filter(F.transform(ends, lambda e: F.try_element_at(table, e)), lambda x: x.isNotNull())
    fitting = F.filter(F.flatten(known), lambda x: F.startswith(path, x["path"]))
    ordered = F.array_sort(
        F.transform(fitting, lambda x: F.struct((-F.length(x["rule"])).alias("n"), x["rule"], x["verdict"]))
    )
    return F.when(
        F.size(ordered) > 0,
        F.struct(ordered[0]["rule"].alias("rule"), ordered[0]["verdict"].alias("verdict")),
    ).otherwise(nothing)


def tokens_of(host: Column, path: Column) -> Column:
    """The set of tokens: the host's ends and labels, and the words of the path. Numbers are one token."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(
        F.split(F.lower(path), r"[^\p{L}\p{N}]+"),
        lambda x: F.concat(F.lit("path:"), F.when(x.rlike(r"\A[0-9]+\z"), "0").otherwise(x)),
    )
    return F.filter(F.array_distinct(F.concat(labels, words)), lambda x: ~x.isin("host:", "path:"))


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    return df.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})


def indexed(rules: DataFrame, frequent: DataFrame) -> DataFrame:
    """``anchor, tokens, confidence``: every rule under the rarest of its tokens."""
    single = frequent.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        rules.select("*", F.explode("tokens").alias("token"))
        .join(single, "token")
        .groupBy("tokens", "confidence")
        .agg(F.min(F.struct("freq", "token")).alias("least"))
    )
    return rarest.select(F.col("least.token").alias("anchor"), "tokens", "confidence")


def if_small(rules: DataFrame) -> DataFrame:
    """Hint a broadcast if the bytes of the rules, which are counted, allow it."""
    size = rules.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct(*rules.columns)))), F.lit(0))).first()[0]
    return F.broadcast(rules) if size <= RULE_BYTES else rules


def matches(sets: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """``key, rule_tokens, confidence`` for every rule of which a set has all items; ``sets`` has key and tokens."""
    rules = if_small(index.select("anchor", F.col("tokens").alias("rule_tokens"), "confidence"))
    looked_up = sets.select(key, "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    return looked_up.where(F.size(F.array_except("rule_tokens", "tokens")) == 0).drop("anchor", "tokens")


def items_of(sets: DataFrame, min_count: int) -> DataFrame:
    """``token, item, freq, bad`` of the tokens that enough bad URLs have.

    Tokens are one item if they are in as many sets and URLs and two hashes over their sets agree.
    """
    of_set = sets.select(
        F.explode("tokens").alias("token"), "n", "n_bad", F.xxhash64("tokens").alias("first"),
        F.xxhash64(F.lit(1), "tokens").alias("second"),
    )
    counts = of_set.groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("freq"), F.sum("n_bad").alias("bad"),
        F.bit_xor("first").alias("first"), F.bit_xor("second").alias("second"),
    ).where(F.col("bad") >= min_count)
    same = ["sets", "freq", "bad", "first", "second"]
    return counts.join(counts.groupBy(*same).agg(F.min("token").alias("item")), same).select("token", "item", "freq", "bad")


def combinations(sets: DataFrame, items: DataFrame, n_items: int, min_confidence: float, min_count: int) -> DataFrame | None:
    """``anchor, tokens, confidence`` of rules from combinations of the given items; None without any."""
    spark = sets.sparkSession
    named = by_count(items.select("token", "item"), n_items)
    each = sets.select("row", "n", "n_bad", F.explode("tokens").alias("token")).join(named, "token")
    baskets = each.groupBy("row", "n", "n_bad").agg(F.array_sort(F.collect_set("item")).alias("items"))
    baskets = materialise(baskets, scratch_path(spark, "url-baskets"))
    n_bad = baskets.agg(F.coalesce(F.sum("n_bad"), F.lit(0))).first()[0]
    if n_bad < min_count:
        return None
    # A basket is given as often as it is bad.
    bad = baskets.where("n_bad > 0").select("items", F.explode(F.expr("sequence(1L, n_bad)")).alias("copy")).select("items")
    # Half a URL less, as the share is made a whole number of URLs by rounding up.
    found = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n_bad, minConfidence=min_confidence).fit(bad)
    with_bad = found.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad"))
    with_bad = materialise(with_bad, scratch_path(spark, "url-itemsets"))
    # Each combination is looked up in all labelled URLs, by the rarest of its items.
    frequent = items.select(F.array("item").alias("items"), "freq").distinct()
    sought = with_bad.select("tokens", F.lit(0.0).alias("confidence"))
    sought = materialise(indexed(sought, frequent), scratch_path(spark, "url-sought"))
    plain = matches(baskets.select("n", F.col("items").alias("tokens")), "n", sought)
    plain = plain.groupBy(F.col("rule_tokens").alias("tokens")).agg(F.sum("n").alias("freq"))
    rules = with_bad.join(plain, "tokens").select("tokens", (F.col("bad") / F.col("freq")).alias("confidence"))
    rules = rules.where(F.col("confidence") >= min_confidence)
    index = materialise(indexed(rules, frequent), scratch_path(spark, "url-rules"))
    # A rule goes if a more general one is at least as confident.
    named_rules = index.select("tokens", F.col("confidence").alias("own"), F.to_json("tokens").alias("name"))
    wider = matches(named_rules.select("name", "tokens"), "name", index).join(named_rules, "name")
    needless = wider.where((F.size("rule_tokens") < F.size("tokens")) & (F.col("confidence") >= F.col("own")))
    return index.join(needless.select("tokens").distinct(), "tokens", "left_anti").select("anchor", "tokens", "confidence")


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT) -> DataFrame:
    """Rules for bad URLs, as the index ``anchor, tokens, confidence, others``; a written table.

    ``tokens`` names the items of a rule, ``anchor`` is a token of the rarest of them, and ``others`` has the tokens of
    each other one. ``labelled`` has the URL and whether it is bad; rows with a null in either take no part.
    """
    spark = labelled.sparkSession
    rows = with_parts(labelled.where(F.col(url_col).isNotNull() & F.col(bad_col).isNotNull()), url_col)
    sets = rows.select(F.array_sort(tokens_of(F.col("host"), F.col("path"))).alias("tokens"), F.col(bad_col).cast("boolean").alias("bad"))
    sets = sets.where("size(tokens) > 0").groupBy("tokens").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    sets = materialise(sets.withColumn("row", F.monotonically_increasing_id()), scratch_path(spark, "url-sets"))
    items, n_items = materialise_counted(items_of(sets, min_count), scratch_path(spark, "url-items"))
    rules = items.where("freq = bad").select(
        F.col("item").alias("anchor"), F.array("item").alias("tokens"), F.lit(1.0).alias("confidence")
    ).distinct()
    mixed = combinations(sets, items.where("freq > bad"), n_items, min_confidence, min_count)
    rules = rules if mixed is None else rules.union(mixed)
    # The tokens of an item are in one URL together, so their list is no longer than a URL.
    members = items.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("members"))
    listed = rules.select("*", F.explode("tokens").alias("item")).join(members, "item")
    whole = listed.groupBy("anchor", "tokens", "confidence").agg(F.collect_list(F.struct("item", "members")).alias("x"))
    own = F.filter("x", lambda i: i["item"] == F.col("anchor"))[0]["members"]
    others = F.transform(F.filter("x", lambda i: i["item"] != F.col("anchor")), lambda i: i["members"])
    parted = whole.select(own.alias("own"), "tokens", "confidence", others.alias("others"))
    index = parted.select(F.explode("own").alias("anchor"), "tokens", "confidence", "others")
    return materialise(index, scratch_path(spark, "url-index"))


def fitting_rules(sets: DataFrame, index: DataFrame) -> DataFrame:
    """``url, rule_tokens, confidence`` of the rules of which a URL has a token of each item; ``sets`` has url and tokens.

    In an index without ``others`` every token of a rule is an item of its own.
    """
    if "others" not in index.columns:
        rest = F.filter("tokens", lambda t: t != F.col("anchor"))
        index = index.withColumn("others", F.transform(rest, lambda t: F.array(t)))
    rules = if_small(index.select("anchor", F.col("tokens").alias("rule_tokens"), "confidence", "others"))
    looked_up = sets.select("url", "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    return looked_up.where(F.forall("others", lambda item: F.arrays_overlap(item, "tokens")))


def judge(df: DataFrame, index: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict`` and ``mined`` (the tokens of the mined rule that fits, the surest first)."""
    no_clash(df, ["host", "path", "rule", "verdict", "mined"])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    parts = with_parts(df.select(row, F.col(url_col).alias("url")), "url")
    parts = parts.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    sets = with_parts(df.select(F.col(url_col).alias("url")), "url").where("url IS NOT NULL")
    sets = sets.select("url", tokens_of(F.col("host"), F.col("path")).alias("tokens"))
    found = fitting_rules(sets, index)
    surest = F.min(F.struct(-F.col("confidence"), F.size("rule_tokens"), F.col("rule_tokens").alias("tokens")))
    found = found.groupBy("url").agg(surest.alias("best")).select("url", F.col("best.tokens").alias("mined"))
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return parts.join(found, "url", "left").select(
        "row.*", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), "mined"
    )
