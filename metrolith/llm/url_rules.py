"""URL filtering by given rules and by mined association rules (operator 5), with DataFrame functions only.

Given rules (host, path) decide first: a rule fits its host and all subdomains if the url's path starts with the
rule's, and the longest fitting rule wins.  Other urls are judged by rules mined from labels:

1. tokens of bad urls count if they have the support and a larger share of bad rows than all rows together have; tokens
   of exactly the same bad urls are one item;
2. the frequent combinations of up to ``RULE_ITEMS`` items are found and counted in all labelled urls through an inverted
   index under their rarest token.  FP-growth mines the bad urls if none has more than ``BASKET_ITEMS`` items, as it lists
   all 2^n subsets of n common items.  If some have more, items that no good url has are taken as rules by themselves, to
   which more items would add nothing; if the others are still more, sets of them grow by an item at a time, which finds
   the same ones of that size;
3. those with enough support and confidence block, less any that a more general one makes needless.

A url is compared only with the rules that its own tokens lead to, by the same inverted index.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and is judged by the mined
rules on no tokens (allow).  Without labels nothing is mined and the method allows.  Every row gives one row; only
page_id and url are read, from labels doc_id, quality and toxic (repeated labels of a page count as bad if any is).
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Given rules in production: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
MIN_ROWS = 8
#: Items of a url up to which FP-growth mines all urls: 2^8 item sets of a url. With more, sets grow by levels; none is left out.
BASKET_ITEMS = 8
#: Items of a rule at most.
RULE_ITEMS = 4
_JOINT = "\x1f"
#: Mined rules are sent to every task only up to this number; beyond it they are joined by a shuffle.
BROADCAST_RULES = 10_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host followed by path) and its verdict, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels and what hyphens part them into, words of the path (numbers as one), query keys."""
    url = F.translate(url, _JOINT, "")
    host, path = host_and_path(url)
    scheme = F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([^:/?#]*)://", 1))
    labels = F.split(host, r"\.")
    words = F.transform(F.regexp_extract_all(F.lower(path), F.lit(r"[^/\-_.]+"), F.lit(0)), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, r"[0-9]+", "0")))
    keys = F.transform(F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)), lambda x: F.concat(F.lit("key="), x))
    parted = F.flatten(F.transform(F.filter(labels, lambda x: F.contains(x, F.lit("-"))), lambda x: F.split(x, "-")))
    parts = F.concat(F.array(scheme), F.transform(labels, lambda x: F.concat(F.lit("label="), x)), F.transform(parted, lambda x: F.concat(F.lit("part="), x)), words, keys)
    return F.when(F.instr(url, "://") > 0, F.array_distinct(F.filter(parts, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<string>"))


def _held_by(sets: DataFrame, urls: DataFrame) -> DataFrame:
    """Pairs of ``sets`` (tokens, anchor, ...) and ``urls`` (of_url, has, ...) that hold all their tokens: an inverted index by anchor."""
    led = urls.select("*", F.explode("has").alias("token"))
    return led.join(sets, F.col("token") == F.col("anchor")).where(F.size(F.array_except("tokens", "has")) == 0)


def _grown_sets(baskets: DataFrame, least: int) -> DataFrame:
    """items: the sets of up to ``RULE_ITEMS`` items that baskets (of_url, n_bad, item) with ``least`` rows hold, by levels.

    A set grows by items after its last one, in the urls that hold it: only frequent sets grow.
    """
    alone = baskets.select("of_url", "n_bad", F.array("item").alias("items"))
    found = level = alone.groupBy("items").agg(F.sum("n_bad").alias("n")).where(F.col("n") >= least).select("items").checkpoint()
    held = alone
    more = baskets.select("of_url", "item")
    for _ in range(RULE_ITEMS - 1):
        held = held.join(level, "items", "left_semi").join(more, "of_url").where(F.col("item") > F.element_at("items", -1))
        held = held.select("of_url", "n_bad", F.concat("items", F.array("item")).alias("items"))
        level = held.groupBy("items").agg(F.sum("n_bad").alias("n")).where(F.col("n") >= least).select("items").checkpoint()
        found = found.unionByName(level)
    return found


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """tokens (sorted), anchor (the rarest), confidence, rows: mined rules that lead to a bad label."""
    asked = labels.select(F.col("doc_id").cast("long").alias("labelled"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")).where("labelled is not null")
    asked = asked.groupBy("labelled").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    known = pages.select(F.col("page_id").cast("long").alias("page"), "url").where("url is not null").join(asked, F.col("page") == F.col("labelled"))
    urls = known.groupBy(F.col("url").alias("of_url")).agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad")).withColumn("has", url_tokens(F.col("of_url"))).checkpoint()
    total = urls.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_bad"), F.lit(0)).alias("bad")).first()
    none = pages.sparkSession.createDataFrame([], "tokens array<string>, anchor string, confidence double, rows long")
    if not total["bad"]:
        return none
    least = max(min_rows, math.ceil(min_support * total["n"] - 1e-9), 1)
    # tokens of the same bad urls are one item, told by two exclusive ors of hashes of these urls
    tokens = urls.select("of_url", "n", "n_bad", F.explode("has").alias("token"))
    mark = lambda seed: F.bit_xor(F.when(F.col("n_bad") > 0, F.xxhash64("of_url", F.lit(seed))))
    counted = tokens.groupBy("token").agg(F.sum("n").alias("rows"), F.sum("n_bad").alias("bad_rows"), mark(1).alias("one"), mark(2).alias("two")).checkpoint()
    leading = counted.where((F.col("bad_rows") >= least) & (F.col("bad_rows") * total["n"] > F.col("rows") * total["bad"]))
    items = leading.groupBy("bad_rows", "one", "two").agg(F.array_sort(F.collect_list("token")).alias("members"), F.max(F.col("bad_rows") / F.col("rows")).alias("share"))
    items = items.select("share", F.array_join("members", _JOINT).alias("item"), F.element_at("members", 1).alias("token")).checkpoint()
    # there are at most (tokens of a url) / min_support items, since each takes that share of the labelled urls' tokens
    bad = tokens.where("n_bad > 0").join(F.broadcast(items), "token").select("of_url", "n_bad", "item", (F.col("share") == 1).alias("sure")).checkpoint()
    sizes = bad.groupBy("of_url").agg(F.count("*").alias("n"), F.count_if(~F.col("sure")).alias("n_mixed"))
    most = sizes.agg(F.max("n").alias("n"), F.max("n_mixed").alias("n_mixed")).first()
    if not most["n"]:
        return none
    sets = None
    if most["n"] > BASKET_ITEMS:
        sets = items.where("share = 1").select(F.array("item").alias("items"))
        bad = bad.where(~F.col("sure"))
    if most["n"] > BASKET_ITEMS and most["n_mixed"] > BASKET_ITEMS:
        sets = sets.unionByName(_grown_sets(bad, least))
    elif most["n"] <= BASKET_ITEMS or most["n_mixed"]:
        whole = bad.groupBy("of_url", "n_bad").agg(F.collect_list("item").alias("items"))
        baskets = whole.select("items", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_bad")))).select("items").checkpoint()
        model = FPGrowth(itemsCol="items", minSupport=least / baskets.count() * (1 - 1e-9), minConfidence=min_confidence).fit(baskets)
        mined = model.freqItemsets.where(F.size("items") <= RULE_ITEMS).select(F.array_sort("items").alias("items"))
        sets = mined if sets is None else sets.unionByName(mined)
    sets = sets.withColumn("tokens", F.array_sort(F.flatten(F.transform("items", lambda x: F.split(x, _JOINT)))))
    anchors = sets.select("items", F.explode("tokens").alias("token")).join(counted.select("token", F.col("rows").alias("token_rows")), "token")
    anchors = anchors.groupBy("items").agg(F.min(F.struct("token_rows", "token")).alias("rarest"))
    sets = sets.join(anchors, "items").select("items", "tokens", F.col("rarest.token").alias("anchor")).checkpoint()
    rules = _held_by(sets, urls).groupBy("items", "tokens", "anchor").agg(F.sum("n").alias("rows"), F.sum("n_bad").alias("bad_rows"))
    rules = rules.withColumn("confidence", F.col("bad_rows") / F.col("rows")).where((F.col("confidence") >= min_confidence) & (F.col("bad_rows") >= least)).checkpoint()
    # a rule that holds another one's items and is no surer adds nothing: each rule looks up its own few subsets
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size("items")).cast("int") - F.lit(2))
    subsets = F.transform(masks, lambda m: F.filter("items", lambda x, i: F.getbit(m, i) == 1))
    smaller = rules.where(F.size("items") > 1).select(F.col("items").alias("whole"), "confidence", F.explode(subsets).alias("part"))
    surer = rules.select(F.col("items").alias("part"), F.col("confidence").alias("surer"))
    needless = smaller.join(surer, "part").where("surer >= confidence").select(F.col("whole").alias("items")).distinct()
    return rules.join(needless, "items", "left_anti").select("tokens", "anchor", "confidence", "rows")


def filter_urls(spark: SparkSession, pages: DataFrame, labels: DataFrame, *, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence for each row of ``pages`` (page_id, url)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    mined = mine(rows, labels, min_support, min_confidence, min_rows).checkpoint()
    n_rules = mined.count()
    mined = F.broadcast(mined) if n_rules <= BROADCAST_RULES else mined
    urls = rows.where("url is not null").select(F.col("url").alias("of_url")).distinct().withColumn("has", url_tokens(F.col("of_url")))
    hit = _held_by(mined, urls).groupBy("of_url").agg(F.max(F.struct("confidence", F.array_join("tokens", " ").alias("mined_rule"))).alias("best"))
    host, path = host_and_path(F.col("url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    judged = rows.select("page_id", "url", host.alias("host"), path.alias("path")).join(hit, F.col("url") == F.col("of_url"), "left")
    method = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.col("best.mined_rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"))
