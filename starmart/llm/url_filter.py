"""URL filter: a rule list, and association rules for what the list does not judge.

Method: URLs become sets of tokens; tokens that labelled URLs only hold together are one item; FP-growth
mines the combinations that these URLs share with their label; rules above a confidence, a support and a lift stay, unless a part of their tokens says
the same at least as surely. An inverted index holds each rule under its rarest token; a URL looks up
its tokens there and the rule's other tokens are then checked. Token sets, not URLs, are matched, so a
host that holds a third of all pages costs its different token sets only. Everything is native.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import stored

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.002
MIN_COUNT = 20  # labelled urls behind a rule, at least
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.2
# A label as an item; URL tokens have a kind before a colon and never look like this.
LABELS = {verdict: f"={verdict}" for verdict in (ALLOW, BLOCK)}


@dataclass(frozen=True)
class ListRule:
    verdict: str
    rule: str  # host, then path from its first slash on


LIST = (ListRule(BLOCK, "net/"), ListRule(ALLOW, "example.net/en/"), ListRule(BLOCK, "example.com/de/"),
        ListRule(ALLOW, "org/fr/"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), string.ascii_uppercase,
                       string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def list_rule(host: Column, path: Column, rules: tuple[ListRule, ...] = LIST) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of equally long ones the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: -len(r.rule))[::-1]:
        at = rule.rule.index("/")
        fits = (((host == rule.rule[:at]) | F.endswith(host, F.lit("." + rule.rule[:at])))
                & F.startswith(path, F.lit(rule.rule[at:])))
        name = F.when(fits, rule.rule).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """A sorted set: labels of the host, parts of its hyphenated labels, segments of the path without
    its numbers, names of query fields."""
    kind = lambda name, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(name), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#]*?\?([^#]*)", 1)
    return F.array_sort(F.array_distinct(F.concat(
        kind("host:", F.split(host, r"\.")), kind("word:", F.split(host, r"[.-]")),
        kind("path:", F.filter(F.split(path, "/"), lambda x: ~F.rlike(x, F.lit(r"^\d+(\.\w+)?$")))),
        kind("query:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))))))


def token_classes(rows: DataFrame, least: int) -> DataFrame:
    """(token, class, members): tokens of rows (id, tokens) that stand in the very same rows, ``least`` at
    least, are one class, named by its smallest token.

    Rows are told by two 64-bit hashes joined by exclusive or. Members share a row, so a class is no
    larger than a row's set.
    """
    sets = rows.select("id", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit("again"), "id")).alias("other")).where(F.col("n") >= least)
    return (sets.groupBy("n", "one", "other").agg(F.array_sort(F.collect_list("token")).alias("members"))
            .select(F.explode("members").alias("token"), F.col("members")[0].alias("class"), "members"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE):
    """The FP-growth model of rows (tokens, verdict) whose items are classes of tokens, and the classes;
    None from no rows.

    Tokens that only come together would make every combination of them frequent, two to the power of a
    URL's depth; as one item they make one.
    """
    spark = labelled.sparkSession
    label = F.when(F.col("verdict") == ALLOW, LABELS[ALLOW]).when(F.col("verdict") == BLOCK, LABELS[BLOCK])
    rows = stored(labelled.where(label.isNotNull()).select(
        F.monotonically_increasing_id().alias("id"), "tokens", label.alias("label")), "url-transactions")
    count = rows.count()
    if not count:
        return None
    least = max(MIN_COUNT, math.ceil(min_support * count))
    classes = stored(token_classes(rows, least), "url-classes")
    held = (rows.select("id", F.explode("tokens").alias("token")).join(classes.select("token", "class"), "token")
            .groupBy("id").agg(F.collect_set("class").alias("classes")))
    items = stored(rows.select("id", "label").join(held, "id", "left").select(F.concat(
        F.coalesce("classes", F.array().cast("array<string>")), F.array("label")).alias("items")), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / count), minConfidence=min_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(items)
    return model, classes


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                min_lift: float = MIN_LIFT) -> DataFrame:
    """(tokens, verdict, confidence, support) from rows (tokens, verdict); none from no rows.

    A rule stays if none of a proper part of its tokens has the same verdict and at least its confidence.
    Rules are mined and thinned out over classes of tokens; those that stay are then told with each member
    of their classes, since a URL to be judged may hold one member without the others. Rules of equal
    tokens with both verdicts may both stay; ``matches`` decides.
    """
    spark = labelled.sparkSession
    schema = "tokens array<string>, verdict string, confidence double, support double"
    mined = mine(labelled, min_support, min_confidence)
    if mined is None:
        return spark.createDataFrame([], schema)
    model, classes = mined
    verdict = F.substring(F.col("consequent")[0], 2, 5)
    found = stored(model.associationRules.where(F.col("consequent")[0].isin(*LABELS.values()))
                   .where((F.col("lift") >= min_lift) & ~F.arrays_overlap(
                       "antecedent", F.array(*map(F.lit, LABELS.values()))))
                   .select(F.array_sort("antecedent").alias("tokens"), verdict.alias("verdict"), "confidence",
                           "support"), "url-rules")
    # A part of a rule is found under one of the rule's tokens.
    parts = found.select(F.explode("tokens").alias("token"), "tokens", "verdict", "confidence").alias("r").join(
        found.select(F.col("tokens")[0].alias("token"), F.col("tokens").alias("part"),
                     F.col("verdict").alias("says"), F.col("confidence").alias("as_sure")).alias("p"), "token")
    idle = parts.where((F.size("part") < F.size("tokens")) & (F.col("says") == F.col("verdict"))
                       & (F.col("as_sure") >= F.col("confidence"))
                       & (F.size(F.array_except("part", "tokens")) == 0)).select("tokens", "verdict").distinct()
    kept = found.join(idle, ["tokens", "verdict"], "left_anti")
    named = classes.where(F.col("token") == F.col("class")).select("class", "members")
    told = (kept.select("*", F.explode("tokens").alias("class")).join(named, "class")
            .groupBy("tokens", "verdict", "confidence", "support").agg(F.collect_list("members").alias("choices")))
    start = F.array(F.array().cast("array<string>"))
    each = F.aggregate("choices", start, lambda done, members: F.flatten(F.transform(
        done, lambda tokens: F.transform(members, lambda token: F.concat(tokens, F.array(token))))))
    return stored(told.select(F.explode(each).alias("tokens"), "verdict", "confidence", "support")
                  .withColumn("tokens", F.array_sort("tokens")), "url-kept-rules")


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): for each set of tokens the verdict of the surest rule that it holds.

    Of equally sure rules the one with more support decides, then blocking.
    """
    each = F.explode("tokens").alias("token")
    common = stored(sets.select(each).groupBy("token").agg(F.count(F.lit(1)).alias("n")), "url-token-counts")
    index = (rules.withColumnRenamed("tokens", "wanted").select("*", F.explode("wanted").alias("token")).join(common, "token")
             .groupBy("wanted", "verdict", "confidence", "support")
             .agg(F.min_by("token", F.struct("n", "token")).alias("token")))
    met = sets.select("tokens", each).join(index, "token").where(
        F.size(F.array_except("wanted", "tokens")) == 0)
    return met.groupBy("tokens").agg(F.max_by("verdict", F.struct("confidence", "support", "verdict")).alias("mined"))


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[ListRule, ...] = LIST) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined): one row per input row.

    labelled has (url, verdict). The list decides where a rule fits, else the mined rules, else the
    url is allowed. Null urls and urls without ``://`` have neither host nor path. Repeated rows and
    rows without page_id are judged by their url. Extra columns are ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = lambda df, *more: df.select(*more, "url", host.alias("host"), path.alias("path")).withColumn(
        "tokens", tokens_of(F.col("host"), F.col("path"), F.col("url")))
    mined = mined_rules(split(labelled, "verdict").select("tokens", "verdict"))
    rule, verdict = list_rule(F.col("host"), F.col("path"), rules)
    parted = stored(split(pages, "page_id").select("page_id", "host", "path", "tokens", rule.alias("rule"),
                                                   verdict.alias("listed")), "url-parts")
    found = stored(matches(parted.select("tokens").distinct(), mined), "url-matches")
    return (parted.join(found, "tokens", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("listed", "mined", F.lit(ALLOW)).alias("verdict"), "mined"))


def labels_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, verdict) of pages that show a labelled document, whose number is a segment of the path.

    Toxic documents and those of low quality ask to block, others to allow; nulls don't ask. With
    several labels, blocking goes first.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:/|\.\w+|$)", 1)
    shown = pages.select("url", F.nullif(number, F.lit("")).cast("bigint").alias("doc_id"))
    said = labels.where("toxic IS NOT NULL OR quality IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.col("toxic") == 1,
                         F.col("quality") == 0)).alias("bad"))
    return shown.join(said, "doc_id").select("url", F.when(F.col("bad"), BLOCK).otherwise(ALLOW).alias("verdict"))
