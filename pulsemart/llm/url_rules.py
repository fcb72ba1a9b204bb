"""URL filters: listed domain rules, and token combinations mined with FP-growth.

Everything runs on DataFrame functions and Spark's own FP-growth.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import saved

BAD = "!bad"


@dataclass(frozen=True)
class DomainRule:
    """Allow or block a host and its subdomains where the path starts as given."""

    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct labels of the host, parts of the path and parts of the query; no bare numbers."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))

    def parts(text: Column, at: str, mark: str) -> Column:
        return F.transform(F.split(F.lower(text), at), lambda x: F.concat(F.lit(mark), x))

    every = F.concat(
        parts(host_of(url), r"[.\-]", "h:"),
        parts(path_of(url), r"[/._\-]", "p:"),
        parts(query, r"[&;=._\-]", "q:"),
    )
    return F.array_distinct(F.filter(every, lambda x: ~x.rlike(r"^.:[0-9]*$")))


def listed_rule(host: Column, path: Column, rules: Sequence[DomainRule], value) -> Column:
    """`value(rule)` of the longest rule that fits, null if none does; on a tie, block wins."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.action == "block", r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def mine_rules(
    labelled: DataFrame,
    *,
    min_support: float = 0.002,
    min_count: int = 20,
    min_confidence: float = 0.8,
    max_items: int = 4,
) -> DataFrame:
    """Token combinations that foretell a bad page: items, confidence, support.

    `labelled` has url and bad (boolean; null counts as good). Combinations must occur in at
    least `min_count` labelled urls and a share `min_support` of them, with at most `max_items`
    tokens. A rule goes if a part of its tokens already reaches its confidence. Without rows
    there are no rules.
    """
    spark = labelled.sparkSession
    baskets = saved(
        labelled.select(
            F.concat(
                tokens_of(F.col("url")),
                F.when(F.coalesce(F.col("bad"), F.lit(False)), F.array(F.lit(BAD))).otherwise(
                    F.array().cast("array<string>")
                ),
            ).alias("items")
        ).where(F.size("items") > 0),
        "baskets",
    )
    total, bad = baskets.agg(
        F.count("*"), F.count_if(F.array_contains("items", BAD))
    ).first()
    # A rule needs min_count bad or good urls in all and min_confidence of them bad.
    support = max(min_support, min_count / total) * min_confidence if total else 1.0
    if not total or bad < support * total:
        return spark.createDataFrame([], "items array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=min(support, 1.0), minConfidence=min_confidence)
    rules = saved(
        model.fit(baskets)
        .associationRules.where(
            (F.element_at("consequent", 1) == BAD)
            & (F.size("antecedent") <= max_items)
            & (F.col("support") / F.col("confidence") >= max(min_support, min_count / total))
        )
        .select(F.array_sort("antecedent").alias("items"), "confidence", "support"),
        "url-rules",
    )
    parts = rules.select(
        F.col("items").alias("part"), F.col("confidence").alias("part_confidence")
    ).withColumn("first", F.element_at("part", 1))
    covered = (
        rules.withColumn("item", F.explode("items"))
        .join(parts, F.col("item") == F.col("first"))
        .where(
            (F.size("part") < F.size("items"))
            & (F.col("part_confidence") >= F.col("confidence"))
            & (F.size(F.array_except("part", "items")) == 0)
        )
        .select("items")
        .distinct()
    )
    return rules.join(covered, "items", "left_anti")


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that some mined rule fits, with the number of rules.

    Inverted index: each rule is filed under its token that fewest rules share, so a url meets
    only rules filed under one of its tokens and then checks the other tokens.
    """
    filed = rules.select("items", F.explode("items").alias("token"))
    seldom = filed.groupBy("token").agg(F.count("*").alias("n"))
    index = (
        filed.join(seldom, "token")
        .groupBy("items")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    )
    known = (
        urls.select("url")
        .where(F.col("url").isNotNull())
        .distinct()
        .withColumn("tokens", tokens_of(F.col("url")))
    )
    return (
        known.withColumn("token", F.explode("tokens"))
        .join(index, "token")
        .where(F.size(F.array_except("items", "tokens")) == 0)
        .groupBy("url")
        .agg(F.count("*").alias("n_rules"))
    )


def judge(
    pages: DataFrame, mined: DataFrame, listed: Sequence[DomainRule] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per row of pages: the `keep` columns, host, path, rule, verdict, n_rules.

    A listed rule decides; otherwise a url that a mined rule fits is blocked, any other one
    allowed. A null url, or one without ://, has an empty host and path and is allowed unless a
    rule is mined for it. Repeated rows are judged alike, one row each.
    """
    hits = matched_urls(pages, mined).select(F.col("url").alias("__url"), "n_rules")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(*keep, "url").join(hits, F.col("url") == F.col("__url"), "left")
    n_rules = F.coalesce(F.col("n_rules"), F.lit(0).cast("long"))
    return rows.select(
        *keep,
        host.alias("host"),
        path.alias("path"),
        listed_rule(host, path, listed, lambda r: r.name).alias("rule"),
        F.coalesce(
            listed_rule(host, path, listed, lambda r: r.action),
            F.when(n_rules > 0, "block").otherwise("allow"),
        ).alias("verdict"),
        n_rules.alias("n_rules"),
    )
