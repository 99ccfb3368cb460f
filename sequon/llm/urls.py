"""URL filter: listed rules first, mined association rules for the rest.

The urls that a listed rule judges are the labels. FP-growth mines combinations of their
host and path tokens with the verdict; a combination becomes a rule if its support and
confidence suffice and no part of it is as confident. Rules are found through an index by
their rarest token; of those that hold, the most confident decides, and without any a
url is allowed.

A null url, or one without ``://``, has no host, path or tokens and is allowed. Repeated
rows are judged alike and count as often as they occur. Very long urls are taken whole. An
empty table mines nothing.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequon.llm.common import kept, lower_ascii, small

#: (host, path prefix, verdict); fixed values.
LISTED = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
SUPPORT, CONFIDENCE = 0.01, 0.8
_LABEL = "verdict="
#: Rules that may be written into one expression, and rows that may be broadcast: frequent
#: tokens, which are at most the tokens of a mean url over the support, and rules beyond that.
WRITTEN_RULES, BROADCAST_ROWS = 500, 200_000


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(own_host: Column, own_path: Column) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest listed rule that fits; else null."""
    rules = sorted(LISTED, key=lambda r: -len(r[0] + r[1]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in reversed(rules):
        fits = ((own_host == name) | own_host.endswith("." + name)) & own_path.startswith(prefix)
        rule = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, rule).otherwise(out)
    return out


def tokens(own_host: Column, own_path: Column) -> Column:
    """Distinct host labels and path parts; numbers are one token."""
    hosts = F.transform(F.split(own_host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(
        F.filter(F.split(own_path, "/"), lambda x: x != ""),
        lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")),
    )
    return F.filter(F.array_distinct(F.concat(hosts, parts)), lambda x: x != "h:")


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """(items, verdict, confidence, support) from (``tokens``, ``verdict``); pruned.

    Two kinds of tokens never reach FP-growth, which lists every subset of what a url holds;
    the rules are the same as with them. A token of one verdict only is as confident as can be,
    so no rule with more tokens survives beside it. Of tokens that occur in the same urls, such
    as the parts of a deep path, one stands for all, since a rule with two of them is no more
    confident than with one. Sets of urls are told apart by their count and two 64-bit sums of
    hashes.
    """
    rows = kept(
        labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("url"))
    )
    total = rows.count()
    least = ceil(support * total)
    label = F.concat(F.lit(_LABEL), F.col("verdict"))
    single = kept(
        rows.select(F.explode("tokens").alias("token"), "verdict", "url")
        .groupBy("token")
        .agg(
            F.count("*").alias("n"),
            F.min("verdict").alias("verdict"),
            F.max("verdict").alias("other"),
            F.sum(F.xxhash64("url").cast("decimal(38)")).alias("urls"),
            F.bit_xor(F.xxhash64(F.lit(1), "url")).alias("urls2"),
        )
        .where(F.col("n") >= least)
    )
    sure = single.where("verdict = other").select(
        F.array("token").alias("items"),
        "verdict",
        F.lit(1.0).alias("confidence"),
        (F.col("n") / total).alias("support"),
    )
    # Tokens of one class occur in one url together, so a class is no larger than a url.
    classes = kept(
        single.where("verdict <> other")
        .groupBy("n", "urls", "urls2")
        .agg(F.min("token").alias("head"), F.collect_set("token").alias("members"))
        .select("head", "members")
    )
    # With its label every url stays a basket, so that supports are shares of all.
    labels = rows.select(label.alias("token")).distinct()
    used = kept(classes.select(F.col("head").alias("token")).union(labels))
    baskets = kept(
        rows.select("url", F.explode(F.concat("tokens", F.array(label))).alias("token"))
        .join(small(used, BROADCAST_ROWS), "token", "left_semi")
        .groupBy("url")
        .agg(F.collect_list("token").alias("items"))
        .select("items")
    )
    model = FPGrowth(minSupport=support, minConfidence=confidence).fit(baskets)
    rules = kept(
        model.associationRules.where(F.col("consequent")[0].startswith(_LABEL))
        .where(~F.exists("antecedent", lambda x: x.startswith(_LABEL)))
        .select(
            F.array_sort("antecedent").alias("items"),
            F.substring(F.col("consequent")[0], len(_LABEL) + 1, 1000).alias("verdict"),
            "confidence",
            "support",
        )
    )
    return kept(_spelt_out(_pruned(rules), classes).unionByName(sure))


def _pruned(rules: DataFrame) -> DataFrame:
    """Rules of which no part is as confident."""
    part = rules.select(
        F.col("items").alias("part"), F.col("verdict").alias("v"), F.col("confidence").alias("c")
    ).withColumn("token", F.col("part")[0])
    # A rule meets its parts at the first token of the part.
    met = rules.withColumn("token", F.explode("items")).join(part, "token")
    worse = met.where(
        (F.col("v") == F.col("verdict"))
        & (F.col("c") >= F.col("confidence"))
        & (F.size("part") < F.size("items"))
        & (F.size(F.array_except("part", "items")) == 0)
    )
    return rules.join(worse.select("items", "verdict").distinct(), ["items", "verdict"], "left_anti")


def _spelt_out(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Each rule once for every choice of a member of each of its classes."""
    numbered = kept(rules.withColumn("r", F.monotonically_increasing_id()))
    choices = (
        numbered.select("r", F.explode("items").alias("head"))
        .join(classes, "head")
        .groupBy("r")
        .agg(F.collect_list("members").alias("choices"))
    )
    empty = F.array(F.array().cast("array<string>"))
    picked = F.aggregate(
        "choices",
        empty,
        lambda done, members: F.flatten(
            F.transform(done, lambda d: F.transform(members, lambda m: F.concat(d, F.array(m))))
        ),
    )
    return numbered.join(choices, "r").select(
        F.explode(F.transform(picked, lambda x: F.array_sort(x))).alias("items"),
        "verdict",
        "confidence",
        "support",
    )


def _keyed(rules: DataFrame, counted: DataFrame) -> DataFrame:
    """Rules with their ``pivot``, the token that fewest labelled urls have."""
    numbered = kept(rules.withColumn("r", F.monotonically_increasing_id()))
    rarest = (
        numbered.select("r", F.explode("items").alias("token"))
        .join(counted, "token")
        .groupBy("r")
        .agg(F.min(F.struct("n", "token"))["token"].alias("pivot"))
    )
    return kept(numbered.join(rarest, "r").drop("r"))


def _written(keyed: DataFrame) -> Column:
    """Verdict of few rules over a column ``tokens``, as one expression; null if none holds."""
    index: dict[str, list] = {}
    for r in keyed.collect():
        index.setdefault(r.pivot, []).append((r.confidence, r.support, r.verdict, r["items"]))

    def best(token: Column) -> Column:
        out = F.lit(None).cast("struct<c:double,s:double,v:string>")
        for pivot, own in sorted(index.items()):
            held = [
                F.when(
                    reduce(
                        lambda a, b: a & b,
                        (F.array_contains("tokens", i) for i in items),
                        F.lit(True),
                    ),
                    F.struct(F.lit(c).alias("c"), F.lit(s).alias("s"), F.lit(v).alias("v")),
                )
                for c, s, v, items in sorted(own, reverse=True)
            ]
            out = F.when(token == pivot, F.coalesce(*held)).otherwise(out)
        return out

    return F.array_max(F.transform("tokens", best))["v"] if index else F.lit(None).cast("string")


def matched(
    rows: DataFrame, rules: DataFrame, counted: DataFrame, written: int = WRITTEN_RULES
) -> DataFrame:
    """``rows`` with ``mined``: the verdict of the rules that hold over ``tokens``, else null.

    The most confident rule decides, then the larger support, then the verdict that sorts
    last. ``rows`` have an id ``at``; ``counted`` is (token, n). Up to ``written`` rules become
    one expression; more are joined by their pivot. The result is the same.
    """
    keyed = _keyed(rules, counted)
    if keyed.count() <= written:
        return rows.withColumn("mined", _written(keyed))
    held = (
        rows.select("at", "tokens", F.explode("tokens").alias("pivot"))
        .join(small(keyed, BROADCAST_ROWS), "pivot")
        .where(F.size(F.array_except("items", "tokens")) == 0)
        .groupBy("at")
        .agg(F.max(F.struct("confidence", "support", "verdict"))["verdict"].alias("mined"))
    )
    return rows.join(held, "at", "left")


def judge(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, host, path, rule and verdict of every row.

    A kept column named as one of the results gives way to it.
    """
    results = ("host", "path", "rule", "verdict")
    keep = [c for c in keep if c.lower() not in results]
    own = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.struct(F.lit(0).alias("_"))
    url = F.col("url")
    parsed = pages.select(own.alias("row"), host(url).alias("host"), path(url).alias("path"))
    rows = kept(
        parsed.select(
            "*",
            F.monotonically_increasing_id().alias("at"),
            listed(F.col("host"), F.col("path")).alias("l"),
            tokens(F.col("host"), F.col("path")).alias("tokens"),
        )
    )
    labelled = rows.where("l is not null").select("tokens", F.col("l.verdict").alias("verdict"))
    counted = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    if labelled.isEmpty():
        judged = rows.withColumn("mined", F.lit(None).cast("string"))
    else:
        judged = matched(rows, mine(labelled), counted)
    verdict = F.coalesce("l.verdict", "mined", F.lit("allow"))
    given = [F.col(f"row.`{c}`") for c in keep]
    return judged.select(*given, "host", "path", F.col("l.rule").alias("rule"), verdict.alias("verdict"))
