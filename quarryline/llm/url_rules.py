"""Judge addresses: listed rules first, mined association rules for the rest.

Listed rules name a host and a path prefix; the longest that fits decides. The addresses they decide
are the labels: FP-growth mines the token combinations that go with a verdict, rules below the
support or confidence asked for are dropped, and so are rules that a more general rule of at least
the same confidence covers. An address without a listed rule follows the best mined rule whose
tokens it has all of, found through an index from token to rules.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import free_name

BLOCK, ALLOW = "block", "allow"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
VERDICT = "="  # marks the item that is a verdict; tokens of addresses start otherwise


class ListedRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """A-Z in lower case; empty for a null or where ``://`` is missing."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def longest_rule(host: Column, path: Column, rules: Sequence[ListedRule]) -> Column:
    """Text of the longest listed rule that fits, else null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), r.text
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens in order: host labels with their place from the right, words of the path
    with digits as #, and names of query parameters."""
    labels = F.filter(F.reverse(F.split(host, r"\.")), lambda x: x != "")
    words = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "[/._-]+"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    names = F.filter(F.split(query, "&"), lambda x: x != "")
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.transform(labels, lambda x, i: F.concat(F.lit("h"), i, F.lit(":"), x)),
                F.transform(words, lambda x: F.concat(F.lit("p:"), x)),
                F.transform(names, lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0])),
            )
        )
    )


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(rule_id, verdict, confidence, support, items) from rows (items, verdict).

    ``items`` are distinct tokens. No labelled row gives no rule.
    """
    baskets = labelled.select(
        F.array_append("items", F.concat(F.lit(VERDICT), "verdict")).alias("items")
    )
    model = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(baskets)
    rules = (
        model.associationRules.filter(F.col("consequent")[0].startswith(VERDICT))
        .filter(~F.exists("antecedent", lambda x: x.startswith(VERDICT)))
        .select(
            F.array_sort("antecedent").alias("items"),
            F.substr(F.col("consequent")[0], F.lit(len(VERDICT) + 1)).alias("verdict"),
            "confidence",
            "support",
        )
    )
    wider = rules.select(
        F.concat_ws(" ", "items").alias("wider"),
        "verdict",
        F.col("confidence").alias("wider_confidence"),
    )
    without_one = rules.select("*", F.explode("items").alias("left_out")).withColumn(
        "wider", F.concat_ws(" ", F.array_remove("items", F.col("left_out")))
    )
    covered = (
        without_one.join(wider, ["wider", "verdict"])
        .filter("wider_confidence >= confidence")
        .select("items", "verdict")
        .distinct()
    )
    kept = rules.join(covered, ["items", "verdict"], "left_anti")
    return kept.select(
        F.concat_ws(" ", F.col("items"), F.lit("->"), F.col("verdict")).alias("rule_id"),
        "verdict",
        "confidence",
        "support",
        "items",
    )


def best_matches(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(address, mined) for the rows (address, items), distinct in address, that some rule fits.

    ``mined`` has (confidence, support, verdict, rule_id) of the most confident rule, then the one
    with most support; between equals block wins, then the later rule_id.
    """
    index = rules.select("rule_id", F.explode("items").alias("item"), F.size("items").alias("wants"))
    found = (
        addresses.select("address", F.explode("items").alias("item"))
        .join(index, "item")
        .groupBy("address", "rule_id")
        .agg(F.count("*").alias("has"), F.first("wants").alias("wants"))
        .filter("has = wants")
    )
    return (
        found.join(rules.drop("items"), "rule_id")
        .groupBy("address")
        .agg(F.max(F.struct("confidence", "support", "verdict", "rule_id")).alias("mined"))
    )


def judge(
    pages: DataFrame,
    listed: Sequence[ListedRule],
    url: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    carry: Sequence[str] = ("page_id",),
) -> DataFrame:
    """One row per page, repeated ones too: the carried columns and host, path, rule, verdict, mined_rule, confidence.

    A null address, one without ``://`` and one no rule fits are allowed (without host or path there
    are no tokens, so no mined rule fits). Columns that are not carried do not matter; a carried
    column keeps its name and the new one of that name gets a number.
    """
    mark = {r.text: r.verdict for r in listed}
    names = {
        c: free_name(carry, c)
        for c in ("host", "path", "rule", "verdict", "mined_rule", "confidence")
    }
    read = pages.select(F.struct(*carry).alias("row"), F.col(url).alias("url")).select(
        "row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    read = read.select(
        "row",
        "host",
        "path",
        longest_rule(F.col("host"), F.col("path"), listed).alias("rule"),
        tokens(F.col("host"), F.col("path"), F.col("url")).alias("items"),
    ).withColumn("address", F.concat_ws(" ", "items"))
    verdicts = F.create_map(*[F.lit(x) for pair in mark.items() for x in pair])
    labelled = read.filter(F.col("rule").isNotNull()).select(
        "items", F.element_at(verdicts, F.col("rule")).alias("verdict")
    )
    rules = mined_rules(labelled, min_support, min_confidence).persist()
    open_ones = read.filter(F.col("rule").isNull()).select("address", "items")
    matched = best_matches(open_ones.dropDuplicates(["address"]), rules)
    return read.join(matched, "address", "left").select(
        "row.*",
        F.col("host").alias(names["host"]),
        F.col("path").alias(names["path"]),
        F.col("rule").alias(names["rule"]),
        F.coalesce(
            F.element_at(verdicts, F.col("rule")), F.col("mined.verdict"), F.lit(ALLOW)
        ).alias(names["verdict"]),
        F.when(F.col("rule").isNull(), F.col("mined.rule_id")).alias(names["mined_rule"]),
        F.when(F.col("rule").isNull(), F.col("mined.confidence")).alias(names["confidence"]),
    )
