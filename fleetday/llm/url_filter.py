"""URL filters: pattern rules indexed by their rarest literal token. DataFrame functions only.

A rule is a regular expression over host + path together with the literal tokens that every URL it
matches holds. Each rule is filed under the one of its tokens that fewest URLs hold. A URL's tokens
fetch the rules filed under them, and only those regular expressions run.

Defined cases: a null URL, or one without `://`, has empty host and path, matches nothing and gets the
default verdict; equal URLs get equal verdicts; rules without a token are refused; between rules that
match, higher priority, then the longer rule, then the larger rule text wins. Further columns of the
table are passed through; those named like a result are replaced by it. Empty tables give empty results.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday.llm.common import literal_rows
from fleetday.sources.tables import stage

#: Site rules as (verdict, host, path). Fixed values.
SITE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Words that mark a host as advertising, gambling, adult or spam when they stand alone in a label.
HOST_WORDS = [
    "ads", "adult", "bets", "casino", "gambling", "pills", "poker", "porn", "spam", "tracker", "viagra", "xxx",
]
SCHEMA = "rule string, pattern string, literals array<string>, verdict string, priority int"


def _tokens(text: str) -> list[str]:
    return [t for t in re.split("[^A-Za-z0-9]+", text) if t]


def site_rules(rules: list[tuple[str, str, str]]) -> list[dict]:
    """Rules for a host with all its subdomains and every path that begins with the rule's."""
    return [
        {
            "rule": host + path,
            "pattern": r"^(?:[^/]*\.)?" + re.escape(host + path),
            # a path that may go on in the middle of its last token doesn't vouch for that token
            "literals": _tokens(host) + _tokens(path[: len(path) - len(re.search("[A-Za-z0-9]*$", path)[0])]),
            "verdict": verdict, "priority": 2,
        }
        for verdict, host, path in rules
    ]


def host_word_rules(words: list[str]) -> list[dict]:
    return [
        {"rule": f"host:{w}", "pattern": rf"^[^/]*(?<![a-z0-9]){re.escape(w)}(?![a-z0-9])",
         "literals": _tokens(w), "verdict": "block", "priority": 1}
        for w in words
    ]


def default_rules(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, site_rules(SITE_RULES) + host_word_rules(HOST_WORDS), SCHEMA)


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _with_token(urls: DataFrame) -> DataFrame:
    tokens = F.array_distinct(F.filter(F.split("_key", "[^A-Za-z0-9]+"), lambda t: t != ""))
    return urls.withColumn("_token", F.explode(tokens))


def index_rules(rules: DataFrame, keyed: DataFrame) -> DataFrame:
    """`rules` with `_token`, the literal that fewest URLs hold (the smaller text between equals)."""
    literals = rules.select("rule", "pattern", "verdict", "priority", F.explode(F.array_distinct("literals")).alias("_token"))
    wanted = literals.select("_token").distinct()
    counts = _with_token(keyed).join(wanted, "_token").groupBy("_token").agg(F.count(F.lit(1)).alias("_n"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_token").alias("token")))
    return literals.join(counts, "_token", "left").groupBy("rule", "pattern", "verdict", "priority").agg(
        rarest["token"].alias("_token")
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule (of the deciding rule, else null) and verdict.

    The index is written first, so Spark knows its size and broadcasts it only under the session's
    threshold; a larger rule set is joined by token.
    """
    parsed = pages.drop("host", "path", "rule", "verdict", "priority", "_url", "_best").withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    keyed = parsed.select(F.col(url).alias("_url"), F.concat("host", "path").alias("_key")).where("_key <> ''")
    index = stage(index_rules(rules, keyed), "rules")
    hits = _with_token(keyed).join(index, "_token").where(F.expr("rlike(_key, pattern)"))
    best = hits.groupBy("_url").agg(
        F.max(F.struct("priority", F.length("rule").alias("n"), "rule", "verdict")).alias("_best")
    )
    joined = parsed.join(best, F.col(url) == F.col("_url"), "left")
    return joined.withColumns(
        {"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default)), "priority": F.col("_best.priority")}
    ).drop("_url", "_best")
