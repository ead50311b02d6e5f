"""URL filters: rules indexed by their rarest literal token.

A rule is a host, which also stands for its subdomains (an empty one for every
host), and the beginning of a path, in which ``*`` stands for anything. Most urls hold the tokens of few
rules, so a url fetches the rules filed under its own tokens, and only those
run their regular expression. Of the rules that fit, the longest wins; among
equally long ones the longer host, then ``block`` before ``allow``.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; repeated rows are judged alike; other columns pass through
unless their names are those of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# So many rules become part of the plan; more are joined.
PLANNED_RULES = 500
# So many index rows are broadcast: a few hundred bytes each.
BROADCAST_RULES = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(address, F.lit("([A-Za-z0-9]+)"), F.lit(1)))


def compiled(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules with their regular expression and the tokens each matching url holds.

    A token counts if the rule delimits it on both sides; the last one of a
    path may go on in the url, and so may those next to ``*``.
    """
    frame = spark.createDataFrame(
        list(rules) or [("", "", "")], "verdict string, host string, path string"
    ).where(F.lit(bool(rules)))
    host = F.translate("host", UPPER, LOWER)
    rule = F.concat(host, F.col("path"))
    escaped = F.regexp_replace("path", r"([\\.^$|?+()\[\]{}\-])", r"\\$1")
    return frame.select(
        "verdict",
        rule.alias("rule"),
        F.length(host).alias("host_length"),
        F.concat(
            F.when(host == "", r"(?s)^[^/]*").otherwise(r"(?s)^(?:[^/]*\.)?"),
            F.regexp_replace(host, r"([\\.^$|?+()\[\]{}\-])", r"\\$1"),
            F.regexp_replace(escaped, r"\*", ".*"),
        ).alias("pattern"),
        F.array_distinct(
            F.regexp_extract_all(
                rule, F.lit(r"(?<![A-Za-z0-9*])([A-Za-z0-9]+)(?=[^A-Za-z0-9*])"), F.lit(1)
            )
        ).alias("tokens"),
    )


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under one token: that which the fewest urls hold.

    Counts cover all urls and go through partial sums. A rule without tokens is
    filed under the empty token, which every url gets.
    """
    tokens = rules.select("rule", "verdict", F.explode_outer("tokens").alias("token"))
    wanted = F.broadcast(tokens.select("token").distinct().where("token IS NOT NULL"))
    counts = (
        urls.select(F.explode(url_tokens(F.concat("host", "path"))).alias("token"))
        .join(wanted, "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("urls"))
    )
    best = (
        tokens.join(counts, "token", "left")
        .groupBy("rule", "verdict")
        .agg(
            F.min_by(
                F.coalesce("token", F.lit("")),
                F.struct(F.coalesce("urls", F.lit(0)), F.coalesce("token", F.lit(""))),
            ).alias("token")
        )
    )
    return rules.drop("tokens").dropDuplicates(["rule", "verdict"]).join(best, ["rule", "verdict"])


def _rank(rule) -> Column:
    """Longer rules first, then longer hosts, then block."""
    return F.struct(
        F.length(rule["rule"]).alias("size"),
        rule["host_length"].alias("host_length"),
        rule["verdict"].alias("verdict"),
        rule["rule"].alias("rule"),
    )


def filter_urls(
    urls: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``; ``default`` where no rule fits."""
    spark = urls.sparkSession
    judged = urls.drop(*(c for c in RESULT if c in urls.columns)).withColumns(
        {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    )
    # Whatever columns there are, the rule found gets one of its own.
    own = "_best"
    while own in judged.columns:
        own += "_"
    index = rule_index(judged.select("host", "path"), compiled(spark, rules))
    if len(rules) <= PLANNED_RULES:
        best = _planned(index.collect())
        out = judged.withColumn(own, best)
    else:
        out = _joined(judged, index, len(rules) <= BROADCAST_RULES, own)
    return out.withColumns(
        {"rule": F.col(f"{own}.rule"), "verdict": F.coalesce(f"{own}.verdict", F.lit(default))}
    ).drop(own)


def _planned(index: list) -> Column:
    """The best rule of a url as one expression: no url is shuffled."""
    if not index:
        return F.lit(None).cast("struct<size:int,host_length:int,verdict:string,rule:string>")
    by_token: dict[str, list] = {}
    for row in index:
        by_token.setdefault(row["token"], []).append(row)
    address = F.concat("host", "path")

    def filed(row) -> Column:
        return F.struct(
            F.lit(row["rule"]).alias("rule"),
            F.lit(row["verdict"]).alias("verdict"),
            F.lit(row["host_length"]).alias("host_length"),
            F.lit(row["pattern"]).alias("pattern"),
        )

    held = F.create_map(
        *(x for t, rows in by_token.items() for x in (F.lit(t), F.array(*map(filed, rows))))
    )
    fetched = F.flatten(
        F.filter(
            F.transform(
                F.array_append(url_tokens(address), F.lit("")), lambda t: F.try_element_at(held, t)
            ),
            lambda found: found.isNotNull(),
        )
    )
    fitting = F.filter(fetched, lambda rule: F.rlike(address, rule["pattern"]))
    return F.array_max(F.transform(fitting, _rank))


def _joined(judged: DataFrame, index: DataFrame, small: bool, own: str) -> DataFrame:
    """The same by joins, on distinct addresses; adaptive joins split hot tokens."""
    addresses = judged.select("host", "path").distinct()
    tokens = addresses.select(
        "host",
        "path",
        F.explode(F.array_append(url_tokens(F.concat("host", "path")), F.lit(""))).alias("token"),
    )
    best = (
        tokens.join(F.broadcast(index) if small else index, "token")
        .where(F.rlike(F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max(_rank({c: F.col(c) for c in index.columns})).alias(own))
    )
    return judged.join(best, ["host", "path"], "left").select(*judged.columns, own)
