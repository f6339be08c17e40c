"""URL rules: host suffixes and path prefixes, joined on short hash prefixes, then confirmed.

A rule has a host, a path and a verdict. It fits its host and all subdomains of it when the path of the url
starts with the path of the rule. Of all rules that fit, the one with the most characters decides; of equally
long ones the one with the longer host. Every url is expanded into expressions ``host suffix + directory``; a
rule is listed under its host and the directory of its path. The first eight hex digits of their SHA-256 are
the join key, the full digest and the rest of the path confirm a hit.

Urls are expanded once per distinct pair of host and path, so a page that is listed thousands of times costs
one expansion, and no deeper than the deepest rule. A frequent host splits under adaptive execution because
both sides of the last join are plain shuffles. The rule side is broadcast only if Spark's own size threshold
allows it.

Edge cases: a null url and one without ``://`` have an empty host and path and get the default verdict; rows
that repeat are judged each; rules with a null or empty host are ignored, a null rule path counts as empty; of
rules with the same host and path the blocking one is used; without rules every page gets the default. Columns
that are neither the url nor in ``keep`` are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY_DIGITS = 8


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _directory(path: Column, depth: Column) -> Column:
    """The path up to and with its ``depth``-th slash."""
    head = F.call_function("substring_index", path, F.lit("/"), depth)
    return F.when(depth == 0, "").otherwise(F.concat(head, F.lit("/")))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _listed(rules: DataFrame) -> DataFrame:
    """Rules with their rule string, join key and digest; one row per host and path."""
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))
    rules = rules.select(host.alias("rule_host"), path.alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    rules = rules.filter("rule_host <> ''").groupBy("rule_host", "rule_path").agg(
        F.max("rule_verdict").alias("rule_verdict")  # block sorts after allow
    )
    depth = _slashes(F.col("rule_path"))
    digest = _digest(F.concat("rule_host", _directory(F.col("rule_path"), depth)))
    return rules.select(
        "rule_host",
        "rule_path",
        "rule_verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        depth.alias("depth"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, KEY_DIGITS).alias("key"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), default: str = "allow"
) -> DataFrame:
    """``keep`` with host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict (``allow`` or ``block``). No rule: ``rule`` is null and the verdict is
    ``default``.
    """
    if clash := {"host", "path", "rule", "verdict"} & set(keep):
        raise ValueError(f"kept columns {sorted(clash)} have the names of results; rename them first")
    listed = _listed(rules)
    deepest = listed.agg(F.max("labels").alias("labels"), F.max("depth").alias("depth")).first()
    judged = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    labels = F.least(F.size(F.split("host", r"\.")), F.lit(deepest.labels or 1))
    depths = F.least(_slashes(F.col("path")), F.lit(deepest.depth or 0))
    hosts = F.transform(
        F.sequence(F.lit(1), labels), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n)
    )
    expressions = F.flatten(
        F.transform(
            hosts,
            lambda h: F.transform(
                F.sequence(F.lit(0), depths), lambda d: _digest(F.concat(h, _directory(F.col("path"), d)))
            ),
        )
    )
    expanded = judged.select("host", "path").distinct().select("host", "path", F.explode(expressions).alias("digest"))
    hits = expanded.withColumn("key", F.substring("digest", 1, KEY_DIGITS)).join(listed, "key")
    confirmed = hits.filter((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    order = F.struct(F.length("rule"), F.length("rule_host"), "rule", "rule_verdict")
    best = confirmed.groupBy("host", "path").agg(F.max(order).alias("best"))
    # A host has no slash and a path starts with one, so both together are one key. A computed key makes both sides
    # of the join plain shuffles: next to the aggregate's own partitioning a frequent key could not be split.
    key = F.concat("host", "path").alias("_url")
    found = judged.withColumn("_url", key).join(best.select(key, "best"), "_url", "left")
    return found.select(
        *keep, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")
    )
