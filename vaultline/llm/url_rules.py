"""URL rules by hashed expressions.

Every URL is expanded into host suffixes and path prefixes, and every rule is one such
expression. URLs meet rules in an equi-join on the first four bytes of the expression's SHA-256;
the full digest confirms the match, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import join_spread
from vaultline.sources.scratch import keep

#: Hex digits of a digest that are joined on.
SHORT = 8
#: A rule list of at most this many rows, each cut off at ``LONGEST`` characters, is broadcast.
BROADCAST_RULES = 100_000
LONGEST = 2_048


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, with A-Z in lower case; none: empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _sizes(rules: DataFrame) -> tuple[list[int], list[int], int, int]:
    """The label counts and path lengths that occur in rules, and how many and how long these are.

    Neither list can be longer than the longest rule, however many rules there are.
    """
    row = rules.agg(
        F.collect_set(F.size(F.split("host", "[.]"))),
        F.collect_set(F.length("path")),
        F.count("*"),
        F.max(F.length("host") + F.length("path")),
    ).first()
    return sorted(row[0]), sorted(row[1]), row[2], row[3] or 0


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains if
    the URL's path starts with its path. The longest (host and path together) wins; among equally
    long ones ``block`` wins, then the smaller text. Without a rule the verdict is ``default``.
    A null URL or one without ``://`` has an empty host and path and fits no rule, unless a rule's
    own host is empty. Repeated pages and rules are allowed; no rules leave every page to the default.
    """
    rules = rules.select("host", "path", "verdict").distinct()
    labels, lengths, many, longest = _sizes(rules)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counted = keep(parsed.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    distinct = counted.select("host", "path")

    parts = F.split("host", "[.]")
    suffixes = F.filter(
        F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in labels]), lambda x: x.isNotNull()
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda x: x.isNotNull()
    )
    if many:
        expressions = (
            distinct.withColumn("prefixes", prefixes)
            .select("host", "path", "prefixes", F.explode(suffixes).alias("suffix"))
            .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
            .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
            .select("host", "path", "digest", F.substring("digest", 1, SHORT).alias("short"))
        )
        known = rules.select(
            _digest(F.col("host"), F.col("path")).alias("rule_digest"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).withColumn("short", F.substring("rule_digest", 1, SHORT))
        if many <= BROADCAST_RULES and longest <= LONGEST:
            known = F.broadcast(known)
        hits = expressions.join(known, "short").where("digest = rule_digest")
        order = F.struct(-F.length("rule"), (F.col("verdict") != "block").cast("int"), "rule", "verdict")
        best = hits.groupBy("host", "path").agg(F.min(order).alias("best"))
        found = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))
        # a row for each host and path, ruled or not: those of very many pages are broadcast, as that of pages without a host
        each = keep(counted.join(found, ["host", "path"], "left"), "judged")
        judged = join_spread(parsed, each, ["host", "path"], "n", counted.agg(F.sum("n")).first()[0] or 0)
    else:
        judged = parsed.withColumn("rule", F.lit(None).cast("string")).withColumn("ruled", F.lit(None).cast("string"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(default)).alias("verdict"))
