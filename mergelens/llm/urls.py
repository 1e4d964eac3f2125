"""URL rules: pattern rules found by their rarest literal token, then tested as expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Letters and digits of any case; a token of an address is a longest run of them.
TOKEN = "[0-9A-Za-z]+"


@dataclass(frozen=True)
class UrlRule:
    """A rule over host and path written one after the other.

    ``name`` is reported if ``named``; ``pattern`` is a regular expression found anywhere in
    host + path; ``tokens`` are literal whole tokens that every address it fits must have;
    ``strength`` orders the rules that fit (the largest wins, then the smaller name).
    """

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    strength: int
    named: bool = True


def prefix_rule(rule: str, action: str) -> UrlRule:
    """A rule 'host/path' that fits the host, its subdomains, and paths that start with the path.

    The path must end with '/', so that each of its tokens is a whole token of the address.
    """
    host, _, path = rule.partition("/")
    if not path.endswith("/") and path:
        raise ValueError(f"the path of {rule!r} has to end with '/'")
    literal = rule.replace(".", r"\.")
    tokens = tuple(t for t in rule.replace("/", ".").replace("-", ".").split(".") if t)
    return UrlRule(rule, action, rf"^([^/]*\.)?{literal}", tokens, 1000 + len(rule))


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end; empty if there is no '://'."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    start = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def judge(
    pages: DataFrame, key: str, url: str, rules: list[UrlRule], default: str = "allow"
) -> DataFrame:
    """``key``, host, path, rule and verdict of every row.

    1. The distinct addresses (host and path) are split into tokens, and the tokens that rules use
       are counted over all of them; each rule is filed under its rarest token (ties: the first).
    2. The tokens of an address fetch the rules filed under them; a rule without tokens is fetched
       by every address.
    3. Only fetched rules run their expression; the strongest that fits decides. Addresses that no
       rule fits get ``default``.

    Rules are few rows beside the pages; Spark decides by size whether they are broadcast. A null
    or relative URL has an empty host and path, which no rule fits. Repeated rows are judged one by
    one. An empty table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    addresses = rows.select("host", "path").distinct()
    filed = file_rules(spark, addresses, rules)
    fetched = addresses.select("host", "path", F.explode_outer(_tokens()).alias("token")).join(
        filed, "token"
    )
    fits = F.expr("regexp_like(concat(host, path), pattern)")
    best = (
        fetched.where(fits)
        .groupBy("host", "path")
        .agg(F.min(F.struct(-F.col("strength"), "name", "action", "named")).alias("best"))
    )
    return (
        rows.join(best, ["host", "path"], "left")
        .select(
            F.col("key").alias(key),
            "host",
            "path",
            F.when(F.col("best.named"), F.col("best.name")).alias("rule"),
            F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
        )
    )


def file_rules(spark: SparkSession, addresses: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """Every rule under the one of its tokens that the fewest addresses have."""
    schema = (
        "name string, action string, pattern string, strength int, named boolean, "
        "place int, token string"
    )
    listed = spark.createDataFrame(
        [
            (r.name, r.action, r.pattern, r.strength, r.named, place, token)
            for r in rules
            for place, token in enumerate(r.tokens or ("",))
        ],
        schema,
    )
    used = listed.select("token").distinct()
    seen = (
        addresses.select(F.explode_outer(_tokens()).alias("token"))
        .join(used, "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    return (
        listed.join(seen, "token", "left")
        .groupBy("name", "action", "pattern", "strength", "named")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)), "place", "token")).alias("rarest"))
        .select("name", "action", "pattern", "strength", "named", F.col("rarest.token"))
    )


def _tokens() -> Column:
    """The distinct tokens of an address, and the empty one that files rules without tokens."""
    found = F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({TOKEN})"), 1)
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))
