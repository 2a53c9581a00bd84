"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bellwire.session import small_side

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """A verdict for URLs whose host and path match ``pattern``; ``tokens`` stand in every match."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    base: bool = False


def host_rule(host: str, path: str, verdict: str) -> UrlRule:
    """A host, its subdomains, and a path's beginning."""
    pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}"
    # Whole tokens only: the path's last one may go on.
    tokens = re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^a-z0-9])", path)
    return UrlRule(host + path, verdict, pattern, tuple(tokens), True)


# Base rules.
BASE_RULES = [
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
]

# The method's own rules, for URLs that no base rule fits: advertising, sign-in and search pages.
OWN_RULES = [
    UrlRule("doubleclick", "block", r"^([^/]*\.)?doubleclick\.[a-z]+/", ("doubleclick",)),
    UrlRule("ad", "block", r"^ad\.", ("ad",)),
    UrlRule("ads", "block", r"^ads\.", ("ads",)),
    UrlRule("adserver", "block", r"^adserver\.", ("adserver",)),
    UrlRule("track", "block", r"^track\.", ("track",)),
    UrlRule("login", "block", r"^[^/]+/(.*/)?login([/.]|$)", ("login",)),
    UrlRule("signup", "block", r"^[^/]+/(.*/)?signup([/.]|$)", ("signup",)),
    UrlRule("search", "block", r"^[^/]+/search([/.]|$)", ("search",)),
    UrlRule("checkout", "block", r"^[^/]+/(.*/)?checkout([/.]|$)", ("checkout",)),
]
DEFAULT = "allow"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(urls: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """The rules with the token by which they are found: of each rule's, the one in fewest URLs."""
    rows = [
        (n, r.name, r.verdict, r.pattern, r.base, len(r.name), token)
        for n, r in enumerate(rules)
        for token in r.tokens
    ]
    if {n for n, *_ in rows} != set(range(len(rules))):
        raise ValueError("a rule needs a literal token")
    schema = "n int, rule string, rule_verdict string, pattern string, base boolean, length int, token string"
    asked = urls.sparkSession.createDataFrame(rows, schema)
    words = small_side(asked.select("token").distinct())
    seen = (
        urls.select(F.explode("_tokens").alias("token"))
        .join(words, "token")
        .groupBy("token")
        .agg(F.count("*").alias("seen"))
    )
    counted = asked.join(seen, "token", "left").fillna(0, ["seen"])
    best = counted.groupBy("n", "rule", "rule_verdict", "pattern", "base", "length").agg(
        F.min(F.struct("seen", "token"))["token"].alias("token")
    )
    return small_side(best)


def judge(
    pages: DataFrame,
    base: list[UrlRule] = BASE_RULES,
    own: list[UrlRule] = OWN_RULES,
    default: str = DEFAULT,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    Each distinct URL fetches the rules indexed under its tokens, and only these run their pattern on
    host and path. The longest base rule that fits gives the verdict; if none does, ``rule``
    is null and the longest rule of the method decides, or else ``default``. A null URL, or one
    without ``://``, has an empty host and path. Repeated URLs are judged once.
    """
    place = F.concat("_host", "_path")
    urls = (
        pages.select(F.col("url").alias("_url"))
        .where("_url IS NOT NULL")
        .distinct()
        .select("_url", url_host(F.col("_url")).alias("_host"), url_path(F.col("_url")).alias("_path"))
        .withColumn("_tokens", F.array_distinct(F.regexp_extract_all(place, F.lit(f"({TOKEN})"), 1)))
    )
    index = rule_index(urls, base + own)
    fitting = (
        urls.select("_url", place.alias("_place"), F.explode("_tokens").alias("token"))
        .join(index, "token")
        .where(F.expr("_place RLIKE pattern"))
        .groupBy("_url")
        .agg(F.max(F.struct("base", "length", "rule", "rule_verdict")).alias("_best"))
    )
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), F.col("url").alias("_page"))
    judged = rows.join(fitting, F.col("_page") == F.col("_url"), "left")
    url = F.col("_page")
    return judged.select(
        *[F.col(f"_row.`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
        url_host(url).alias("host"),
        url_path(url).alias("path"),
        F.when(F.col("_best.base"), F.col("_best.rule")).alias("rule"),
        F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"),
    )
