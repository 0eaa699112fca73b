"""URL filtering by pattern rules under an inverted index, in native expressions.

A rule is a regular expression over the normalised url (lower-cased host, then path, query and fragment), with the
literal tokens every match must hold. A rule is indexed under one of them only, the one fewest of the given urls hold
(counted over all of them); a url's tokens fetch the rules indexed under them, and only those rules run their
expressions. Of the rules that match, those with a host (``rank`` 0) come before the general ones, then the longest
name wins, then the first in code-point order; no rule: allow.

Each distinct url is judged once and the verdict joined back. The index is joined through a broadcast up to
BROADCAST_RULES rules (at most 500 characters each, so a few MB) and by a shuffle on the token beyond that.

Rows: a null url, or one without ``://``, has empty host and path and no tokens, so only rules without tokens could
match it (there are none) and it is allowed; repeated rows each get their verdict; null ids stay null; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 10_000
TOKEN = r"[0-9a-z]+"


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 1

    def __post_init__(self):
        if not self.tokens or any(not re.fullmatch(TOKEN, t) for t in self.tokens):
            raise ValueError(f"rule {self.name!r} needs literal tokens of {TOKEN}")
        if self.action not in ("allow", "block") or len(self.pattern) > 500:
            raise ValueError(f"rule {self.name!r}: action or pattern")


def host_rule(rule: str, action: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the url's path starts with the rule's."""
    host, slash, path = rule.partition("/")
    literal = lambda s: re.sub(r"([^0-9A-Za-z/])", r"\\\1", s)
    tokens = tuple(re.findall(TOKEN, host.lower()))
    # A host ends before / ? and #, so what stands before the dot is any number of its labels.
    return Rule(rule, action, rf"^(?:[^/?#]*\.)?{literal(host.lower())}{literal(slash + path)}", tokens, 0)


#: The contract's rules.
HOST_RULES = (
    host_rule("net/", "block"),
    host_rule("example.net/en/", "allow"),
    host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
)

#: The method's own rules: no prose is behind these.
GENERAL_RULES = (
    *[Rule(f"{e} file", "block", rf"^[^?#]*\.{e}(?:[?#]|\z)", (e,)) for e in ("apk", "dmg", "exe", "iso", "zip")],
    *[Rule(f"{p} page", "block", rf"^[^/?#]*/(?:[^?#]*/)?{p}(?:[/?#.]|\z)", (p,)) for p in ("cart", "checkout", "login")],
    Rule("blog admin", "block", r"^[^/?#]*/(?:[^?#]*/)?wp-admin(?:[/?#.]|\z)", ("wp", "admin")),
    *[Rule(f"{h} host", "block", rf"^(?:[^/?#]*[.-])?{h}[.-][^/?#]*(?:[/?#]|\z)", (h,)) for h in ("casino", "porn", "xxx")],
)


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rest(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(.*)$", 1)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1))


def index(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """rules (name, action, rank, pattern, tokens) with the token each is indexed under."""
    held = url_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    listed = rules.select("name", F.explode("tokens").alias("token"))
    rarest = (
        listed.join(held, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))["token"].alias("token"))
    )
    return rules.drop("tokens").join(rarest, "name")


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = HOST_RULES + GENERAL_RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule (the host rule that decided, or null), matched (name of any rule), verdict."""
    spark = pages.sparkSession
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rule names repeat")
    table = spark.createDataFrame(
        [(r.name, r.action, r.rank, r.pattern, list(r.tokens)) for r in rules],
        "name string, action string, rank int, pattern string, tokens array<string>",
    )
    wanted = F.array(*[F.lit(t) for t in sorted({t for r in rules for t in r.tokens})]) if len(rules) <= BROADCAST_RULES else None
    distinct = pages.select(F.col(url_col).cast("string").alias("url")).filter(F.contains("url", F.lit("://"))).distinct()
    normal = distinct.withColumn("normal", F.concat(host(F.col("url")), rest(F.col("url"))))
    held = tokens(F.col("normal"))
    if wanted is not None:  # tokens of no rule fetch nothing
        held = F.array_intersect(held, wanted)
    listed = normal.withColumn("token", F.explode(held))
    indexed = index(table, listed)
    if len(rules) <= BROADCAST_RULES:
        indexed = F.broadcast(indexed)
    fired = listed.join(indexed, "token").filter(F.expr("regexp(normal, pattern)"))
    best = fired.groupBy("url").agg(
        F.min(F.struct(F.col("rank"), -F.length("name"), F.col("name"), F.col("action"))).alias("best")
    )
    return (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
        .join(best, "url", "left")
        .select(
            "page_id",
            host(F.col("url")).alias("host"),
            path(F.col("url")).alias("path"),
            F.when(F.col("best.rank") == 0, F.col("best.name")).alias("rule"),
            F.col("best.name").alias("matched"),
            F.coalesce("best.action", F.lit("allow")).alias("verdict"),
        )
    )
