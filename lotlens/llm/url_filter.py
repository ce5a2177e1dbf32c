"""URL rules that are looked up by their rarest literal token.

A rule is a regular expression over ``host + path`` with a verdict. Its literal
tokens are runs of letters and digits that every matching address must hold as
whole tokens. The tokens of all rules are counted over all addresses, and each
rule is filed under its rarest one. An address fetches the rules filed under its
own tokens and runs only their expressions. Rules without any literal token are filed
under the empty one, which every address has, so that all rules take one pass. The index is
written first: a small one is broadcast, a large one joined by shuffles. Of the rules that fit, the longest wins, ties by name.

Defined cases: a null address, or one without ``://``, has an empty host and path
and meets only rules that fit the empty text; repeated rows are all judged; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, small_table

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    regex: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int  # the higher rank wins


def place_rule(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: the host and its subdomains, and paths that start with the path."""
    host, path = name[: name.index("/")], name[name.index("/") :]
    bounded = host + path[: path.rfind("/") + 1]  # what follows the last slash may go on in the address
    regex = rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(name, regex, verdict, tuple(re.findall(TOKEN, bounded.lower())), len(name) + 1_000)


def label_rule(label: str, verdict: str) -> Rule:
    """A label of the host name, such as ``spam-farm`` in ``www.spam-farm.org``."""
    regex = rf"^([^/]*\.)?{re.escape(label)}(\.|/|$)"
    return Rule(f"{label}.", regex, verdict, tuple(re.findall(TOKEN, label)), len(label))


#: The rules of the contract, and host labels and path parts of the common blocking lists' kind.
PLACES = (
    place_rule("net/", "block"),
    place_rule("example.net/en/", "allow"),
    place_rule("example.com/de/", "block"),
    place_rule("org/fr/", "allow"),
)
LABELS = tuple(
    label_rule(x, "block")
    for x in ("spam-farm", "cheap-pills", "online-casino", "adult-chat", "free-ringtones", "click-bait")
) + (
    Rule("/ads/", r"/ads/", "block", ("ads",), 5),
    Rule("/adserver", r"/adserver", "block", (), 9),
    Rule("/track.gif", r"/track\.gif$", "block", ("track", "gif"), 10),
)
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def tokens_of(address: Column) -> Column:
    return F.array_distinct(F.split(F.lower(address), "[^a-z0-9]+"))


def index_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules`` with a column ``token``: the literal that fewest addresses hold, null without any."""
    literals = rules.select("name", F.explode("tokens").alias("token"))
    held = addresses.select(F.explode("address_tokens").alias("token"))
    counts = held.join(literals.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return rules.join(rarest, "name", "left")


RULES = "name string, regex string, rule_verdict string, tokens array<string>, rank int"


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return small_table(spark, [(r.name, r.regex, r.verdict, list(r.tokens), r.rank) for r in rules], RULES)


def judge(
    df: DataFrame, key: str, url: str, rules: Sequence[Rule] | DataFrame, default: str = DEFAULT
) -> DataFrame:
    """``key``, ``host``, ``path``, the winning rule as ``rule`` and its ``verdict`` for every row.

    ``rules`` are literal ones, or a table with the columns of RULES; names are unique, null or no tokens
    mean that the expression has no literal.
    """
    rows = df.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # an address is judged once, however many rows share it
    addresses = (
        rows.select("host", "path")
        .distinct()
        .withColumn("address", F.concat("host", "path"))
        .withColumn("address_tokens", tokens_of(F.col("address")))
    )
    listed = rules if isinstance(rules, DataFrame) else rule_table(df.sparkSession, rules)
    filed = index_rules(addresses, listed).select(
        "name", "regex", "rule_verdict", "rank", F.coalesce("token", F.lit("")).alias("token")
    )
    filed = materialize(filed, "rule-index")
    every = F.array_distinct(F.concat("address_tokens", F.array(F.lit(""))))
    fetched = (
        addresses.select("host", "path", "address", F.explode(every).alias("token"))
        .join(filed, "token")
        .filter(F.expr("address rlike regex"))
        .select("host", "path", "rank", "name", "rule_verdict")
    )
    best = (
        fetched.groupBy("host", "path")
        .agg(F.max(F.struct("rank", "name", "rule_verdict")).alias("best"))
        .select("host", "path", F.col("best.name").alias("name"), F.col("best.rule_verdict").alias("rule_verdict"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        key,
        "host",
        "path",
        F.col("name").alias("rule"),
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )
