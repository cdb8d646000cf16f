"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host, a path prefix and an action. Each rule is filed under the one of its literal tokens that the fewest
urls hold. A url's tokens fetch its candidate rules and only those run their regular expression. The longest rule that
fits wins; of equally long ones a block.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import lower_ascii

#: Rules that the registered query judges by: action, host, path.
CONTRACT_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Rules are broadcast in blocks of this many, so the size of a broadcast is bounded whatever their number.
RULE_BLOCK = 50_000

_TOKENS = r"[^A-Za-z0-9_\x80-\x{10FFFF}-]+"


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z in lower case) and path; both empty where the url is null or holds no ://."""
    start = F.locate("://", F.col(url))
    after = F.when(start > 0, F.substr(F.col(url), start + 3)).otherwise("")
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return df.withColumns({"host": lower_ascii(host), "path": F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)})


def _literal_tokens(host: str, path: str) -> list[str]:
    """Tokens that every url fitting the rule holds whole: the host's labels, and path parts closed by a separator."""
    closed = re.split(r"[^A-Za-z0-9_\x80-\U0010FFFF-]+", path)[:-1]
    return sorted({t for t in [*re.split(r"[^A-Za-z0-9_\x80-\U0010FFFF-]+", host), *closed] if t})


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row per rule: its name, action, regular expression over host and path, and literal tokens."""
    rows = []
    for action, host, path in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"unknown action {action}")
        pattern = rf"^(?:[^/]*\.)?{re.escape(host.lower())}{re.escape(path)}"
        tokens = _literal_tokens(host.lower(), path)
        if not tokens:
            raise ValueError(f"rule {host}{path} has no literal token to file it under")
        rows.append((f"{host}{path}", action, pattern, tokens))
    return spark.createDataFrame(rows, "rule string, action string, pattern string, tokens array<string>")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each distinct (host, path) that some rule fits: host, path, rule, action.

    urls has the columns host and path, rules those of rule_table; null rules are ignored. Any number of rows may repeat one url: each url is judged once.
    """
    distinct = urls.select("host", "path").distinct()
    tokens = distinct.select("host", "path", F.explode_outer(
        F.array_distinct(F.array_remove(F.split(F.concat("host", F.lit("/"), "path"), _TOKENS), ""))).alias("token"))
    found = None
    rules = rules.where("rule is not null and pattern is not null").dropDuplicates(["rule", "action"])
    blocks = max(1, -(-rules.count() // RULE_BLOCK))
    for block in range(blocks):
        part = rules.where(F.pmod(F.xxhash64("rule", "action"), F.lit(blocks)) == block)
        literals = part.select("rule", "action", "pattern", F.explode("tokens").alias("token"))
        wanted = literals.select("token").distinct()
        counts = tokens.join(F.broadcast(wanted), "token").groupBy("token").agg(F.count("*").alias("n"))
        rarest = (literals.join(counts, "token", "left")
                  .groupBy("rule", "action", "pattern")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
                  .select("rule", "action", "pattern", F.col("best.token").alias("token")))
        indexed = tokens.join(F.broadcast(rarest), "token")
        fit = indexed.where("rlike(concat(host, path), pattern)").select("host", "path", "rule", "action")
        found = fit if found is None else found.unionByName(fit)
    best = F.max(F.struct(F.length("rule").alias("n"), "action", "rule"))
    return found.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")


def filter_urls(df: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", fallback: str = "allow") -> DataFrame:
    """Adds host, path, rule (null where none fits) and verdict (the rule's action, or fallback) to every row of df.

    Null, empty and malformed urls have an empty host and path and get the fallback. Repeated rows each get their row.
    Columns of df called host, path, rule or verdict are replaced.
    """
    parts = url_parts(df.drop("host", "path", "rule", "verdict"), url)
    rules_df = rule_table(df.sparkSession, rules)
    best = match_rules(parts, rules_df)
    return parts.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("action", F.lit(fallback))).drop("action")
