"""Verdicts on URLs by host and path rules, looked up by the rarest literal token of each.

A rule is a host and a path written together, as in ``example.net/en/``; a ``*`` stands for any
letters, in the host within a label.  It fits the host and its subdomains (all hosts, if it names
none), if the path of the URL begins with its path.  All is done by DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.sources.inline import values

# Fixed values.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))
RULE_COLUMNS = "rule string, verdict string"

# Rules without a literal token must run on every URL: each is filed under all of so many tokens,
# and a URL has one of them by its hash, so that no single key has all URLs.
SALTS = 64


def rule_table(spark, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    return values(spark, list(rules), RULE_COLUMNS)


def host_of(url: Column) -> Column:
    """The letters behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _pattern(literal: Column, any_letters: str) -> Column:
    quoted = F.regexp_replace(literal, r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.regexp_replace(quoted, r"\*", any_letters)


def _host_tokens(host: Column) -> Column:
    return F.transform(F.split(host, r"\."), lambda t: F.concat(F.lit("."), t))


def _path_tokens(path: Column) -> Column:
    """The segments of a path that a slash ends, or the end of the URL's path."""
    return F.transform(F.split(path, "/"), lambda t: F.concat(F.lit("/"), t))


def _compiled(rules: DataFrame) -> DataFrame:
    """Rules with the patterns for host and path and the literal tokens any fitting URL has.

    The last segment of a rule's path is no token: that of a URL may go on.  Nor are pieces
    with a star.
    """
    host, path = F.regexp_extract("rule", r"^[^/]*", 0), F.regexp_extract("rule", r"(?s)^[^/]*(.*)", 1)
    host = F.translate(host, UPPER, LOWER)
    any_host = F.when(host == "", F.lit("")).otherwise(F.concat(
        F.lit(r"(?s)(^|\.)"), _pattern(host, "[^.]*"), F.lit(r"\z")))
    pieces = F.concat(_host_tokens(host),
                      F.slice(_path_tokens(path), 1, F.greatest(F.size(F.split(path, "/")) - 1,
                                                                F.lit(0))))
    literal = F.array_distinct(F.filter(
        pieces, lambda t: (F.length(t) > 1) & ~F.contains(t, F.lit("*"))))
    return rules.select(
        "rule", "verdict",
        any_host.alias("_host_like"),
        F.concat(F.lit("(?s)^"), _pattern(path, ".*")).alias("_path_like"),
        literal.alias("_tokens")).filter("rule IS NOT NULL AND verdict IS NOT NULL").distinct()


def _salt(number: Column) -> Column:
    """No token of a host or path begins like this."""
    return F.concat(F.lit("#"), number.cast("string"))


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Every rule under that of its tokens which the fewest of ``urls`` have (``token``).

    ``urls`` has their tokens as an array; only tokens of rules are counted.  A rule none of
    whose tokens occurs is in the index all the same, as rare as can be.
    """
    compiled = _compiled(rules)
    of_rules = compiled.select("rule", F.explode("_tokens").alias("token"))
    wanted = of_rules.select("token").distinct()
    counts = (urls.select(F.explode("_tokens").alias("token"))
              .join(wanted, "token", "left_semi")
              .groupBy("token").agg(F.count(F.lit(1)).alias("_n")))
    rarest = (of_rules.join(counts, "token", "left")
              .groupBy("rule").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "token"))
                                   ["token"].alias("token")))
    salts = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), _salt)
    filed = compiled.drop("_tokens").join(rarest, "rule", "left")
    return filed.withColumn("token", F.explode(
        F.when(F.col("token").isNull(), salts).otherwise(F.array("token"))))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id",
               url: str = "url") -> DataFrame:
    """A row per page with ``page_id`` (the column ``key``), ``host``, ``path``, the longest
    rule that fits (null: none) and its verdict (``default`` without a rule).

    Each different URL is judged once.  Its tokens fetch the rules that are filed under them,
    and only the regular expressions of these run; no rule outside them can fit, as a fitting
    URL has all literal tokens of a rule.

    Nulls: a null URL, or one without ``://``, has an empty host and path, and no rule; rules with
    a null in them don't count.  Of fitting rules of equal length the first by text counts, and
    of one rule with both verdicts ``block``.  Repeated rows and equal keys stay; empty tables
    give no rows, or no rule.  Further columns are not read.
    """
    seen = pages.select(F.col(url).alias("_url")).filter("_url IS NOT NULL").distinct()
    placed = seen.select("_url", host_of(F.col("_url")).alias("_host"),
                         path_of(F.col("_url")).alias("_path")).filter("_host <> ''")
    placed = placed.withColumn("_tokens", F.array_distinct(F.concat(
        F.array(_salt(F.pmod(F.xxhash64("_url"), F.lit(SALTS)))), _host_tokens(F.col("_host")), _path_tokens(F.col("_path")))))
    index = rule_index(rules, placed)
    fetched = (placed.select("_url", "_host", "_path", F.explode("_tokens").alias("token"))
               .join(index, "token"))
    fits = F.rlike("_host", F.col("_host_like")) & F.rlike("_path", F.col("_path_like"))
    best = (fetched.filter(fits).groupBy("_url")
            .agg(F.min(F.struct((-F.length("rule")).alias("size"), "rule",
                                (F.col("verdict") != "block").alias("soft"), "verdict"))
                 .alias("_best")))
    told = pages.select(F.col(key).alias("page_id"), F.col(url).alias("_url"))
    return told.join(best, "_url", "left").select(
        "page_id", F.coalesce(host_of(F.col("_url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("_url")), F.lit("")).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
