"""URL filters: host-suffix and path-prefix expressions against block and allow rules.

Every distinct host and path is expanded into its host suffixes (whole labels) times the path
prefixes of those lengths that rules have. Expressions meet rules in an equi-join on the first
hexadecimal digits of their SHA-256 digests; the whole digests confirm, and the longest rule wins.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
#: Hexadecimal digits of a digest that the join is on.
SHORT = 8
#: What a url is that no rule fits.
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url) -> tuple:
    """Columns (host, path): after the first :// up to /, ? or #; then up to ? or #."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1))
    rest = F.coalesce(rest, F.lit(""))
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.left(rest, slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))
    return F.translate(host, _UPPER, _LOWER), path


def _after(url):
    return F.substr(url, F.instr(url, "://") + 3)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = DEFAULT,
    short: int = SHORT,
) -> DataFrame:
    """All columns of pages, and host, path, rule and verdict.

    rules: (host, path, verdict). A rule fits its host and all hosts below it when the path starts
    with the rule's; of the rules that fit, the one with most characters wins, then the one with
    the longer host, then block before allow. rule is null and verdict the default where none fits.

    A null url, or one without ://, has an empty host and path, which no rule fits. Rules with a
    null or empty host, or a null path or verdict, are ignored; repeated rules count once. Repeated
    rows of pages are kept. An empty table of rules leaves every verdict at the default. Columns of
    pages called host, path, rule or verdict are replaced, others may have any name.
    """
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url_col))
    # columns of pages stay in a struct, so that their names meet no other
    judged = pages.select(F.struct(*own).alias("row"), host.alias("host"), path.alias("path"))

    # an expression is the host, a line feed, which no host has, and the path
    usable = rules.where("host <> '' and path is not null and verdict is not null").select("host", "path", "verdict")
    usable = usable.distinct().select(
        F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"),
        F.concat("host", "path").alias("rule"),
        F.char_length("host").alias("rule_host"),
        F.char_length("path").alias("rule_path"),
        "verdict",
    )
    usable = usable.withColumn("short", F.left("digest", F.lit(short)))
    lengths = usable.agg(F.collect_set("rule_path").alias("lengths"))  # one row

    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter("lengths", lambda n: n <= F.char_length("path")), lambda n: F.left(F.col("path"), n)
    )
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat_ws("\n", s, p))))
    places = judged.select("host", "path").where("host <> ''").distinct()
    expanded = places.crossJoin(F.broadcast(lengths)).select("host", "path", F.explode(expressions).alias("expression"))
    expanded = expanded.withColumn("whole", F.sha2("expression", 256)).select(
        "host", "path", "whole", F.left("whole", F.lit(short)).alias("short")
    )
    fits = expanded.join(usable, "short").where(F.col("whole") == F.col("digest"))
    order = F.struct(
        F.char_length("rule").alias("a"), F.col("rule_host").alias("b"), (F.col("verdict") == "block").alias("c"),
        F.col("rule").alias("d"),
    )
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    # urls without a host meet no rule; they may be many, and would all be one key
    named = judged.where("host <> ''").join(best, ["host", "path"], "left")
    bare = judged.where("host = ''").select("host", "path", "row", F.lit(None).cast(best.schema["best"].dataType).alias("best"))
    out = named.select("host", "path", "row", "best").union(bare)
    return out.select(
        *[F.col("row")[c].alias(c) for c in own],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
