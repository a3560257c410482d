"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into "host suffix + path prefix" expressions, as far as
a rule can equal them. A URL's host suffixes (at its labels, as far back as the
longest rule host) join the rules' hosts on the first 32 bits of their SHA-256
digests, then by the whole host; a host brings the lengths of its own rules'
paths, and only path prefixes of these lengths are made. An expression joins the
rules on the first 32 bits of its digest, then the full digests are compared. So a
URL's expressions do not grow with the number of rules of other hosts, and
of the rules one number alone, the longest host's length, comes to the driver. Of the rules that fit, the longest wins (code
points of host and path); then the one with the longer host, then block.

Defined cases: a URL that is null or has no ``://`` has an empty host and
path, which no rule with a host fits. URLs no rule fits get ``otherwise``.
The work is done once for each different (host, path) and joined back, so a
URL that a third of the rows share costs one expansion. Repeated rows each
give a row. An empty table gives an empty result. Extra columns are not read,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.shared import ascii_lower

#: the rules of the registered query: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit("\x1f"), host, path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def rule_table(spark, rules=RULES) -> DataFrame:
    """(verdict, host, path, digest, short, host_len, path_len)."""
    table = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    table = table.withColumn("host", ascii_lower(F.col("host"))).withColumn("digest", _digest(F.col("host"), F.col("path")))
    return table.select("*", _short(F.col("digest")).alias("short"), F.length("host").alias("host_len"), F.length("path").alias("path_len"))


def host_labels(host: Column, longest: int) -> Column:
    """The host cut at its dots, as far as its last ``longest`` characters
    reach: what is left of a longer host costs nothing."""
    tail = F.split(F.right(host, F.lit(longest + 1)), r"\.", -1)
    # the first piece of a cut host does not begin at a label
    return F.when(F.length(host) > longest, F.slice(tail, F.lit(2), F.size(tail))).otherwise(tail)


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    longest = rules.agg(F.max("host_len")).first()[0] or 0

    urls = rows.select("host", "path").distinct().withColumn("labels", host_labels(F.col("host"), longest))
    from_each = F.transform("labels", lambda _, i: F.array_join(F.slice("labels", i + 1, F.size("labels")), "."))
    suffixes = urls.select("host", "path", F.explode(from_each).alias("suffix"))
    suffixes = suffixes.withColumn("host_short", _short(F.sha2("suffix", 256)))
    hosts = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set("path_len").alias("path_lens"))
    hosts = hosts.withColumn("host_short", _short(F.sha2("rule_host", 256)))
    known = suffixes.join(hosts, "host_short").where(F.col("suffix") == F.col("rule_host"))
    lens = F.filter("path_lens", lambda p: p <= F.length("path"))
    asked = known.select("host", "path", "suffix", F.explode(lens).alias("p"))
    asked = asked.withColumn("asked", _digest(F.col("suffix"), F.expr("left(path, p)"))).withColumn("short", _short(F.col("asked")))

    full = rules.select("short", "digest", "verdict", F.concat("host", "path").alias("rule"), "host_len", "path_len")
    fits = asked.join(full, "short").where(F.col("asked") == F.col("digest"))
    rank = F.struct(F.col("host_len") + F.col("path_len"), "host_len", (F.col("verdict") == "block"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
