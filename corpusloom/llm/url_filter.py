"""URL filter: rules on hosts and path prefixes.

Each URL is expanded into host suffixes times path prefixes, as many labels and path segments as
the rules have. Expressions meet the rules in an equi-join on the first hex digits of a SHA-256;
the full digest, the rule's own path and the precedence (longest rule) are confirmed after it.

A rule path may end inside a segment: its expression ends at its last "/", the rest is confirmed
with a prefix test. Rules are broadcast while their count is at most BROADCAST_RULES (checked by
an action on the rule table); above, the join is shuffled with SALTS copies of each rule, so that
a suffix which a third of all URLs share is spread.

Defined cases: a null URL or one without "://" has an empty host and path and fits no rule; an
empty path fits only rules with an empty path; no rule: ``default``; two rules of one length: the
longer host, then block; repeated pages stay repeated; no rules or no pages: nothing fits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
BROADCAST_RULES = 100_000
SALTS = 16
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[Sequence[str]] = RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def _stem(path: Column) -> Column:
    """A rule's path up to its last "/"."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """Array of suffix + prefix strings: the last 1 to ``labels`` labels of the host, the first 0 to ``depth`` slashes of the path."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda k: F.concat_ws(".", F.slice(parts, -k, k)))
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    cuts = F.transform(F.sequence(F.lit(0), F.least(slashes, F.lit(depth))), lambda k: F.when(k == 0, F.lit("")).otherwise(_upto(path, k)))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(cuts, lambda p: F.concat(s, F.lit("\0"), p))))


def _upto(path: Column, k: Column) -> Column:
    pieces = F.split(path, "/")
    return F.concat(F.concat_ws("/", F.slice(pieces, F.lit(1), k)), F.lit("/"))


def judge(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", keep: Sequence[str] = ("page_id",), default: str = "allow") -> DataFrame:
    """The ``keep`` columns with host, path, rule (null if none fits) and verdict, a row for each row of ``pages``."""
    spec = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"),
        F.sha2(F.concat(F.col("host"), F.lit("\0"), _stem(F.col("path"))), 256).alias("r_digest"),
    ).withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS))
    bounds = rules.agg(F.count("*").alias("n"), F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.length(_stem(F.col("path"))) - F.length(F.replace(_stem(F.col("path")), F.lit("/"), F.lit("")))).alias("depth")).first()
    names = [f"k{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(url_col).alias("url"))
    # repeated rows are counted once and restored at the end
    rows = rows.groupBy(*names, "url").agg(F.count("*").alias("times")).withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    wide = rows.withColumn("expr", F.explode(expressions(F.col("host"), F.col("path"), bounds["labels"] or 0, bounds["depth"] or 0)))
    wide = wide.withColumn("digest", F.sha2("expr", 256)).withColumn("r_prefix", F.substring("digest", 1, PREFIX_DIGITS)).drop("expr")
    on = ["r_prefix"]
    if bounds["n"] <= BROADCAST_RULES:
        spec = F.broadcast(spec)
    else:
        wide = wide.withColumn("salt", F.pmod(F.xxhash64(*names, "url"), F.lit(SALTS).cast("long")))
        spec = spec.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        on = ["r_prefix", "salt"]
    hit = (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    best = F.max(F.when(hit, F.struct((F.length("r_host") + F.length("r_path")).alias("a"), F.length("r_host").alias("b"), (F.col("r_verdict") == "block").alias("c"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))))
    judged = wide.join(spec, on, "left").groupBy(*names, "url", "times", "host", "path").agg(best.alias("best"))
    return judged.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def op2(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


OP2_SQL = r"""
WITH rules(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
p AS (
  SELECT page_id, url, row_number() OVER () AS rid,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
),
hit AS (
  SELECT rid, arg_max((r_host || r_path, r_verdict), (length(r_host || r_path), length(r_host), r_verdict = 'block')) AS best
  FROM p JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY rid
)
SELECT page_id, host, path, best[1] AS rule, coalesce(best[2], 'allow') AS verdict
FROM p LEFT JOIN hit USING (rid)
"""
