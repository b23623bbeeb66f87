"""Operator 2: URL filters by a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, ranged

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(u, instr(u, '://') + 3)"))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_boundaries(rules: DataFrame) -> DataFrame:
    """Start and end of each rule's interval of keys, with the stack of rules active from there on.

    A rule ``host/path`` holds the keys that start with its reversed host and
    path: from that key up to the key with byte FF added, which no UTF-8 text
    contains. Intervals nest, so the stack after a start is the rule's own
    prefixes among the rules, found by an equi-join on all its prefixes; after
    an end it is the same without the rule.
    """
    r = rules.select(F.col("rule"), F.col("verdict"),
                     ascii_lower(F.substring_index("rule", "/", 1)).alias("host"),
                     F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("path"))
    r = r.withColumn("rkey", F.concat(reversed_host(F.split("host", r"\.")), "path"))
    # of equal rules the stricter one stands
    r = r.groupBy("rkey").agg(F.max(F.struct("verdict", "rule", "host")).alias("r")).select("rkey", "r.*")
    parts = r.select(F.col("rkey").alias("of"), F.explode(F.expr(
        "transform(sequence(1, length(rkey)), i -> substring(rkey, 1, i))")).alias("rkey"))
    stacks = (parts.join(r, "rkey").groupBy("of")
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.length("rkey").alias("n"), F.length("host").alias("host_n"), "verdict", "rule"))).alias("stack")))
    key = F.col("of").cast("binary")
    starts = stacks.select(key.alias("key"), F.lit(0).alias("kind"), "stack")
    ends = stacks.select(F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(0).alias("kind"),
                         F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    return starts.unionByName(ends), r.select("host").distinct()


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, default: str = "allow",
                page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Judge every url: ``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    ``rules`` are ``(verdict, rule)``; a rule ``host/path`` fits its host and
    all subdomains where the url's path starts with its path. The longest
    wins; among equally long ones that with the longer host, then a block
    before an allow. Where none fits, rule is null and verdict is ``default``;
    so for a null url or one without ``://``. Of two equal rules the block stands.

    Each distinct (host, path) is tried once per host suffix that has rules:
    suffix reversed, path appended. These keys and the rules' boundaries are
    range-sorted together, and a sweep hands down the last boundary's stack;
    each range starts with the stack that the ranges before it left. Repeated
    urls meet only in a join that Spark can split.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    bounds, hosts = rule_boundaries(rules)
    host, path = host_and_path(F.col("u"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("u")).select("page_id", host.alias("host"), path.alias("path"))
    distinct = rows.where("host <> ''").groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one")
    tries = (distinct.withColumn("labels", F.split("host", r"\."))
             .withColumn("suffix", F.explode(F.expr(
                 "transform(sequence(1, size(labels)), j -> array_join(slice(labels, j, size(labels)), '.'))")))
             .join(hosts.select(F.col("host").alias("suffix")), "suffix")
             .select(F.concat(reversed_host(F.split("suffix", r"\.")), "path").cast("binary").alias("key"),
                     F.lit(1).alias("kind"), F.lit(None).cast(bounds.schema["stack"].dataType).alias("stack"),
                     "host", "path"))
    events = ranged(tries.unionByName(bounds.withColumns({"host": F.lit(None), "path": F.lit(None)})),
                    F.col("key"), F.col("kind"), F.xxhash64("host"))

    left = events.groupBy("_part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
    carried = left.select("_part", F.last("last", ignorenulls=True).over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))  # a row per range
    sweep = W.partitionBy("_part").orderBy("key", "kind", "host").rowsBetween(W.unboundedPreceding, W.currentRow)
    active = F.coalesce(F.last("stack", ignorenulls=True).over(sweep), F.col("carried"))
    found = (events.join(F.broadcast(carried), "_part").withColumn("top", F.try_element_at(active, F.lit(-1)))
             .where("kind = 1 AND top IS NOT NULL")
             .groupBy("host", "path").agg(F.max(F.struct(F.length("top.rule").alias("n"), "top.host_n", "top.verdict", "top.rule")).alias("won")))
    return (rows.join(found, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", F.lit(default)).alias("verdict")))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rule, rhost, rpath) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/'))
SELECT u.page_id, u.host, u.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
QUALIFY row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rule) DESC NULLS LAST) = 1
"""
