"""Relevance and team lookups: A1, A2, A4, J7, J9, J10, J11.

Team lists are broadcast only where the size of their files is at most
``DIMENSION_BROADCAST_MAX_BYTES``; pattern and prefix lists, which are made of
growing tables, join as the run's measured sizes decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.constants import DIMENSION_BROADCAST_MAX_BYTES
from palimpsest.functions.text import leading_prefix, list_to_text


def bounded_broadcast(df: DataFrame, max_bytes: int = DIMENSION_BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a list that provably holds at most ``max_bytes``, else leave the choice to the run.

    The bound is the optimizer's: the size of the files or local rows that the
    list is read from, known without running anything. Lists made of joins or
    compressed tables have no such bound and come out unhinted; once their
    exchange has run and measured small, adaptive execution broadcasts them.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A1: distinct values of one column."""
    return df.select(col).distinct()


def distinct_prefixes(df: DataFrame, col: str = "chapter", out: str = "source") -> DataFrame:
    """A1 + D5: distinct leading non-digit prefixes of chapter numbers."""
    return df.select(leading_prefix(col).alias(out)).distinct()


def refs_with_counts(refs: DataFrame, pattern: str = "pattern", doc: str = "doc_ref", salts: int = 16) -> DataFrame:
    """A2 in long form: ``(pattern, doc_ref, n_refs)``, one row per reference with its pattern's count.

    The shape is the same for any number of references: no list is built. The
    counts are partially aggregated; the rows of a hot pattern are dealt over
    ``salts`` tasks where they meet their count.
    """
    counts = rows_per_pattern(refs, pattern).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = refs.select(pattern, doc).withColumn("_salt", F.pmod(F.xxhash64(doc), F.lit(salts)).cast("int"))
    return dealt.join(counts, [pattern, "_salt"]).select(pattern, doc, "n_refs")


def rows_per_pattern(refs: DataFrame, pattern: str = "pattern") -> DataFrame:
    """A4: number of reference rows per pattern."""
    return refs.groupBy(pattern).agg(F.count(F.lit(1)).alias("n_refs"))


def lookup_refs(df: DataFrame, refs: DataFrame, key: str = "chapter", pattern: str = "pattern",
                doc: str = "doc_ref") -> DataFrame:
    """Attach ``', '``-joined referring documents per chapter ('' when none).

    One row per row of ``df`` whatever the number of references. The text is
    one cell of the published report and holds every reference of its chapter;
    :func:`refs_with_counts` is the form without lists. ``df`` is read once.
    """
    lists = refs.groupBy(F.col(pattern).alias(key)).agg(list_to_text(F.sort_array(F.collect_list(doc))).alias("doc_info"))
    # No broadcast hint: a row count does not bound the bytes of these lists.
    # AQE still broadcasts them when the measured shuffle output is small.
    return (df.join(lists, key, "left")
            .withColumn("doc_info", F.coalesce("doc_info", F.lit(""))))


def relevance_flag(df: DataFrame, patterns: DataFrame, key: str = "chapter",
                   pattern: str = "pattern", out: str = "relevant") -> DataFrame:
    """Boolean membership of ``key`` in the pattern list."""
    p = patterns.select(F.col(pattern).alias("_pat")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(p, df[key] == p["_pat"], "left")
    return j.select(df["*"], F.coalesce(p["_hit"], F.lit(False)).alias(out))


def source_relevant(df: DataFrame, prefixes: DataFrame, key: str = "chapter",
                    prefix_col: str = "source") -> DataFrame:
    """Keep rows whose chapter prefix is in the prefix list."""
    p = prefixes.select(F.col(prefix_col).alias("_prefix")).distinct()
    return df.join(p, leading_prefix(key) == p["_prefix"], "left_semi")


def team_rows(df: DataFrame, teams: DataFrame, source: str = "source") -> DataFrame:
    """All teams in one pass — inner join on the exact, case-sensitive source.

    ``teams`` is ``(team, source)``; a document listed for two teams appears
    once per team.
    """
    t = teams.select("team", F.col("source").alias("_team_source"))
    return df.join(bounded_broadcast(t), df[source] == t["_team_source"]).drop("_team_source")


def team_filter(df: DataFrame, team_sources: DataFrame, source: str = "source") -> DataFrame:
    """J11 (single team): ``Source isin team list`` as a semi-join."""
    t = team_sources.select(F.col("source").alias("_team_source")).distinct()
    return df.join(bounded_broadcast(t), df[source] == t["_team_source"], "left_semi")
