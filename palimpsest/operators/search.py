"""Term search over documents: J13, J14, J14b, A6, W4, and archive paths.

J14 (is a literal term contained in a document, and how often) has no
equi-join key. One exact plan at every size: documents emit the distinct
k-grams that stand every ``s`` characters, terms emit their k-grams at offsets
``0..s-1``; any occurrence of a term of length >= k + s - 1 covers one sampled
document position, so an equi-join on the gram finds every candidate document,
where the occurrences are then counted in the text. Terms shorter than the
class minimum go to a class with a smaller k. In every class k <= s, so that a
text is cut into its pieces in one pass. A gram may stand in very many
documents (boilerplate); its rows are dealt over several keys (:func:`salts`).

The result is ``(doc_id, term_idx, term, n_hits)`` where ``n_hits`` counts
non-overlapping, left-to-right literal occurrences; W4 adds the running total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DOC = "doc_id"
HIT_SCHEMA = "doc_id long, term_idx long, term string, n_hits long"


def terms_from_items(items: DataFrame) -> DataFrame:
    """Term list ``(term_idx, term)``: the whole text of each item."""
    return (items.select(F.col("item_id").alias("term_idx"), F.col("text").alias("term"))
            .where(F.length("term") > 0))


def tokens_from_items(items: DataFrame, token_pattern: str) -> DataFrame:
    """Term list ``(term_idx, term)`` of all distinct tokens of the items; ``term_idx`` is the first item that has it."""
    return (items.select("item_id", F.explode(F.regexp_extract_all("text", F.lit(token_pattern), F.lit(0))).alias("term"))
            .groupBy("term").agg(F.min("item_id").alias("term_idx")))


def salts(df: DataFrame) -> int:
    """Tasks that one gram or token is dealt over: grows with the job's shuffle partitions, 16 at least."""
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 64)


def _salted_join(rows: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join of document rows with a term list; a hot key of the rows meets the list in several tasks (:func:`salts`).

    What is left of the skew is split by adaptive execution, as in any inner join.
    """
    n = salts(rows)
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(DOC), F.lit(n)).cast("int"))
    copies = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")


# k-gram classes: (min term length, gram length k, stride s) with k + s - 1 <= min length.
_GRAM_CLASSES = [(1, 1, 1), (2, 1, 2), (4, 2, 3), (8, 4, 5), (16, 8, 9), (32, 16, 17), (64, 32, 33)]


def _gram_class(length_col):
    expr = F.lit(0)
    for i, (lo, _, _) in enumerate(_GRAM_CLASSES):
        expr = F.when(length_col >= lo, F.lit(i)).otherwise(expr)
    return expr


def term_hits_kgram(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """J14 + A6 by an exact k-gram equi-join (no broadcast, no nested loop): ``(doc_id, term_idx, term, n_hits)``.

    A document's text is read once for the grams of all length classes that
    occur, and once more where it has a candidate.
    """
    t = terms.select("term_idx", "term").withColumn("cls", _gram_class(F.length("term")))
    d = docs.select(DOC, "text")
    # Which length classes occur (at most len(_GRAM_CLASSES) values): a class
    # without terms must not make every document emit its grams.
    present = sorted(r["cls"] for r in t.select("cls").distinct().collect())
    if not present:
        return docs.sparkSession.createDataFrame([], HIT_SCHEMA)

    def gram(text, at, k: int, cls: int):
        return F.struct(F.lit(cls).alias("cls"), F.substring(text, at, F.lit(k)).alias("gram"))
    # term side: grams at offsets 0..s-1 of the term's class; only its own class counts
    def offsets(i: int):
        _, k, s = _GRAM_CLASSES[i]
        return F.when(F.col("cls") == i, F.transform(F.sequence(F.lit(1), F.lit(s)), lambda at: gram(F.col("term"), at, k, i)))
    tg = t.select("term_idx", "term", F.inline(F.array_distinct(F.coalesce(*[offsets(i) for i in present]))))

    # document side: the distinct grams at positions 0, s, 2s, ..., cut in one pass a class
    def sampled(i: int):
        _, k, s = _GRAM_CLASSES[i]
        pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{{k}}}.{{0,{s - k}}}"), F.lit(0))
        # told apart as plain strings, by hash; arrays of structs would be compared pair by pair
        distinct = F.array_distinct(F.transform(pieces, lambda p: F.left(p, F.lit(k))))
        return F.transform(distinct, lambda g: F.struct(F.lit(i).alias("cls"), g.alias("gram")))
    dg = d.select(DOC, F.inline(F.concat(*[sampled(i) for i in present])))
    cand = _salted_join(dg, tg, ["cls", "gram"]).select(DOC, "term_idx", "term").distinct()
    # occurrences counted as the literal replacement finds them: left to right, not overlapping
    n_hits = ((F.length("text") - F.length(F.replace("text", F.col("term"), F.lit("")))) / F.length("term")).cast("long")
    return cand.join(d, DOC).where(F.contains("text", F.col("term"))).select(DOC, "term_idx", "term", n_hits.alias("n_hits"))


def term_hits(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """J14 + A6 + W4: ``(doc_id, term_idx, term, n_hits, running_hits)``.

    ``running_hits`` is the cumulative hit count over the document's matched
    terms in term-list order (window over the matched pairs only).
    """
    w = Window.partitionBy(DOC).orderBy("term_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return term_hits_kgram(docs, terms).select(DOC, "term_idx", "term", "n_hits",
                                               F.sum("n_hits").over(w).cast("long").alias("running_hits"))


def term_tokens(docs: DataFrame, terms: DataFrame, token_pattern: str = r"[A-Z]+[0-9]+") -> DataFrame:
    """Terms that equal a whole token of the text, as an equi-join.

    Each document contributes its distinct tokens once; a token that stands in
    very many documents is dealt over several tasks.
    """
    toks = docs.select(DOC, F.explode(F.array_distinct(
        F.regexp_extract_all("text", F.lit(token_pattern), F.lit(0)))).alias("token"))
    return _salted_join(toks, terms.select("term_idx", F.col("term").alias("token")), ["token"]).select(
        DOC, "term_idx", F.col("token").alias("term"))


# --- archive members (S6, J13, D5) ----------------------------------------
# Member path layout of a dump: "<group>/<file>.xml" where the file name is
# "<area>_<kind>_<doc id>.xml".
def parse_member_path(path_col) -> list:
    """Group, file name, doc id and area parsed from an archive member path."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    group = F.regexp_extract(p, r"([^/]*)/([^./]*\.xml)", 1)
    fname = F.regexp_extract(p, r"([^/]*)/([^./]*\.xml)", 2)
    doc = F.regexp_extract(p, r"_([0-9]*)\.xml", 1)
    area = F.regexp_extract(fname, r"^([^0-9_]+)_[^0-9]+_", 1)
    return [F.nullif(group, F.lit("")).alias("grp"), F.nullif(fname, F.lit("")).alias("filename"),
            F.nullif(doc, F.lit("")).alias("doc_ref"), F.nullif(area, F.lit("")).alias("area")]


def read_archive(spark, root: str) -> DataFrame:
    """Every XML member of an unpacked dump, one row per file."""
    df = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.xml").text(root))
    rel = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*/[^/]*)$", 1)
    return df.select(rel.alias("member"), F.col("value").alias("text"))


def members_in_groups(members: DataFrame, groups: DataFrame, group_col: str = "grp") -> DataFrame:
    """Keep members whose group is in the lookup, before any parsing."""
    g = groups.select(F.col(group_col).alias("_g")).distinct()
    return members.join(g, members[group_col] == g["_g"], "left_semi")
