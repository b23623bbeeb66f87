"""Corpus pipeline: documents through five training-data operators, each stage written as Parquet and reread.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the documents that go on, with their columns; the last
returns the mix. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import decontaminate, jaccard, mixing, suffix_dedup, toxicity
from palimpsest.llm.common import free_name, table
from palimpsest.session import drop_folder, ensure_checkpoint_dir

MIX_COLUMNS = ("size", "source_size", "target", "taken", "mix_offset")
REPEATED_WORDS = 51  # shortest run of words that counts as a repeat, whatever its bytes


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic.

    Null and empty texts get the intercept's score; repeated rows are judged
    alike; no documents, or no labels, give back what comes in.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id (null first), of each group linked by 5-word shingles at a likeness of 0.8 or more.

    Documents without words, null texts among them, link with nothing and stay; of rows equal in id and text one stays.
    """
    return jaccard.one_per_component(docs, k=5, percent=80)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of more than 50 words, or strings of 400 bytes, that stand anywhere else too; documents left empty go.

    Documents whose text is null or empty to begin with lose nothing and stay (null as empty text).
    """
    return suffix_dedup.remove_repeats(docs, length=400, words=REPEATED_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; null and empty texts hold none, repeated rows are judged one by one, without items all stay."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words it takes of each (repeats counted) and its source's target.

    Rows are told apart by id and a digest of all columns; of rows equal in all columns one gets the words of each.
    Null and empty texts have no words to take. A column of the documents that has the name of one of the mix
    (``MIX_COLUMNS``) goes on with ``doc_`` before it.
    """
    for c in docs.columns:
        if c.lower() in MIX_COLUMNS:
            docs = docs.withColumnRenamed(c, free_name(docs, f"doc_{c}"))
    row, own, key = (free_name(docs, n) for n in ("_row", "_own", "_key"))
    keyed = docs.withColumn(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    taken = (mixing.mix_sources(keyed, weights=(3, 1, 2), share=1.5, most=2, key=row).where("taken > 0")
             .select(F.col("doc_id").alias(own), F.col(row).alias(key), *MIX_COLUMNS))
    once = keyed.dropDuplicates(["doc_id", row])
    return once.join(taken, once["doc_id"].eqNullSafe(taken[own]) & (once[row] == taken[key])).drop(own, key, row)


STAGES = [("toxicity", drop_toxic), ("near copies", one_of_near_copies), ("repeated strings", remove_repeats),
          ("decontamination", drop_leaks), ("source mix", mix)]
ORACLE_SQL = None  # the classifier and the retrieval have no SQL form; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's output in the shared folder of checkpoints goes once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            drop_folder(spark, f"{folder}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
