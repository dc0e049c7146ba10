"""A corpus pipeline over documents: toxicity, quality, near duplicates, repeated passages, packing.

Every stage takes rows with a ``doc_id`` and a ``text`` and whatever other columns,
which all but the last hand on under their own names. Null text counts as empty.
Rows are never joined into one: repeated rows stay, or go, together. Empty input
gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import jaccard, packing, quality, suffixes, toxicity
from barloom.llm.common import discard, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go; equal texts have equal fates, and empty ones stay where the labels make them clean."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go; equal texts have equal fates, an empty one is scored as four zero bytes."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id stays.

    Texts without words link with nothing and stay, and so do rows with a null id.
    All rows of an id are one document, with its links: they stay or go together.
    """
    found = jaccard.jaccard_components(docs, jaccard.Threshold(80, 100, words=5))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur before, in a smaller id or earlier in the text, are cut; all rows stay.

    Rows of one id and text are one occurrence; of different texts of an id the one with the smaller hash is first.
    Rows with a null id are not compared. ``n_chars`` follows the text, where there is such a column.
    """
    kept = suffixes.remove_repeats(docs, min_words=50)
    return kept.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("bigint"))) if "n_chars" in docs.columns else kept


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens; an empty text is its end id alone, rows of one id are packed each on their own."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("best_fit_packing", pack_sequences),
]
#: No stage but the third and fourth can be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # nothing reads it any more
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
