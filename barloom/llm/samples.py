"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD_OUT = 2


def held_out(key: str = "doc_id") -> F.Column:
    """Rows never learnt from: crc32 of the id as text leaves ``HELD_OUT`` modulo 4."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text, y of at most ``per_class`` documents of each label 0 and 1, those with the smallest hashes of their ids.

    One row an id: of an id with several texts the one with the smallest hash counts, null being empty; of an
    id with both labels the smaller. Held-out rows, null ids and null labels are left out.
    """
    y = F.col(label).cast("int")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), y.alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    picked = [known.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_class rows
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(ids, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "y")
