"""Labelled samples for the classifiers: bounded, chosen by hash, from the rows that are not held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is never learned from: ``crc32(doc_id as text) mod 5 = 0`` (also for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, text_col: str = "text") -> DataFrame:
    """``(text, y)`` of at most ``bound`` labelled documents that are not held out: of the ids that ``docs`` has, those
    that hash lowest, one row each.

    An id with several labels counts with the largest; labels other than 0 and 1 and null labels are left out.  An id
    with several rows counts with one of its texts (the one that hashes lowest, null as empty).
    """
    y = F.col(label).cast("int")
    some = labels.where(~held_out() & y.isin(0, 1)).groupBy("doc_id").agg(F.max(y).alias("y"))
    some = some.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # at most `bound` rows of an id and a bit
    rows = docs.select("doc_id", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("of")
    return rows.groupBy("doc_id", "y").agg(least).select(F.col("of.text").alias("text"), "y")
