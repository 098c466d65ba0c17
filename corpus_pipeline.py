"""The corpus pipeline: toxicity, quality, near-duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run`` writes every stage's
result to the shared folder and rereads it as the next one's ``docs``.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import packing, quality_gam, simhash, suffix_dedup, toxicity
from corpusloom.llm.common import read_table, saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled rows of ``docs``, does not reject.

    Where nothing could be learned (no labelled rows, one class only, no telling n-gram) all documents stay.
    """
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(toxicity.labelled_sample(docs, labels, "toxic", toxicity.SAMPLE))
    return toxicity.filter_by(docs.select(COLUMNS), model, lambda score: score < 0.5)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled rows of ``docs``, does not reject.

    Where nothing could be learned (no labelled rows, one class only) all documents stay.
    """
    labels = read_table(spark, sf_dir, "labels")
    model = quality_gam.fit_quality(quality_gam.labelled_sample(docs, labels, "quality", quality_gam.SAMPLE))
    return quality_gam.filter_by(docs.select(COLUMNS), model, lambda score: score >= 0.3)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group (4-word shingles, at most 4 bits apart).

    One row a group, also where ids are repeated or null (a null id is kept only if its group has no other).
    """
    return simhash.one_per_group(docs.select(COLUMNS), shingle_words=4, max_bits=4)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 100-byte strings that also start earlier; ``n_chars`` counts what is left.

    Documents stay even if nothing is left of them.
    """
    return suffix_dedup.without_repeats(docs.select(COLUMNS), min_len=100).withColumn(
        "n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 token ids in sequences, by the byte-level BPE of 50,257 ids, each text followed by id 1."""
    return packing.op6_columns(packing.pack(docs, packing.tokenizer_path(), length=2048, end_id=1))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", one_per_group),
    ("suffix-array dedup", without_repeats),
    ("packing", packed),
]

#: SQL cannot express classifiers and tokenizers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs, "pipeline-" + name.split()[0].lower())
    return docs
