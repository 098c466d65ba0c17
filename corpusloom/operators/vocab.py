"""Vocabulary tables.

A vocabulary is a DataFrame ``(id INT, piece STRING, score DOUBLE)`` with ids
0..n-1 in piece order.  Merging appends the extension's pieces that the base
lacks, in extension order, with score 0 (an ordered left-anti join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators.index import contiguous_index
from corpusloom.operators.tokenize import _by_value, coded_words
from corpusloom.session import checkpoint_root

BASE_SPECIALS = ["<unk>", "<s>", "</s>"]


def specials_frame(spark: SparkSession, pieces: list[str] = BASE_SPECIALS) -> DataFrame:
    rows = [(i, p, 0.0) for i, p in enumerate(pieces)]
    return spark.createDataFrame(rows, "id int, piece string, score double")


def word_counts(df: DataFrame, text_col: str, specials: list[str] = BASE_SPECIALS) -> DataFrame:
    """(piece, cnt): whitespace pieces of a text column counted, first within slices of rows by the tasks that read
    them: a slice's different pieces are shuffled, not its words."""
    coded = _by_value(coded_words)

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                places, _, words = coded(batch.column(0).slice(at, 4000))
                counts = pa.array(np.bincount(places, minlength=len(words)), pa.int64())
                part = pa.record_batch([words.cast(pa.string()), counts], names=["piece", "n"])
                yield part.filter(pc.greater(counts, 0))

    parts = df.select(F.col(text_col).cast("string")).mapInArrow(count, "piece string, n long")
    return parts.filter(~F.col("piece").isin(*specials)).groupBy("piece").agg(F.sum("n").alias("cnt"))


def vocab_from_text(df: DataFrame, text_col: str, specials: list[str] = BASE_SPECIALS) -> DataFrame:
    """Word pieces of a text column ranked by (count desc, piece asc) after the specials.

    Counting is a partial (map-side) aggregate; the rank is a contiguous index
    over the distinct pieces, no single-partition window.
    """
    counts = word_counts(df, text_col, specials).withColumn("_neg", -F.col("cnt"))
    ranked = contiguous_index(counts, ["_neg", "piece"], "_rank")
    pieces = ranked.select(
        (F.col("_rank") + F.lit(len(specials))).cast("int").alias("id"),
        "piece",
        F.col("cnt").cast("double").alias("score"),
    )
    return specials_frame(df.sparkSession, specials).unionByName(pieces)


def merge_vocab(base: DataFrame, ext: DataFrame) -> DataFrame:
    """Base pieces, then extension pieces absent from the base (extension order, score 0)."""
    base_size = base.agg(F.max("id")).first()[0] + 1
    new = ext.join(base.select("piece"), "piece", "left_anti")
    ranked = contiguous_index(new.select("id", "piece"), ["id"], "_rank")
    added = ranked.select(
        (F.col("_rank") + F.lit(base_size)).cast("int").alias("id"), "piece", F.lit(0.0).alias("score")
    )
    merged = base.select("id", "piece", "score").unionByName(added)
    # the merged vocabulary feeds several lookups and reports: materialize it once
    checkpoint_root(merged.sparkSession)
    return merged.checkpoint(eager=True)


def merge_counts(base: DataFrame, ext_counts: DataFrame) -> DataFrame:
    """``merge_vocab`` with an extension given as (piece, cnt) counts, i.e. in the order
    (count desc, piece asc) that ``vocab_from_text`` would give it.

    Only the extension pieces absent from the base are ranked: the extension's
    own ids are never needed, so its distinct pieces are not indexed.
    """
    base_size = base.agg(F.max("id")).first()[0] + 1
    new = ext_counts.join(base.select("piece"), "piece", "left_anti").withColumn("_neg", -F.col("cnt"))
    ranked = contiguous_index(new.select("_neg", "piece"), ["_neg", "piece"], "_rank")
    added = ranked.select(
        (F.col("_rank") + F.lit(base_size)).cast("int").alias("id"), "piece", F.lit(0.0).alias("score")
    )
    merged = base.select("id", "piece", "score").unionByName(added)
    checkpoint_root(merged.sparkSession)
    return merged.checkpoint(eager=True)


def vocab_stats(base: DataFrame, ext: DataFrame, merged: DataFrame) -> DataFrame:
    """One row per vocabulary: size, distinct pieces, special pieces, rows added over the base."""
    def sizes(df, name):
        return df.agg(
            F.count(F.lit(1)).cast("bigint").alias("size"),
            F.countDistinct("piece").cast("bigint").alias("n_distinct"),
            F.sum(F.when(F.col("piece").isin(*BASE_SPECIALS), 1).otherwise(0)).cast("bigint").alias("n_specials"),
        ).withColumn("vocab", F.lit(name))

    return sizes(base, "base").unionByName(sizes(ext, "ext")).unionByName(sizes(merged, "merged"))


def register_specials(vocab: DataFrame, wanted: list[str]) -> DataFrame:
    """Append wanted special pieces the vocabulary lacks (pad / image), in the given order."""
    spark = vocab.sparkSession
    size = vocab.agg(F.max("id")).first()[0] + 1
    want = spark.createDataFrame([(i, p) for i, p in enumerate(wanted)], "ord int, piece string")
    missing = want.join(vocab.select("piece"), "piece", "left_anti")
    added = missing.select(
        (F.lit(size) + F.row_number().over(Window.orderBy("ord")) - 1).cast("int").alias("id"),
        "piece",
        F.lit(0.0).alias("score"),
    )
    return vocab.select("id", "piece", "score").unionByName(added)


def sft_specials(pad_token: str | None) -> list[str]:
    """Pad registration rule: add ``[PAD]`` when the tokenizer has no pad token."""
    return [K.SFT_PAD_TOKEN] if pad_token is None else []


def mm_specials(pad_token: str | None) -> list[str]:
    """Multimodal rule: add ``<image>``, and ``<pad>`` unless the pad token already is ``<pad>``."""
    out = [K.IMAGE_TOKEN]
    if pad_token != K.PAD_TOKEN:
        out.append(K.PAD_TOKEN)
    return out


def vocab_guard(vocab: DataFrame, model_vocab_size: int) -> DataFrame:
    """Tokenizer size vs model embedding rows: ok flag and rows to add."""
    return vocab.agg(F.count(F.lit(1)).cast("bigint").alias("tokenizer_size")).select(
        "tokenizer_size",
        F.lit(model_vocab_size).cast("bigint").alias("model_vocab_size"),
        (F.col("tokenizer_size") >= F.lit(model_vocab_size)).alias("ok"),
        F.greatest(F.col("tokenizer_size") - F.lit(model_vocab_size), F.lit(0)).cast("bigint").alias("rows_to_add"),
    )


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Persist the merged vocabulary as Parquet."""
    vocab.write.mode("overwrite").parquet(path)
