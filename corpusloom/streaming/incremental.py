"""Incremental builds with Structured Streaming (ST1, S6).

The reference processes each input file once and reuses the processed copy
afterwards.  The streaming form: a file source over the input folder, the
row-local instruction steps (prompt, target, tokens, labels), and a Parquet
sink whose checkpoint records which files were already consumed; a run with
``availableNow`` processes exactly the new files and stops.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import constants as K
from corpusloom.operators import masks
from corpusloom.sources.files import INSTRUCTION_SCHEMA, NUL_SCHEMA


def build_instructions_incrementally(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                                     max_seq_length: int = K.SFT_MAX_SEQ_LENGTH,
                                     extra_fields: list[T.StructField] | None = None):
    """Consume new JSON-lines instruction files once; append their token rows to ``output_dir``."""
    schema = T.StructType(INSTRUCTION_SCHEMA.fields + list(extra_fields or []))
    rows = (
        spark.readStream.schema(schema).json(input_dir)
        .withColumn("file", F.col("_metadata.file_name"))
        .withColumn("source", masks.sft_source(F.col("instruction"), F.col("input")))
        .withColumn("target", masks.sft_target(F.col("output")))
        .filter(F.col("target").isNotNull())
    )
    labelled = masks.sft_labels(rows, max_seq_length).drop("source", "target")
    query = (
        labelled.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_nul_chunks(spark: SparkSession, input_dir: str):
    """S6 as a stream: NUL-delimited JSON chunks -> one row per text (empty chunks skipped)."""
    raw = spark.readStream.option("lineSep", "\u0000").text(input_dir)
    parsed = raw.filter(F.length("value") > 0).select(F.from_json("value", NUL_SCHEMA).alias("j"))
    return parsed.select(F.explode("j.text").alias("text"))
