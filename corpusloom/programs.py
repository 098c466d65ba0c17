"""End-to-end dataset builds, one per data program of the reference.

* ``build_pretraining_corpus``: *.txt folder -> lines -> byte tokens -> blocks
  packed per file -> hash train/validation split -> Parquet, with the per-file
  build manifest (files already built are skipped).
* ``build_instruction_dataset``: instruction JSON -> prompt / target -> token
  rows with supervision labels -> Parquet; ``collate_instruction_batches``
  pads a built dataset into batches.
* ``build_dialogue_dataset``: dialogue JSON (+ image folder) -> cleaned
  records -> template of the model family -> masked token rows + sampler
  order -> Parquet.

Each function only composes the operators; everything runs as Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import batching, collate, dialogue, masks, metrics, packing
from corpusloom.operators.index import contiguous_index
from corpusloom.operators.tokenize import tokenize_bytes_arrow
from corpusloom.session import checkpoint_root
from corpusloom.sources import commits, files


def build_pretraining_corpus(spark: SparkSession, text_dir: str, out_dir: str, block_size: int,
                             model_max_length: int = 2048, batch_rows: int = packing.DEFAULT_BATCH_ROWS,
                             test_size: float = 0.05, manifest_path: str | None = None,
                             config_hash: str = "v1", log_path: str | None = None) -> DataFrame:
    """Pack the *.txt files of ``text_dir`` into blocks; returns the (split, metric, value) counts.

    With ``manifest_path`` only files absent from the manifest (same path,
    mtime, length, config) are built; the blocks of a file replace those of its
    earlier build, then the file is recorded (a failure in between builds it again).

    With ``log_path`` blocks and record become visible in one commit (``sources.commits``): emptied and deleted files
    lose their blocks too, and ``read_corpus`` reads what is live.
    """
    block = packing.clamp_block_size(block_size, model_max_length)
    checkpoint_root(spark)

    def packed(todo):
        # the listing of files to build (one row per input file, not data) drives the read
        paths = sorted(r[0] for r in todo.collect())
        lines = files.read_text_lines(spark, paths)
        blocks = packing.pack_blocks(
            lines, ["path", "idx"], block, batch_rows=batch_rows, per_group="path",
            length=F.octet_length("text") + F.lit(1), encode=lambda d: tokenize_bytes_arrow(d, "text"))
        keyed = blocks.withColumn("file", F.substring_index("path", "/", -1)).withColumn(
            "block_key", F.concat_ws("-", "path", "batch_id", "block_no"))
        return packing.split_by_hash(keyed, "block_key", test_size)

    if log_path is not None:
        if manifest_path is not None:
            raise ValueError("a build is recorded in a manifest or in a log, not in both")
        done = commits.build_changed(spark, text_dir, out_dir, log_path, config_hash,
                                     lambda todo: packed(todo.select("path")), "path", glob="*.txt")
        return _no_counts(spark) if done is None else _sample_counts(read_corpus(spark, out_dir, log_path))
    # one listing: what is read, built and recorded are the same files in the same state
    todo = files.files_to_build(spark, text_dir, manifest_path, config_hash, glob="*.txt").checkpoint(eager=True)
    if todo.isEmpty():
        return _no_counts(spark)
    files.replace_files(packed(todo.select("file")), "path", out_dir)
    if manifest_path is not None:
        files.append_manifest(todo, manifest_path)
    return _sample_counts(spark.read.parquet(out_dir))


CORPUS_SCHEMA = ("path string, batch_id bigint, block_no bigint, input_ids array<int>, attention_mask array<int>, "
                 "labels array<int>, file string, block_key string, split string")


def read_corpus(spark: SparkSession, out_dir: str, log_path: str, as_of: int | None = None) -> DataFrame:
    """The live blocks of a corpus that ``build_pretraining_corpus`` recorded in ``log_path``."""
    return commits.read_live(spark, out_dir, log_path, CORPUS_SCHEMA, as_of)


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "split string, metric string, value double")


def _sample_counts(built: DataFrame) -> DataFrame:
    counts = built.agg(F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).alias("n_train"),
                       F.sum(F.when(F.col("split") == "eval", 1).otherwise(0)).alias("n_eval"))
    return metrics.metric_rows([("train", "train_samples", F.col("n_train")),
                                ("eval", "eval_samples", F.col("n_eval"))], counts)


def build_instruction_dataset(spark: SparkSession, path, out_dir: str, max_seq_length: int = K.SFT_MAX_SEQ_LENGTH,
                              layout: str = "lines", null_output: str = "reject") -> DataFrame:
    """Instruction records -> (file, input_ids, labels, supervised_tokens) written to ``out_dir``."""
    recs = files.read_instructions(spark, path, layout)
    rows = recs.withColumn("source", masks.sft_source(F.col("instruction"), F.col("input"))).withColumn(
        "target", masks.sft_target(F.col("output"), null_output)).filter(F.col("target").isNotNull())
    labelled = masks.sft_labels(rows, max_seq_length).select("file", "input_ids", "labels", "supervised_tokens")
    labelled.write.mode("overwrite").parquet(out_dir)
    return spark.read.parquet(out_dir)


def collate_instruction_batches(dataset: DataFrame, batch_size: int, pad_id: int = K.SFT_PAD_ID,
                                seed: int = 0) -> DataFrame:
    """Seeded shuffle of a built dataset into batches of ``batch_size``, padded per batch."""
    # seeded order from the row content (identical rows tie, which cannot change the output)
    keyed = dataset.withColumn("_perm", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("file"),
                                                          F.col("input_ids").cast("string"),
                                                          F.col("labels").cast("string"))))
    idx = contiguous_index(keyed, ["_perm"], "_idx")
    batched = idx.withColumn("batch_id", F.floor(F.col("_idx") / F.lit(batch_size)).cast("bigint")).withColumn(
        "pos", F.pmod("_idx", F.lit(batch_size)).cast("bigint")).drop("_idx", "_perm")
    return collate.collate_pad(batched, pad_id)


def build_dialogue_dataset(spark: SparkSession, json_path: str, out_dir: str, model_id: str,
                           model_max_length: int = 2048, image_folder: str | None = None,
                           batch_size: int = 32, world_size: int = 1, grad_accum: int = 1,
                           group_by_modality: bool = True, seed: int = 0, layout: str = "array",
                           rejects_dir: str | None = None):
    """Dialogue JSON -> masked token rows in sampler order.

    Records without an id are keyed by their place; two of one id raise.  Dialogues whose roles do not
    alternate, whose first message is empty, or that hold no word are left out; ``rejects_dir`` gets
    (conv_id, reason) rows of them.
    Returns (dataset, records naming a missing image file or None without an image folder).
    """
    d = files.with_record_key(files.read_dialogues(spark, json_path, layout))
    recs = d.select(
        "conv_id",
        F.lit(None).cast("string").alias("system"),
        "image",
        F.transform("conversations", lambda c: F.struct(c["from"].alias("from"), c["value"].alias("value")))
        .alias("msgs"),
    )
    missing = None
    if image_folder is not None:
        recs, missing = files.join_images(recs, files.image_manifest(spark, image_folder))
        recs = recs.drop("length")
    bad = dialogue.rejected_records(recs)
    if rejects_dir is not None:
        bad.write.mode("overwrite").parquet(rejects_dir)
    recs = recs.join(bad.select("conv_id").distinct(), "conv_id", "left_anti")
    lengths = batching.dialogue_lengths(recs)
    order = batching.sampler_order(lengths, "conv_id", batch_size, world_size, grad_accum,
                                   group_by_modality=group_by_modality, seed=seed)
    cleaned = dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(recs))
    low = model_id.lower()  # P10: preprocessing chosen by the model id
    family = "llama_3" if "llama-3" in low else "llama_2" if "llama-2" in low else "default"
    masked = masks.mask_dialogues(cleaned, family, model_max_length)
    out = masked.join(order, "conv_id").select("conv_id", "image", "batch_no", "pos", "input_ids", "labels", "status",
                                               "n_supervised")
    out.write.mode("overwrite").parquet(out_dir)
    return spark.read.parquet(out_dir), missing
