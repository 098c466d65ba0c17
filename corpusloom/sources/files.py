"""File sources and sinks.

All readers take explicit schemas (no inference pass over the data) and keep
the file name from ``_metadata`` so later stages can order by file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.joins import bounded_broadcast
from corpusloom.session import checkpoint_root

MANIFEST_SCHEMA = "file string, mtime timestamp, length bigint, config_hash string, file_key string"

INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])

DIALOGUE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("conversations", T.ArrayType(T.StructType([
        T.StructField("from", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])


def read_text_lines(spark: SparkSession, path, glob: str = "*.txt") -> DataFrame:
    """Every ``glob`` file of a folder (not recursive) or of a list of paths, one row per line.

    -> (path STRING, file STRING, idx BIGINT, text STRING); ``idx`` is the line's
    position in its file, which ``path`` identifies (``file`` is only its name).

    Files are read in parallel splits, and no text moves: a first pass counts the
    lines of each split (path, start); sums over a file's earlier splits are
    broadcast back (one row per split, size-checked) and added to a line's place
    inside its split.  Both passes plan the same splits of the same files.
    """
    raw = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false").text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("_blk"),
            # the row's place in its task: the low bits, so that the task's number does not matter
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_row"),
            F.col("value").alias("text"),
        )
    )
    splits = raw.groupBy("path", "_blk").agg(F.min("_row").alias("_row0"), F.count(F.lit(1)).alias("_n"))
    checkpoint_root(spark)
    splits = splits.checkpoint(eager=True)  # one row per split
    earlier = Window.partitionBy("path").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "_blk", "_row0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return raw.join(bounded_broadcast(offsets), ["path", "_blk"]).select(
        "path", "file", (F.col("_off") + F.col("_row") - F.col("_row0")).alias("idx"), "text")


def read_instructions(spark: SparkSession, path: str, layout: str = "lines",
                      extra_fields: list[T.StructField] | None = None, split: str | None = None) -> DataFrame:
    """Instruction records; ``layout`` = 'lines' (JSON lines) or 'array' (one JSON array per file);
    both are read in splits.  ``path`` is the file a record lies in, ``file`` its name.

    ``extra_fields`` keeps further record fields (e.g. record keys) in the read schema.
    ``split`` (S5): tag the rows, e.g. 'eval' for an explicit validation file list.
    """
    schema = T.StructType(INSTRUCTION_SCHEMA.fields + list(extra_fields or []))
    out = _records(spark, path, layout, schema).withColumn("file", F.regexp_extract("path", "[^/]*$", 0))
    return out if split is None else out.withColumn("split", F.lit(split))


def read_dialogues(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """S3: dialogue records -> (id, image, conversations).

    ``layout`` = 'array' (one JSON array per file, read in splits by ``json_scan``) or 'lines' (JSON
    lines, read in splits).
    """
    return _records(spark, path, layout, DIALOGUE_SCHEMA).drop("path")


def _records(spark: SparkSession, path: str, layout: str, schema: T.StructType) -> DataFrame:
    """``(path, <fields of schema>)``: the records of JSON files, whatever the layout, and the file each lies in."""
    if layout == "lines":
        return spark.read.schema(schema).json(path).select(F.col("_metadata.file_path").alias("path"), "*")
    if layout != "array":
        raise ValueError(f"unknown layout {layout!r}")
    from corpusloom.sources.json_scan import read_json_array

    return read_json_array(spark, path, "*").select("path", F.from_json("json", schema).alias("r")).select("path", "r.*")


def with_record_key(dialogues: DataFrame, key: str = "conv_id", id_col: str = "id") -> DataFrame:
    """Records keyed by their id, or by their place (``#<number>``) where they have none.

    Two records of one id raise: a join on the key would multiply them.  The keyed rows are
    checkpointed, so that every later reader sees the same numbers.
    """
    checkpoint_root(dialogues.sparkSession)
    place = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    keyed = dialogues.withColumn(key, F.coalesce(F.col(id_col).cast("string"), place)).checkpoint(eager=True)
    twice = keyed.groupBy(key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"several records have the id {twice[0][0]!r}")
    return keyed


def dialogue_turns(dialogues: DataFrame, key: str = "id") -> DataFrame:
    """Exploded form: (key, turn, from, value)."""
    return dialogues.select(key, "image", F.posexplode("conversations").alias("turn", "msg")).select(
        key, "image", F.col("turn").cast("bigint").alias("turn"),
        F.col("msg.from").alias("from"), F.col("msg.value").alias("value"),
    )


def image_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(rel_path, length) of the files under an image folder; contents are not loaded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = folder.rstrip("/") + "/"
    return files.select(
        F.regexp_replace(F.regexp_replace("path", "^file:", ""), "^" + root.replace(".", "\\."), "").alias("rel_path"),
        F.col("length").cast("bigint").alias("length"),
    )


def join_images(records: DataFrame, manifest: DataFrame, image_col: str = "image"):
    """Left join records to the manifest on relative path.

    Returns (matched, missing): records without an image pass through in
    ``matched`` with null length; records naming an absent file go to
    ``missing`` (the reference raises on open).
    """
    files = manifest.withColumnRenamed("rel_path", image_col)
    # records without an image never enter the join, where they would all meet on one null key
    without = records.filter(F.col(image_col).isNull()).withColumn("length", F.lit(None).cast("bigint"))
    j = records.filter(F.col(image_col).isNotNull()).join(files, image_col, "left")
    missing = j.filter(F.col("length").isNull())
    return j.filter(F.col("length").isNotNull()).unionByName(without), missing


NUL_SCHEMA = "text array<string>"


def read_nul_chunks(spark: SparkSession, path: str) -> DataFrame:
    """NUL-delimited JSON chunks ``{"text": [...]}``; empty chunks skipped -> (chunk_text)."""
    raw = spark.read.option("lineSep", "\u0000").text(path)
    parsed = raw.filter(F.length("value") > 0).select(F.from_json("value", NUL_SCHEMA).alias("j"))
    return parsed.select(F.explode("j.text").alias("text"))


def write_nul_chunks(df: DataFrame, text_col: str, path: str) -> None:
    """Writer for the same layout: one JSON object per record, NUL-terminated."""
    out = df.select(F.to_json(F.struct(F.array(F.col(text_col)).alias("text"))).alias("value"))
    out.write.mode("overwrite").option("lineSep", "\u0000").text(path)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL after a schema-equality guard (as the reference asserts feature types)."""
    first = frames[0].schema
    for f in frames[1:]:
        if [(x.name, x.dataType) for x in f.schema] != [(x.name, x.dataType) for x in first]:
            raise ValueError(f"schema mismatch: {f.schema.simpleString()} vs {first.simpleString()}")
    return reduce(DataFrame.unionByName, frames)


def files_to_build(spark: SparkSession, folder: str, manifest_path: str | None, config_hash: str,
                   glob: str = "*") -> DataFrame:
    """Input files whose processed copy is missing or stale.

    A file needs building when no manifest row has the same (file,
    modification time, length, config hash): a left-anti join against the
    manifest of earlier builds.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
        .select(F.col("path").alias("file"), F.col("modificationTime").alias("mtime"), "length")
        .withColumn("config_hash", F.lit(config_hash))
    )
    if manifest_path is None:
        return listing
    try:
        manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return listing  # first build: no manifest yet
    return listing.join(manifest.select("file", "mtime", "length", "config_hash"),
                        ["file", "mtime", "length", "config_hash"], "left_anti")


def append_manifest(built: DataFrame, manifest_path: str) -> None:
    """Record built files: one row per file, a newer build replaces the older row."""
    replace_files(built.select("file", "mtime", "length", "config_hash"), "file", manifest_path)


def replace_files(rows: DataFrame, path_col: str, out: str) -> None:
    """Write rows in one folder per source file (named by the hash of its path), replacing the
    folders of the files that ``rows`` holds and no other."""
    keyed = rows.withColumn("file_key", F.md5(F.col(path_col)))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_key").parquet(out)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """(split, metric, value) rows appended to a metrics table."""
    metrics.select("split", "metric", F.col("value").cast("double")).write.mode("append").parquet(path)
