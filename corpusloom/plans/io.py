"""Source / sink round trips over data derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pyspark.sql import types as T

from corpusloom.functions.tokens import ids_to_string
from corpusloom.session import scratch_path
from corpusloom.operators.joins import bounded_broadcast
from corpusloom.sources import commits
from corpusloom.streaming.incremental import build_instructions_incrementally
from corpusloom.sources.files import (append_manifest, files_to_build, read_nul_chunks, read_text_lines,
                                     write_nul_chunks)
from corpusloom.plans.sqlfrag import DOC_LINES
from corpusloom.sources.testdata import table

FILES_A_TASK = 100


def nul_chunks(spark, sf):
    """documents written as NUL-delimited JSON chunks, read back (empty chunks skipped)."""
    path = scratch_path(spark, "nul-chunks")
    write_nul_chunks(table(spark, sf, "documents"), "text", path)
    return read_nul_chunks(spark, path)


def cache_plan(spark, sf):
    """After a first build, rewriting one source folder makes exactly its file need a rebuild.

    documents are stored one folder per ``source`` (files written by every
    task that holds the source, so a hot source is spread over tasks); the
    first listing is recorded in the manifest; ``src0`` is then rewritten;
    the second listing, anti-joined with the manifest, names only its files.
    """
    root = scratch_path(spark, "cache-plan")
    data, manifest = f"{root}/data", f"{root}/manifest"
    docs = table(spark, sf, "documents")
    docs.write.partitionBy("source").parquet(data)
    first = files_to_build(spark, data, manifest, config_hash="v1", glob="*.parquet")
    append_manifest(first, manifest)
    (docs.filter(F.col("source") == "src0").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(data))
    listing = files_to_build(spark, data, None, config_hash="v1", glob="*.parquet")
    stale = files_to_build(spark, data, manifest, config_hash="v1", glob="*.parquet").select(
        "file", F.lit(True).alias("needs_build"))
    per_file = listing.join(stale, "file", "left").select(
        F.regexp_extract("file", r"source=([^/]+)/", 1).alias("source"),
        F.coalesce("needs_build", F.lit(False)).alias("needs_build"))
    return per_file.groupBy("source").agg(F.bool_or("needs_build").alias("needs_build"))


def cache_commits(spark, sf):
    """S8 as a log: documents, one folder per ``source``; build, change, build, and read what is live.

    After the first commit the files of ``src0`` are replaced (new files, the old ones are gone: tombstones).  A
    build of that state stops before its commit and leaves nothing; the next one is recorded.  ``before`` is the text
    as of the first commit, so the log's two states stand side by side.
    """
    root = scratch_path(spark, "cache-commits")
    data, built, log = f"{root}/data", f"{root}/built", f"{root}/log"
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")

    def make(todo):
        # every file is one row of ``todo``: the rows of the files to build, told by their metadata
        rows = spark.read.schema("doc_id bigint, text string, source string").parquet(data).withColumn(
            "file", F.col("_metadata.file_path"))
        return rows.join(bounded_broadcast(todo.select("file")), "file", "left_semi")

    def build():
        return commits.build_changed(spark, data, built, log, "v1", make, "file", glob="*.parquet")

    docs.write.partitionBy("source").parquet(data)
    first = build()
    (docs.filter(F.col("source") == "src0").withColumn("text", F.concat("text", F.lit("!"))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(data))
    plan = commits.plan_build(spark, data, log, "v1", "*.parquet")
    commits.stage(make(plan.filter(F.col("action") == commits.ADD)), "file", built)  # stopped here
    build()
    schema = "doc_id bigint, text string, source string, file string"
    now = commits.read_live(spark, built, log, schema).select("doc_id", "source", "text")
    before = commits.read_live(spark, built, log, schema, as_of=first).select("doc_id", F.col("text").alias("before"))
    return now.join(before, "doc_id")


def incremental_sft(spark, sf):
    """ST1: instruction files arrive in two waves; each availableNow run labels only the new files.

    Wave 1 holds the first pair of every dialogue, wave 2 the rest; the sink
    read back must equal the batch ``sft_labels`` (nothing lost, nothing twice).
    """
    from corpusloom.plans.dialogue import instruction_rows

    root = scratch_path(spark, "incremental-sft")
    src, out, ck = f"{root}/in", f"{root}/out", f"{root}/ck"
    rows = instruction_rows(spark, sf)
    keys = [T.StructField("conv_id", T.LongType()), T.StructField("pair_no", T.LongType())]
    rows.filter(F.col("pair_no") == 0).write.json(f"{src}/wave=1")
    build_instructions_incrementally(spark, f"{src}/*", out, ck, extra_fields=keys)
    rows.filter(F.col("pair_no") > 0).write.json(f"{src}/wave=2")
    build_instructions_incrementally(spark, f"{src}/*", out, ck, extra_fields=keys)
    t = spark.read.parquet(out)
    return t.select("conv_id", "pair_no", F.size("input_ids").cast("bigint").alias("n_tokens"), "supervised_tokens",
                    ids_to_string("input_ids").alias("input_ids"), ids_to_string("labels").alias("labels"))


def text_scan(spark, sf):
    """S1 round trip: documents written as .txt files, read back one row per line.

    -> (line, idx_valid): the multiset of lines equals the documents' lines, and
    ``idx_valid`` says the line positions run 0..n-1 inside the line's file
    (file names are random, so they are not part of the output).
    """
    from pyspark.sql import Window

    path = scratch_path(spark, "text-scan")
    table(spark, sf, "documents").select("text").write.text(path)
    lines = read_text_lines(spark, path, glob="*.txt")
    w = Window.partitionBy("file")
    ok = (F.min("idx").over(w) == 0) & (F.max("idx").over(w) == F.count(F.lit(1)).over(w) - 1)
    return lines.select(F.col("text").alias("line"), ok.alias("idx_valid"))


def image_manifest_join(spark, sf):
    """S4 round trip: image files are written for the image conversations (one small file each, its bytes the
    conversation's first turn text) into the shared folder; the folder listing (``binaryFile``: path and length,
    contents not loaded) is left-joined to the records on the image path; absent files would go to ``missing``.
    """
    from corpusloom.operators import turns
    from corpusloom.sources.files import image_manifest, join_images

    root = scratch_path(spark, "images")
    conv = table(spark, sf, "conversations")
    first_text = conv.groupBy("conv_id").agg(F.min(F.struct("turn", "text"))["text"].alias("body"))
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    bodies = first_text.filter(has_img).select(
        F.concat(F.col("conv_id").cast("string"), F.lit(".jpg")).alias("image"), F.coalesce("body", F.lit("")).alias("value"))
    # few bytes but many files: dealt by files, and each task puts its own in place (the folder is fresh)
    n_files = conv.filter(has_img).select("conv_id").distinct().count()
    (bodies.repartition(max(1, -(-n_files // FILES_A_TASK)), "image")
     .write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("image").text(root))
    listing = image_manifest(spark, root).select(
        F.concat(F.lit("images/"), F.regexp_extract("rel_path", r"image=([^/]+)/", 1)).alias("rel_path"), "length")
    convs = turns.conversation_messages(conv, lambda k: F.pmod(k, F.lit(3)) == 0, stage="raw")[1]
    records = convs.select("conv_id", F.when(F.col("has_img"), F.concat(
        F.lit("images/"), F.col("conv_id").cast("string"), F.lit(".jpg"))).alias("image"))
    matched, missing = join_images(records, listing)
    out = matched.withColumn("found", F.col("length").isNotNull()).unionByName(
        missing.withColumn("found", F.lit(False)))
    return out.select("conv_id", "image", "found")


def dialogue_array_scan(spark, sf):
    """S3 round trip: all dialogues written as one file that holds one JSON array (the fixture, written by one task),
    read back in splits, one row per message.

    The array is rebuilt line by line: a bracket, the records with commas before all but the first, a bracket.
    """
    from corpusloom.operators.dialogue import records_from_turns
    from corpusloom.sources.files import dialogue_turns, read_dialogues

    path = scratch_path(spark, "dialogue-array")
    rec = records_from_turns(table(spark, sf, "conversations")).select(
        "conv_id", F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), F.col("msgs").alias("conversations"))).alias("value"))
    first = rec.agg(F.min("conv_id")).first()[0]
    lines = rec.select("conv_id", F.concat(F.when(F.col("conv_id") == first, "").otherwise(","), "value").alias("value"))
    ends = spark.createDataFrame([(-1, "["), (1 << 62, "]")], "conv_id long, value string")
    lines.unionByName(ends).coalesce(1).sortWithinPartitions("conv_id").select("value").write.text(path)
    return dialogue_turns(read_dialogues(spark, path)).select(F.col("id").cast("bigint").alias("conv_id"), "turn", "from", "value")


QUERIES = {"dialogue_array_scan": dialogue_array_scan, "text_scan": text_scan, "nul_chunks": nul_chunks, "cache_plan": cache_plan,
           "cache_commits": cache_commits, "incremental_sft": incremental_sft,
           "image_manifest_join": image_manifest_join}

ORACLE = {
    "dialogue_array_scan": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn,
       CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS "from", text AS "value"
FROM conversations WHERE role <> 'system'""",
    "text_scan": f"WITH {DOC_LINES} SELECT line, true AS idx_valid FROM doc_lines",
    "nul_chunks": "SELECT text FROM documents",
    "cache_plan": "SELECT DISTINCT source, source = 'src0' AS needs_build FROM documents",
    "cache_commits": """SELECT doc_id, source, CASE WHEN source = 'src0' THEN text || '!' ELSE text END AS text, text AS before
FROM documents""",
    "image_manifest_join": """SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'images/' || CAST(conv_id AS VARCHAR) || '.jpg' END
       AS image, conv_id % 3 = 0 AS found FROM (SELECT DISTINCT conv_id FROM conversations)""",
}


def _incremental_oracle():
    from corpusloom.plans.dialogue_sql import ORACLE as D

    return D["sft_labels"]


ORACLE["incremental_sft"] = _incremental_oracle()
