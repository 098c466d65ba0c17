"""Token counts of flat token files: a separator scan over blocks of ids, stitched by a prefix scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.bpe import read_ranks
from corpusloom.llm.common import read_table, scratch, ship, worker_cache
from corpusloom.llm.segments import SegmentCache, batches_of_text

END = 50256
BLOCK = 1 << 20  # ids


def write_token_files(docs: DataFrame, path: str, ranks: str, pattern: str, end_id: int = END,
                      text_col: str = "text") -> None:
    """Flat files of little-endian unsigned 16-bit ids: every text's ids, then ``end_id``; no index beside them.

    The text writer puts each row's bytes into the file and ``end_id`` as its line separator, so one file is written
    per input partition by Spark itself, wherever ``path`` lies.
    """
    ship(docs.sparkSession)

    def run(batches):
        import tiktoken

        def make():
            coder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})
            return SegmentCache(lambda some: [np.array(coder.encode_ordinary(s), "<u2").tobytes() for s in some])

        cache = worker_cache(f"tiktoken:{ranks}:{pattern}", make)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in batches_of_text(texts):
                values, places = cache.looked_up(texts[a:z])
                yield pa.record_batch([pa.array([b"".join(map(values.__getitem__, p)) for p in places], pa.binary())], names=["ids"])

    separator = np.array([end_id], "<u2").tobytes().decode("latin-1")
    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", separator).option(
        "encoding", "ISO-8859-1").text(path)


def count_tokens(spark: SparkSession, path: str, end_id: int = END, block: int = BLOCK, dtype: str = "<u2") -> DataFrame:
    """``(file, doc_no, start, n_tokens, ended)``: one row per document of the flat token files at ``path``.

    A document is what lies before a separator: ``doc_no`` counts from 0 in its file, ``start`` is the place of its
    first id, ``n_tokens`` leaves the separator out (an empty text has 0).  Ids after the last separator of a file are
    a last document with ``ended`` false; a file that stops inside an id is an error.  Empty files give no rows.

    Each block of ``block`` ids is searched for separators at once; its documents begin where the last separator of
    an earlier block of the file lies, which a running maximum over the (few) blocks of a file brings.  Files are read
    whole, one at a time, by Spark's binary reader, so a file may have up to 2 GB.
    """
    ship(spark)
    size = np.dtype(dtype).itemsize

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                data = data.as_buffer()
                if data is None or not len(data):
                    continue
                if len(data) % size:
                    raise ValueError(f"{name.as_py()}: {len(data)} bytes are no whole number of ids")
                ids = np.frombuffer(data, dtype)
                for at in range(0, len(ids), block):
                    ends = np.flatnonzero(ids[at : at + block] == end_id).astype(np.int64) + at
                    stop = min(at + block, len(ids))
                    yield pa.record_batch([pa.array([name.as_py().rpartition("/")[2]]), pa.array([at // block], pa.int32()),
                                           pa.array([stop if stop == len(ids) else None], pa.int64()),
                                           pa.array([ends], pa.list_(pa.int64()))], names=["file", "block", "size", "ends"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    blocks = files.mapInArrow(run, "file string, block int, size long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks.select("file", "size", "ends",
                         (F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)) + 1).alias("begin"),
                         F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("first_no"))
    last = F.coalesce(F.array_max("ends") + 1, F.col("begin"))
    rows = rows.withColumn("ends", F.when(F.col("size") > last, F.concat("ends", F.array("size"))).otherwise(F.col("ends")))
    rows = rows.withColumn("starts", F.concat(F.array("begin"), F.transform("ends", lambda e: e + 1)))
    rows = rows.withColumn("pairs", F.arrays_zip(F.slice("starts", F.lit(1), F.size("ends")).alias("start"), F.col("ends").alias("stop")))
    rows = rows.select("file", "size", "first_no", F.posexplode("pairs").alias("i", "p"))
    stop = F.col("p")["1"] if "1" in rows.schema["p"].dataType.names else F.col("p")["stop"]
    start = F.col("p")["0"] if "0" in rows.schema["p"].dataType.names else F.col("p")["start"]
    return rows.select("file", (F.col("first_no") + F.col("i")).cast("long").alias("doc_no"), start.alias("start"),
                       (stop - start).alias("n_tokens"), (F.col("size").isNull() | (stop < F.col("size"))).alias("ended"))


def op9_token_counts(spark, sf_dir: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path,
                      ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    return count_tokens(spark, path)
