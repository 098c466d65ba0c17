"""Packing by concatenate-and-cut: token totals per partition, prefix sums over them, fixed windows."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, saved, ship, worker_cache
from corpusloom.llm.segments import SegmentCache, batches_of_text, encode_joined


def _json_cache(path: str) -> SegmentCache:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    def make():
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        # a byte-level vocabulary writes every byte as one character
        id_bytes = np.zeros(t.get_vocab_size(), np.int64)
        for token, i in t.get_vocab().items():
            id_bytes[i] = len(token)

        def encode(texts):
            return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]

        return SegmentCache(lambda some: encode_joined(some, encode, id_bytes, "<u4"), 1_000_000)

    return worker_cache(f"tokenizers:{path}", make)


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(part, id_col, local, n, ids)``: each text's ids and ``end_id`` as little-endian unsigned 32-bit, and how
    many ids its partition has before it."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        part, local = TaskContext.get().partitionId(), 0
        cache = _json_cache(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in batches_of_text(texts):
                ids = cache.joined(texts[a:z], end)
                n = pc.binary_length(ids).to_numpy() // np.int64(4)
                at = local + np.cumsum(n) - n
                local += int(n.sum())
                yield pa.record_batch([pa.array(np.full(z - a, part, np.int32)), batch.column(0).slice(a, z - a),
                                       pa.array(at), pa.array(n), ids],
                                      names=["part", id_col, "local", "n", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"part int, {id_col} {kind}, local long, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces ``(id_col, start, length, ids, doc_tokens, sequence_id, offset, sequence_tokens, padded_tokens)``.

    All texts' ids, each text followed by ``end_id``, form one stream in table order, cut into windows of ``length``;
    a text that crosses a window border gives a piece on either side.  First pass: tokenize once into a table in the
    shared folder, with each partition's running count.  Prefix sums over the partition totals (one row a partition)
    give every partition's place in the stream.  Second pass: each task cuts its rows; nothing is shuffled.
    Only the last sequence can be short; it is padded to ``length`` unless its tokens are a power of two.

    Null and empty texts are the single ``end_id``.  Ids are passed on as they are (null, repeated); other columns are
    ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    tokens = saved(token_table(docs, tokenizer, end_id, id_col, text_col), "pack-tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
                          F.sum("total").over(Window.partitionBy(F.lit(0))).alias("all"))
    # one row per input partition
    rows = tokens.join(F.broadcast(bases), "part").select(id_col, (F.col("base") + F.col("local")).alias("at"), "all", "ids")

    def pieces(batch):
        ids = batch.column(3).to_pylist()
        n = np.array([len(x) // 4 for x in ids], np.int64)
        at, everything = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        first, last = at // length, (at + n - 1) // length
        count = last - first + 1
        row = np.repeat(np.arange(len(ids)), count)
        seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.maximum(at[row], seq * length)
        stop = np.minimum(at[row] + n[row], (seq + 1) * length)
        start = begin - at[row]
        used = np.minimum(everything[row] - seq * length, length)
        cut = [ids[r][4 * a : 4 * b] for r, a, b in zip(row.tolist(), start.tolist(), (stop - at[row]).tolist())]
        return pa.record_batch([
            batch.column(0).take(pa.array(row)), pa.array(start), pa.array(stop - begin), pa.array(cut, pa.binary()),
            pa.array(n[row]), pa.array(seq), pa.array(begin - seq * length), pa.array(used),
            pa.array(np.where(used & (used - 1) == 0, used, length)),
        ], names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens"])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                yield pieces(batch.slice(a, 500))

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long, sequence_tokens long, padded_tokens long")


def packed_sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids)``: the padded id arrays of the packed sequences (each a bounded group of pieces)."""

    def run(batches):
        for batch in batches:
            rows = [np.frombuffer(b, "<u4") for b in batch.column(2).to_pylist()]
            ids = [np.concatenate((r, np.full(max(0, p - len(r)), pad_id, "<u4"))) for r, p in zip(rows, batch.column(1).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], names=["sequence_id", "ids"])

    one = pieces.groupBy("sequence_id").agg(F.max("padded_tokens").alias("padded"),
                                            F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = one.select("sequence_id", "padded", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    return joined.mapInArrow(run, "sequence_id long, ids array<long>")


def op6_columns(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids' bytes in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_tokens", "padded_tokens")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return op6_columns(pack(read_table(spark, sf_dir, "documents"), tokenizer or tokenizer_path(), length=2048, end_id=1))


