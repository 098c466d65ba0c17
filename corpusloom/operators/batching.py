"""Length-grouped sampling.

Sampler rule being reproduced: a permutation of the samples is cut into
megabatches of ``world_size * batch_size``; each megabatch is sorted by length
(descending) and split into ``world_size`` chunks: strided when the size is
not divisible, else greedily into the currently shortest non-full chunk.
With two modalities this runs per modality; the last megabatch of each goes
into one final batch sorted by index, the rest are shuffled.

The random permutation is replaced by a seeded one that is arithmetic on a
row's index (``permute``, Q11), so no hash is sorted.  Indexes come from the
contiguous index (no global window); every window is bounded by one megabatch;
the even split streams whole megabatches through a heap of chunks with room.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import constants as K
from corpusloom.functions.text import word_count
from corpusloom.operators import permute
from corpusloom.operators.index import contiguous_index
from corpusloom.operators.joins import bounded_broadcast
from corpusloom.session import checkpoint_root


def dialogue_lengths(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """B1 + B2 + B3: word count over all messages, image surcharge, signed modality length, zero flag."""
    words = F.aggregate(F.transform("msgs", lambda m: word_count(m["value"])), F.lit(0).cast("bigint"),
                        lambda a, x: a + x)
    has_img = F.col("image").isNotNull()
    return records.select(
        key,
        has_img.alias("has_image"),
        (words + F.when(has_img, F.lit(K.IMAGE_LENGTH_SURCHARGE)).otherwise(F.lit(0))).cast("bigint").alias("length"),
        F.when(has_img, words).otherwise(-words).cast("bigint").alias("modality_length"),
        (words == 0).alias("zero_length"),
    )


def lengths_from_words(words: DataFrame, key: str = "conv_id") -> DataFrame:
    """B1-B3 from per-conversation word counts (key, has_image, words)."""
    w, has_img = F.col("words"), F.col("has_image")
    return words.select(
        key, has_img,
        (w + F.when(has_img, F.lit(K.IMAGE_LENGTH_SURCHARGE)).otherwise(F.lit(0))).cast("bigint").alias("length"),
        F.when(has_img, w).otherwise(-w).cast("bigint").alias("modality_length"),
        (w == 0).alias("zero_length"),
    )


def _permuted(rows: DataFrame, key: str, out: str, seed: int, group_col: str | None = None) -> DataFrame:
    """Add ``out``: the row's place in a seeded permutation of all rows (of its group).

    Rows are indexed in key order; the place is arithmetic on index and count, one row of counts per group.
    """
    groups = [group_col] if group_col else ["_all"]
    rows = rows if group_col else rows.withColumn("_all", F.lit(True))
    indexed = contiguous_index(rows, [group_col, key] if group_col else [key], "_idx")
    counts = indexed.groupBy(*groups).agg(F.min("_idx").alias("_g0"), F.count(F.lit(1)).alias("_count"))
    at = indexed.join(bounded_broadcast(counts), groups)
    return permute.with_place(at, F.col("_idx") - F.col("_g0"), F.col("_count"), out, seed).drop("_idx", "_g0", "_count", "_all")


def megabatches(lengths: DataFrame, key: str, len_col: str, megabatch_size: int, seed: int = 0,
                group_col: str | None = None) -> DataFrame:
    """B4 + B5: (key, [group,] mb, rank) with rank 1.. by length desc inside the megabatch (ties by key)."""
    placed = _permuted(lengths, key, "_at", seed, group_col)
    out = placed.withColumn("mb", F.floor(F.col("_at") / F.lit(megabatch_size)).cast("bigint"))
    part = [group_col, "mb"] if group_col else ["mb"]
    w = Window.partitionBy(*part).orderBy(F.col(len_col).desc(), F.col(key))
    return out.withColumn("rank", F.row_number().over(w)).withColumn(
        "mb_size", F.count(F.lit(1)).over(Window.partitionBy(*part))).drop("_at")


def strided_chunks(mb: DataFrame, num_chunks: int) -> DataFrame:
    """B6, size not divisible: position p goes to chunk p mod n, at place p div n."""
    p = F.col("rank") - 1
    return mb.withColumn("chunk", F.pmod(p, F.lit(num_chunks)).cast("bigint")).withColumn(
        "chunk_pos", F.floor(p / F.lit(num_chunks)).cast("bigint"))


def _fill_chunks(len_col: str, num_chunks: int):
    """Arrow batches of whole megabatches in rank order -> the same rows with (chunk, chunk_pos).

    Every chunk has room for the same number of rows.  The chunks that still have room wait in a heap by (load,
    chunk); the next row goes to the first of them, which comes back with its new load unless that row filled it.
    What is kept between batches is one megabatch's heap and room.
    """

    def run(batches):
        import heapq

        import pyarrow as pa

        waiting, room, share = [], [], 0
        for batch in batches:
            chunks, places = [], []
            for nth, size, length in zip(batch["_nth"].to_pylist(), batch["mb_size"].to_pylist(), batch[len_col].to_pylist()):
                if nth == 1:  # the next megabatch
                    share = size // num_chunks
                    waiting, room = [(0, c) for c in range(num_chunks)], [share] * num_chunks
                load, c = heapq.heappop(waiting)
                chunks.append(c)
                places.append(share - room[c])
                room[c] -= 1
                if room[c]:
                    heapq.heappush(waiting, (load + (length or 0), c))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, pa.int64()), pa.array(places, pa.int64())],
                                             names=[*batch.schema.names, "chunk", "chunk_pos"])

    return run


def even_chunks(mb: DataFrame, key: str, len_col: str, num_chunks: int, group_cols: list[str] = ("mb",)) -> DataFrame:
    """Strided for sizes not divisible by ``num_chunks``; otherwise each row, in rank order, to the lightest chunk
    that has room, the first one on ties.  A row without length weighs nothing.

    The second rule is sequential inside a megabatch.  A window in rank order brings whole megabatches into one task
    (they lie there already where ranks come from ``megabatches``), and they stream through a heap: n log(chunks)
    steps, and no megabatch is gathered into one row.
    """
    divisible = F.pmod(F.col("mb_size"), F.lit(num_chunks)) == 0
    strided = strided_chunks(mb.filter(~divisible), num_chunks)
    whole = mb.filter(divisible).withColumn("_nth", F.row_number().over(Window.partitionBy(*group_cols).orderBy("rank")))
    schema = T.StructType([*whole.schema.fields, T.StructField("chunk", T.LongType()), T.StructField("chunk_pos", T.LongType())])
    return strided.unionByName(whole.mapInArrow(_fill_chunks(len_col, num_chunks), schema).drop("_nth"))


def length_grouped(lengths: DataFrame, key: str, len_col: str, batch_size: int, world_size: int, seed: int = 0,
                   group_col: str | None = None) -> DataFrame:
    """B4-B6 -> (key, [group,] mb, chunk, chunk_pos)."""
    mb = megabatches(lengths, key, len_col, batch_size * world_size, seed, group_col)
    groups = [group_col, "mb"] if group_col else ["mb"]
    return even_chunks(mb, key, len_col, world_size, groups)


def modality_batches(lengths: DataFrame, key: str, batch_size: int, world_size: int, seed: int = 0) -> DataFrame:
    """Per-modality grouping; last megabatch of each modality merged and sorted by key; others shuffled.

    -> (key, batch_no, pos): the sampler's output order is (batch_no, pos).
    """
    signed = lengths.withColumn("_mod", F.col("modality_length") > 0).withColumn("_len", F.abs("modality_length"))
    modes = signed.agg(F.countDistinct("_mod")).first()[0]
    if modes < 2:
        # one modality: raw signed lengths (Q10)
        g = length_grouped(signed.withColumn("_len", F.col("modality_length")), key, "_len", batch_size, world_size,
                           seed)
        return g.select(key, F.col("mb").alias("batch_no"),
                        (F.col("chunk") * F.lit(batch_size * world_size) + F.col("chunk_pos")).alias("_o")) \
            .withColumn("pos", F.row_number().over(Window.partitionBy("batch_no").orderBy("_o")) - 1).drop("_o")
    g = length_grouped(signed, key, "_len", batch_size, world_size, seed, group_col="_mod")
    # four branches read the grouped order (tails, body, megabatch ranks): materialize it once
    checkpoint_root(g.sparkSession)
    g = g.checkpoint(eager=True)
    last = g.groupBy("_mod").agg(F.max("mb").alias("_last"))
    # `last` has two rows, one per modality
    g = g.join(F.broadcast(last), "_mod").withColumn("_tail", F.col("mb") == F.col("_last"))
    # order inside a megabatch: chunk by chunk
    g = g.withColumn("_o", F.col("chunk") * F.lit(batch_size * world_size) + F.col("chunk_pos"))
    body = g.filter(~F.col("_tail"))
    mbs = body.select("_mod", "mb").distinct().withColumn("_batch", F.struct("_mod", "mb"))
    ranked = _permuted(mbs, "_batch", "batch_no", seed + 1)
    body = body.join(ranked.select("_mod", "mb", "batch_no"), ["_mod", "mb"]).withColumn(
        "pos", F.row_number().over(Window.partitionBy("batch_no").orderBy("_o")) - 1)
    n_body = ranked.count()
    tail = g.filter(F.col("_tail")).withColumn("batch_no", F.lit(n_body).cast("bigint")).withColumn(
        "pos", F.row_number().over(Window.partitionBy("batch_no").orderBy(key)) - 1)
    cols = [key, F.col("batch_no").cast("bigint").alias("batch_no"), F.col("pos").cast("bigint").alias("pos")]
    return body.select(*cols).unionByName(tail.select(*cols))


def sampler_order(lengths: DataFrame, key: str, batch_size: int, world_size: int, grad_accum: int = 1,
                  group_by_modality: bool = True, seed: int = 0) -> DataFrame:
    """The sampler the trainer would pick -> (key, batch_no, pos).

    The effective world size is ``world_size * grad_accum``; with modality
    grouping the B7 plan runs on the signed lengths, otherwise the default
    sampler: a random (here seeded) permutation, cut into steps of
    ``batch_size`` rows per worker.
    """
    world = world_size * grad_accum
    if group_by_modality:
        return modality_batches(lengths, key, batch_size, world, seed)
    step = F.lit(batch_size * world)
    at = _permuted(lengths.select(key), key, "_at", seed)
    return at.select(key, F.floor(F.col("_at") / step).cast("bigint").alias("batch_no"),
                     F.pmod("_at", step).cast("bigint").alias("pos"))
