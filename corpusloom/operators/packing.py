"""Block packing (pretraining) and train/validation split.

Packing rule being reproduced: rows are taken in order in batches of
``batch_rows``; inside a batch all token lists are concatenated and cut into
``block_size`` pieces; the short tail is dropped when the batch holds at least
one full block, otherwise the batch yields its one short block.  Labels are a
copy of the ids.

Plan: contiguous row index -> batch id -> running token offset per batch (a
window bounded by ``batch_rows`` rows) -> each row explodes only into the
blocks it overlaps, carrying its slice -> group by (batch, block) and
concatenate slices in row order.  No per-token explode, no global window; the
(batch, block) aggregate reuses the batch hash partitioning of the window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import checkpoint_root

from corpusloom.operators.index import bottom_k_flag, contiguous_index, md5_hash32, nested_index

DEFAULT_BATCH_ROWS = 1000  # rows per batched map call


def clamp_block_size(block_size: int, model_max_length: int) -> int:
    """``min(block_size, model_max_length)`` (the reference warns and clamps)."""
    if block_size > model_max_length:
        import warnings

        warnings.warn(f"block_size {block_size} > model_max_length {model_max_length}; using the latter")
    return min(block_size, model_max_length)


def _batched_offsets(rows: DataFrame, order_cols: list[str], ids_col: str, block_size: int,
                     batch_rows: int, dense_inner: bool = False, length=None,
                     per_group: str | None = None) -> tuple[DataFrame, list[str]]:
    """-> (rows with batch keys and token offsets, the batch key columns)."""
    if per_group is not None:
        # batches never cross ``per_group`` (one input file at a time): the position inside the group
        # is ``order_cols[1]``, dense 0..n-1
        indexed = rows.withColumn("_idx", F.col(order_cols[1]).cast("bigint"))
        keys = [per_group, "batch_id"]
    elif dense_inner:
        # (outer key, dense position) order: only the per-key counts are indexed
        indexed = nested_index(rows, order_cols[0], order_cols[1], "_idx")
        keys = ["batch_id"]
    else:
        indexed = contiguous_index(rows, order_cols, "_idx")
        keys = ["batch_id"]
    r = indexed.withColumn("batch_id", F.floor(F.col("_idx") / F.lit(batch_rows)).cast("bigint")).withColumn(
        "_len", (F.size(ids_col) if length is None else length).cast("bigint")
    )
    in_batch = Window.partitionBy(*keys)
    upto = in_batch.orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    r = (
        r.withColumn("_end", F.sum("_len").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_len"))
        .withColumn("_total", F.sum("_len").over(in_batch))
    )
    b = F.lit(block_size)
    keep = F.when(F.col("_total") >= b, F.floor(F.col("_total") / b) * b).otherwise(F.col("_total"))
    return r.withColumn("_keep", keep.cast("bigint")), keys


def pack_blocks(rows: DataFrame, order_cols: list[str], block_size: int, ids_col: str = "input_ids",
                batch_rows: int = DEFAULT_BATCH_ROWS, dense_inner: bool = False, length=None,
                encode=None, per_group: str | None = None) -> DataFrame:
    """-> ([per_group,] batch_id, block_no, input_ids, attention_mask, labels).

    ``dense_inner``: the order is (key, position) with positions 0..n-1 per key
    (lines of a document), which allows the cheaper nested index.
    ``per_group``: pack each group (e.g. input file) on its own, batches of
    ``batch_rows`` consecutive rows inside the group, as the reference packs one
    file at a time; ``order_cols`` is then (group, dense position).
    ``length`` + ``encode``: rows carry text, ``length`` is its token count as
    an expression and ``encode`` (DataFrame -> DataFrame adding ``ids_col``)
    runs after the batch shuffle, so the shuffle moves text, not id arrays.
    """
    r, keys = _batched_offsets(rows, order_cols, ids_col, block_size, batch_rows, dense_inner, length, per_group)
    b = F.lit(block_size)
    # rows of zero tokens and rows entirely in the dropped tail yield nothing
    r = r.filter((F.col("_len") > 0) & (F.col("_start") < F.col("_keep")))
    if encode is not None:
        r = encode(r)
    last = F.least(F.col("_end"), F.col("_keep"))
    r = r.withColumn("block_no", F.explode(F.sequence(F.floor(F.col("_start") / b), F.floor((last - 1) / b))))
    lo = F.greatest(F.col("_start"), F.col("block_no") * b)
    hi = F.least(last, (F.col("block_no") + 1) * b)
    r = r.select(*keys, "block_no", "_idx",
                 F.slice(ids_col, (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias("_piece"))
    blocks = r.groupBy(*keys, "block_no").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_idx", "_piece"))), lambda x: x["_piece"]))
        .alias("input_ids")
    )
    return blocks.select(
        *keys,
        F.col("block_no").cast("bigint").alias("block_no"),
        "input_ids",
        F.transform("input_ids", lambda x: F.lit(1)).alias("attention_mask"),
        F.col("input_ids").alias("labels"),
    )


def pack_stats(rows: DataFrame, order_cols: list[str], block_size: int, ids_col: str = "input_ids",
               batch_rows: int = DEFAULT_BATCH_ROWS, dense_inner: bool = False, length=None,
               per_group: str | None = None) -> DataFrame:
    """Per batch: rows, tokens, blocks kept and tokens dropped."""
    r, keys = _batched_offsets(rows, order_cols, ids_col, block_size, batch_rows, dense_inner, length, per_group)
    return r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("_len").cast("bigint").alias("n_tokens"),
        F.first("_keep").alias("_keep"),
    ).select(
        *keys,
        "n_rows",
        "n_tokens",
        F.ceil(F.col("_keep") / F.lit(block_size)).cast("bigint").alias("n_blocks"),
        (F.col("n_tokens") - F.col("_keep")).cast("bigint").alias("n_dropped"),
    )


def split_by_hash(df: DataFrame, key_col: str, test_size: float = 0.05, flag_col: str = "split") -> DataFrame:
    """Deterministic split: eval when md5-hash32 mod 10000 < test_size * 10000."""
    h = md5_hash32(F.col(key_col))
    return df.withColumn(
        flag_col,
        F.when(F.pmod(h, F.lit(10000)) < F.lit(int(round(test_size * 10000))), F.lit("eval")).otherwise(F.lit("train")),
    )


def split_exact(df: DataFrame, key_col: str, test_size: float = 0.05, flag_col: str = "split") -> DataFrame:
    """Exact-count split: ceil(test_size * n) rows with the smallest (hash, key) are eval."""
    # several passes follow (count, two histograms, ties, flag): materialize the input once
    checkpoint_root(df.sparkSession)
    hashed = df.withColumn("_h", md5_hash32(F.col(key_col))).checkpoint(eager=True)
    n = hashed.count()
    k = int(math.ceil(test_size * n))
    flagged = bottom_k_flag(hashed, "_h", key_col, k, "_is_eval")
    return flagged.withColumn(flag_col, F.when(F.col("_is_eval"), "eval").otherwise("train")).drop("_h", "_is_eval")
