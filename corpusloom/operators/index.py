"""Positions and exact ranks without a single-partition window.

``contiguous_index``: 0-based position of each row in a total order.  The data
is range-partitioned on the order key and sorted inside each partition; each
row is tagged with its partition and ``monotonically_increasing_id``; the
tagged rows are checkpointed (reliable checkpoint in ``spark.checkpoint.dir``)
so that the count branch and the row branch read the very same partitions
(two separate range exchanges would sample different bounds).  Each partition
counts its rows (one row per partition), a running sum over those few rows
gives the offsets, and they are broadcast back (size = number of partitions,
a proven bound).  No single-partition window touches the data.

``bottom_k_flag``: exact "first k rows by (hash, id)" without a global sort,
through two 16-bit histograms of a 32-bit hash (each at most 65,536 rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import checkpoint_root


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def contiguous_index(df: DataFrame, order_cols: list[str], idx_col: str = "idx",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``idx_col`` = 0-based rank of the row in ``order_cols`` order (keys unique)."""
    n = _num_partitions(df, num_partitions)
    checkpoint_root(df.sparkSession)
    tagged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    # at most `n` rows: one per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_mid0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(idx_col, (F.col("_off") + F.col("_mid") - F.col("_mid0")).cast("bigint"))
        .drop("_part", "_mid", "_mid0", "_off")
    )


def nested_index(df: DataFrame, outer_col: str, inner_col: str, idx_col: str = "idx",
                 max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """``contiguous_index`` for the order (outer, inner) when ``inner`` is dense 0..n-1 per outer key.

    Only the per-outer-key counts (one row per key, far fewer than rows) are
    indexed; each row's position is its key's offset plus ``inner``.  The
    offsets join back by broadcast when their row count is within the bound,
    else by shuffle join.
    """
    from corpusloom.operators.joins import bounded_broadcast

    counts = df.groupBy(outer_col).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = contiguous_index(counts, [outer_col], "_rank")
    # exclusive running sum of the counts in key order, without a global window
    offsets = _prefix_sum(ranked, "_rank", "_cnt", "_off").select(outer_col, "_off")
    return (
        df.join(bounded_broadcast(offsets, max_broadcast_rows), outer_col)
        .withColumn(idx_col, (F.col("_off") + F.col(inner_col)).cast("bigint"))
        .drop("_off")
    )


def _prefix_sum(df: DataFrame, pos_col: str, val_col: str, out_col: str, bucket_rows: int = 1 << 16) -> DataFrame:
    """Exclusive running sum of ``val_col`` in ``pos_col`` order (pos = 0..n-1, dense).

    Two levels: sums per bucket of ``bucket_rows`` positions (a small table,
    one row per bucket) and a running sum inside each bucket (a window
    bounded by ``bucket_rows`` rows).
    """
    b = F.floor(F.col(pos_col) / F.lit(bucket_rows))
    x = df.withColumn("_bk", b)
    per_bucket = x.groupBy("_bk").agg(F.sum(val_col).alias("_bsum"))
    before_b = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    bucket_off = per_bucket.select("_bk", F.coalesce(F.sum("_bsum").over(before_b), F.lit(0)).alias("_boff"))
    inner = Window.partitionBy("_bk").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_ioff", F.coalesce(F.sum(val_col).over(inner), F.lit(0)))
    from corpusloom.operators.joins import bounded_broadcast

    # one row per bucket of 65,536 positions: broadcast after the size check
    return x.join(bounded_broadcast(bucket_off), "_bk").withColumn(out_col, (F.col("_boff") + F.col("_ioff")).cast("bigint")) \
        .drop("_bk", "_ioff", "_boff")


def md5_hash32(c: Column) -> Column:
    """Unsigned 32-bit hash from the first 8 hex digits of md5 (same in DuckDB)."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def _boundary(hist: DataFrame, key: str, k: int):
    """(key value where the running count reaches k, count strictly before it)."""
    upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    row = (
        hist.withColumn("_cum", F.sum("_n").over(upto))
        .filter(F.col("_cum") >= F.lit(k))
        .orderBy(key)
        .select(key, (F.col("_cum") - F.col("_n")).alias("_before"))
        .first()
    )
    return row[0], row[1]


def bottom_k_flag(df: DataFrame, hash_col: str, tie_col: str, k: int, flag_col: str) -> DataFrame:
    """Flag the first ``k`` rows in (hash, tie) order; ``hash_col`` is a 32-bit value."""
    if k <= 0:
        return df.withColumn(flag_col, F.lit(False))
    hi = F.shiftright(F.col(hash_col), 16)
    hist1 = df.groupBy(hi.alias("_hi")).agg(F.count(F.lit(1)).alias("_n"))  # <= 65,536 rows
    total = hist1.agg(F.sum("_n")).first()[0] or 0
    if k >= total:
        return df.withColumn(flag_col, F.lit(True))
    hi_b, before1 = _boundary(hist1, "_hi", k)
    hist2 = (df.filter(hi == F.lit(hi_b)).groupBy(F.col(hash_col).alias("_h"))
             .agg(F.count(F.lit(1)).alias("_n")))  # <= 65,536 rows
    v, before2 = _boundary(hist2, "_h", k - before1)
    remaining = k - before1 - before2
    # rows sharing the boundary hash: only md5 collisions, a handful
    ties = (
        df.filter(F.col(hash_col) == F.lit(v))
        .select(tie_col, F.row_number().over(Window.orderBy(tie_col)).alias("_r"))
        .filter(F.col("_r") <= F.lit(remaining))
        .select(tie_col, F.lit(True).alias("_tie_in"))
    )
    from corpusloom.operators.joins import bounded_broadcast

    out = df.join(bounded_broadcast(ties), tie_col, "left")
    return out.withColumn(
        flag_col,
        (F.col(hash_col) < F.lit(v)) | ((F.col(hash_col) == F.lit(v)) & F.coalesce(F.col("_tie_in"), F.lit(False))),
    ).drop("_tie_in")
