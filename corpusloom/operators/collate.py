"""Batch collation (B9-B12) as windows over a batch id.

A batch is the set of rows sharing ``batch_id``; ``pos`` orders rows inside
it.  Every window here is partitioned by the batch id, whose size is the
batch size (tens of rows), so the sort inside the window is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import constants as K


def collate_pad(df: DataFrame, pad_id: int, batch_col: str = "batch_id", max_length: int | None = None) -> DataFrame:
    """B9 (+ B10 cut): pad ids with ``pad_id`` and labels with -100 to the batch maximum; mask = ids != pad."""
    w = Window.partitionBy(batch_col)
    out = df.withColumn("_mx", F.max(F.size("input_ids")).over(w))
    out = out.withColumn(
        "input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("_mx") - F.size("input_ids")))
    ).withColumn(
        "labels", F.concat("labels", F.array_repeat(F.lit(K.IGNORE_INDEX), F.col("_mx") - F.size("labels")))
    )
    if max_length is not None:
        out = out.withColumn("input_ids", F.slice("input_ids", 1, max_length)).withColumn(
            "labels", F.slice("labels", 1, max_length))
    out = out.withColumn("attention_mask", F.transform("input_ids", lambda x: x != F.lit(pad_id)))
    return out.drop("_mx")


def collate_fault_tolerant(df: DataFrame, keys: list[str], batch_col: str = "batch_id", pos_col: str = "pos") -> DataFrame:
    """When any key is ragged inside a batch, every key takes the batch's first row value."""
    w = Window.partitionBy(batch_col)
    first = Window.partitionBy(batch_col).orderBy(pos_col).rowsBetween(Window.unboundedPreceding,
                                                                        Window.unboundedFollowing)
    ragged = None
    for k in keys:
        r = F.min(F.size(k)).over(w) != F.max(F.size(k)).over(w)
        ragged = r if ragged is None else (ragged | r)
    out = df.withColumn("ragged", ragged)
    for k in keys:
        out = out.withColumn(k, F.when(F.col("ragged"), F.first(k).over(first)).otherwise(F.col(k)))
    return out


def collate_features(df: DataFrame, batch_col: str = "batch_id", pos_col: str = "pos") -> DataFrame:
    """B11 over whole feature rows -> (batch, pos, labels if any, the numeric and array features, ragged).

    ``label`` or ``label_ids`` becomes ``labels`` and keeps every row's own value.  String features are
    dropped; a feature that is null in a batch's first row is null in that batch.  Where an array feature
    has several lengths in a batch (or a later row lacks it), every feature takes the first row's value.
    """
    from pyspark.sql import types as T

    label = next((c for c in ("label", "label_ids") if c in df.columns), None)
    keys = [f for f in df.schema.fields
            if f.name not in (batch_col, pos_col, label) and not isinstance(f.dataType, T.StringType)]
    w = Window.partitionBy(batch_col)
    first = w.orderBy(pos_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ragged = F.lit(False)
    for f in keys:
        head = F.first(f.name).over(first)
        odd = F.max(F.col(f.name).isNull()).over(w)
        if isinstance(f.dataType, T.ArrayType):
            odd = odd | (F.min(F.size(f.name)).over(w) != F.max(F.size(f.name)).over(w))
        ragged = ragged | (head.isNotNull() & odd)
    out = df.withColumn("ragged", ragged)
    cols = [F.when(F.col("ragged") | F.first(f.name).over(first).isNull(), F.first(f.name).over(first))
            .otherwise(F.col(f.name)).alias(f.name) for f in keys]
    labels = [F.col(label).alias("labels")] if label else []
    return out.select(batch_col, pos_col, *labels, *cols, "ragged")


def collate_images(df: DataFrame, crop: int = K.IMAGE_RESIZE_SIDE, batch_col: str = "batch_id") -> DataFrame:
    """Absent image -> blank crop-size image; ``stackable`` when all shapes in the batch agree."""
    out = df.withColumn("is_blank", F.col("h").isNull()).withColumn(
        "img_h", F.coalesce("h", F.lit(crop))).withColumn("img_w", F.coalesce("w", F.lit(crop)))
    w = Window.partitionBy(batch_col)
    shape = F.struct("img_h", "img_w")
    return out.withColumn("stackable", F.min(shape).over(w) == F.max(shape).over(w))
