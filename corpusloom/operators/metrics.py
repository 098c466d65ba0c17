"""Evaluation metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K


def argmax(scores: Column) -> Column:
    """M1: index of the first largest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")


def token_accuracy(df: DataFrame, preds: str, labels: str, weight: str | None = None, normalize: bool = True,
                   ignore_index: int | None = None) -> DataFrame:
    """M2: predictions[:, :-1] vs labels[:, 1:]; rate (normalize) or count; optional weights / ignore."""
    n = F.size(labels)
    pairs = F.arrays_zip(F.slice(preds, 1, F.greatest(n - 1, F.lit(0))).alias("p"),
                         F.slice(labels, 2, F.greatest(n - 1, F.lit(0))).alias("l"))
    if ignore_index is not None:
        pairs = F.filter(pairs, lambda z: z["l"] != F.lit(ignore_index))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    per_row = df.select(
        (F.aggregate(pairs, F.lit(0.0), lambda a, z: a + F.when(z["p"] == z["l"], 1.0).otherwise(0.0)) * w).alias("_hit"),
        (F.size(pairs).cast("double") * w).alias("_n"))
    agg = per_row.agg(F.sum("_hit").alias("hits"), F.sum("_n").alias("n"))
    value = (F.col("hits") / F.col("n")) if normalize else F.col("hits")
    return agg.select(value.alias("accuracy"), F.col("n").alias("n_positions"))


def log_softmax_nll(scores: Column, label: Column) -> Column:
    """-log softmax(scores)[label] via log-sum-exp with the max subtracted."""
    s = F.transform(scores, lambda x: x.cast("double"))
    m = F.array_max(s)
    lse = m + F.log(F.aggregate(s, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
    return lse - F.element_at(s, (label + 1).cast("int"))


def masked_loss(df: DataFrame, scores: str, label: str) -> DataFrame:
    """M3: mean NLL over rows with label != -100; null (with a zero count) when none is supervised."""
    valid = F.col(label) != F.lit(K.IGNORE_INDEX)
    nll = F.when(valid, log_softmax_nll(F.col(scores), F.col(label)))
    return df.agg(F.avg(nll).alias("loss"), F.count(nll).cast("bigint").alias("n_tokens"))


def shifted_loss(rows: DataFrame, seq: str, pos: str, scores: str, label: str, mask: str) -> DataFrame:
    """M3 on token rows: the scores at a position are held against the next position's label, where the next
    position's attention mask is not zero and its label is supervised -> (loss, n_tokens).

    One row per token; the next row's label comes by an equi-join on (sequence, position), so no
    sequence is gathered.
    """
    ahead = rows.select(F.col(seq), (F.col(pos) - 1).alias(pos), F.col(label).alias("_label"), F.col(mask).alias("_mask"))
    pairs = rows.select(seq, pos, scores).join(ahead, [seq, pos]).filter(F.col("_mask") != 0)
    return masked_loss(pairs, scores, "_label")


def perplexity(loss: Column) -> Column:
    """M4: exp(loss); overflow gives +inf like math.exp's OverflowError branch."""
    return F.exp(loss)


def metric_rows(pairs: list[tuple[str, str, Column]], base: DataFrame) -> DataFrame:
    """(split, metric, value) rows from scalar columns of a one-row frame."""
    cols = [F.struct(F.lit(s).alias("split"), F.lit(m).alias("metric"), v.cast("double").alias("value"))
            for s, m, v in pairs]
    return base.select(F.explode(F.array(*cols)).alias("r")).select("r.*")
