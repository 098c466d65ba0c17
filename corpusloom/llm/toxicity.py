"""Toxicity: a linear classifier over character n-grams, each scaled by its naive Bayes log-count ratio."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import forget_worker_caches, read_table, saved, ship
from corpusloom.llm.labelled import held_out, labelled_sample
from corpusloom.llm.segments import batches_of_text

BITS = 20  # hashed n-grams
SIZES = (3, 4, 5, 6)
FEATURES = 6000  # n-grams of the linear model
TELLING = 30.0  # chi-square that a feature needs at least
SAMPLE = 20_000  # labelled documents learned from, at most
NOTHING = 0.25  # the highest score of a model that learned nothing
ALPHA = 0.5  # added to the counts of the ratio


def ngram_ids(texts: list[str]):
    """``(text number, hashed n-gram)`` at every place of lower-cased texts, one pair of arrays for each n-gram size.

    Texts are put between spaces, so that word starts and ends count; n-grams never cross texts.
    """
    points = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le"), "<u4") for t in texts]
    n = np.fromiter(map(len, points), np.int64, len(points))
    data = np.concatenate(points) if points else np.zeros(0, np.uint32)
    white = (data < 33)
    data = np.where(white, np.uint32(32), data)
    of = np.repeat(np.arange(len(points), dtype=np.int32), n)
    acc = data * np.uint32(0x9E3779B1)
    for size in range(2, max(SIZES) + 1):
        acc = (acc[:-1] ^ (acc[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + data[size - 1 :] * np.uint32(0x9E3779B1)
        if size in SIZES:
            h = (acc ^ (acc >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
            whole = of[: len(h)] == of[size - 1 :]
            yield of[: len(h)], (h >> np.uint32(32 - BITS)).astype(np.int32), whole


def _present(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text number, feature)``: the non-negative entries of the texts' hashed n-grams in ``table``."""
    found = []
    for of, ids, whole in ngram_ids(texts):
        feature = table[ids]
        keep = whole & (feature >= 0)
        found.append(of[keep].astype(np.int64) << BITS | feature[keep])
    both = np.unique(np.concatenate(found))
    return both >> BITS, both & ((1 << BITS) - 1)


def _distinct(texts: list[str]) -> list[np.ndarray]:
    """The distinct hashed n-grams of each text."""
    parts = [[] for _ in texts]
    for of, ids, whole in ngram_ids(texts):
        of, ids = of[whole], ids[whole]
        cut = np.searchsorted(of, np.arange(len(texts) + 1))
        for part, a, z in zip(parts, cut, cut[1:]):
            part.append(ids[a:z])
    return [np.unique(np.concatenate(p)) for p in parts]


def _counts(batches):
    """Per task: in how many toxic and other texts each hashed n-gram occurs."""
    forget_worker_caches()
    total = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        texts, y = [t or "" for t in batch.column(0).to_pylist()], batch.column(1).to_numpy()
        for a, z in batches_of_text(texts, 1 << 20):
            for ids, c in zip(_distinct(texts[a:z]), y[a:z].tolist()):
                total[c, ids] += 1
    ids = np.flatnonzero(total.any(axis=0))
    yield pa.record_batch([pa.array(ids), pa.array(total[0][ids]), pa.array(total[1][ids])], names=["id", "other", "toxic"])


class ToxicityModel:
    """Intercept and a weight for each of at most ``FEATURES`` hashed n-grams (``table``: n-gram to feature, -1 none).

    Without features every text has the same score, which tells nothing about it: ``fit_toxicity`` keeps it below 0.5.
    """

    def __init__(self, table: np.ndarray, weights: np.ndarray, intercept: float):
        self.table, self.weights, self.intercept = table, weights, intercept

    def scores(self, texts: list[str]) -> np.ndarray:
        of, feature = _present(texts, self.table)
        z = self.intercept + np.bincount(of, self.weights[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_toxicity(sample: DataFrame, features: int = FEATURES, rounds: int = 300, penalty: float = 1e-3) -> ToxicityModel:
    """Learns from ``(text, y)`` rows.

    First pass: document counts of every hashed n-gram in either class, summed in Spark; the log-count ratio
    ``r`` of an n-gram compares its share among the classes.  The n-grams whose presence tells most (by the
    chi-square of its two-by-two table) become features.  Second pass: which features each sampled text has.
    Logistic regression on presence times ``r`` is then fitted on these short lists (at most the sample's rows and
    ``features`` n-grams reach the driver).
    Without rows of both classes, or where no n-gram tells enough, nothing is learned: every score is the share of
    toxic rows, but at most ``NOTHING``, so that such a model rejects nothing.
    """
    ship(sample.sparkSession)
    sample = saved(sample, "toxicity-sample")
    n = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    empty = np.full(1 << BITS, -1, np.int32)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    unlearned = ToxicityModel(empty, np.zeros(1), min(prior, float(np.log(NOTHING / (1 - NOTHING)))))
    if not n0 or not n1:
        return unlearned
    counts = sample.mapInArrow(_counts, "id long, other long, toxic long")
    counts = counts.groupBy("id").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    a0, a1, both = F.col("other").cast("double"), F.col("toxic").cast("double"), float(n0 + n1)
    apart = F.pow(a1 * (n0 - a0) - a0 * (n1 - a1), F.lit(2.0)) * both
    chi = apart / F.greatest(float(n0 * n1) * (a0 + a1) * (both - a0 - a1), F.lit(1e-9))
    top = counts.select("id", "other", "toxic", chi.alias("chi")).where(F.col("chi") > TELLING)
    top = top.orderBy(F.desc("chi"), "id").limit(features).collect()
    if not top:
        return unlearned
    ids, a0, a1 = (np.array([row[k] for row in top]) for k in ("id", "other", "toxic"))
    r = np.log((a1 + ALPHA) / (n1 + 2 * ALPHA)) - np.log((a0 + ALPHA) / (n0 + 2 * ALPHA))
    table = empty.copy()
    table[ids] = np.arange(len(top))

    def lists(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in batches_of_text(texts, 1 << 20):
                of, feature = _present(texts[a:z], table)
                cut = np.searchsorted(of, np.arange(z - a + 1))
                yield pa.record_batch([pa.array([feature[b:e].astype("<u2").tobytes() for b, e in zip(cut, cut[1:])], pa.binary()),
                                       batch.column(1).slice(a, z - a)], names=["features", "y"])

    got = sample.mapInArrow(lists, "features binary, y int").collect()
    x = [np.frombuffer(row.features, "<u2") for row in got]
    y = np.array([row.y for row in got], float)
    of = np.repeat(np.arange(len(x)), [len(v) for v in x])
    feature = np.concatenate(x).astype(np.int64)
    w, b = np.zeros(len(top)), prior
    # steps scaled per weight (AdaGrad); the classes weigh the same in total
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    seen_w, seen_b = np.full(len(top), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(of, (w * r)[feature], minlength=len(y))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(y)
        g = r * np.bincount(feature, error[of], minlength=len(top)) + penalty * w
        seen_w += g * g
        seen_b += error.sum() ** 2
        w -= 0.1 * g / np.sqrt(seen_w)
        b -= 0.1 * error.sum() / np.sqrt(seen_b)
    return ToxicityModel(table, w * r, float(b))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)``: one row per document, null text as empty; empty texts have a score too."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS small integers and FEATURES weights

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in batches_of_text(texts, 1 << 20):
                yield pa.record_batch([batch.column(0).slice(a, z - a), pa.array(shared.value.scores(texts[a:z]))],
                                      names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, score double")


def filter_by(docs: DataFrame, model, keep, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose scores ``keep`` (a function of an array) accepts."""
    ship(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for a, z in batches_of_text(texts, 1 << 20):
                some = texts[a:z]
                yield batch.slice(a, z - a).filter(pa.array(keep(shared.value.scores(some))))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.5,
             learn_from: DataFrame | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Learns from at most ``sample`` labelled rows of ``learn_from`` (``docs`` itself unless given) that are not held
    out.  Only texts enter a score.  Null and empty texts are scored as empty; ids are passed on, null and repeated
    ones too; other columns are ignored; an empty table gives no rows.  Where nothing could be learned all scores lie
    below 0.5 (see ``fit_toxicity``).
    """
    model = fit_toxicity(labelled_sample(learn_from if learn_from is not None else docs, labels, "toxic", sample))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
