"""Quality classifier: a generalised additive model with pairwise interactions.  Boosting goes round the features and
fits one shallow tree on one feature at a time; the trees of a feature add up to a lookup table over its bins."""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, ship, utf8
from corpusloom.llm.labelled import held_out, labelled_sample
from corpusloom.llm.segments import batches_of_text

SAMPLE = 20_000  # labelled documents learned from, at most
BINS = 32
FEATURES = ("log_words", "word_bytes", "upper", "exclamations", "symbols", "pipes", "digits", "stops", "distinct_words",
            "same_as_before", "distinct_pairs", "distinct_lines", "words_per_line")
_KIND = np.zeros(256, np.uint8)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"#*$%&<>", b"|", b"0123456789", b".,;:?"), 1):
    _KIND[list(_chars)] = _i


def text_features(text: bytes) -> list[float]:
    """The features of one UTF-8 text; every one is finite, also for an empty text."""
    data = np.frombuffer(text, np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7)
    # upper-case letters of the Latin-1 block are C3 80 to C3 9E
    wide = int(((data[:-1] == 0xC3) & (data[1:] <= 0x9E)).sum()) if len(data) else 0
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    per = max(n, 1)
    size = sum(map(len, words))
    return [
        float(np.log1p(n)), size / per, (int(kinds[1]) + wide) / max(size, 1), kinds[2] / per, kinds[3] / per, kinds[4] / per,
        kinds[5] / max(size, 1), kinds[6] / per, len(set(words)) / per, sum(map(eq, words, words[1:])) / per,
        len(set(zip(words, words[1:]))) / max(n - 1, 1), len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
    ]


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A tree of ``depth`` levels over ordered bins with gradient and curvature sums: its value in every bin."""
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
        cut = int(gain.argmax()) + 1
        if gain[cut - 1] > 1e-9:
            return np.concatenate((_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)))
    return np.full(len(g), -g.sum() / (h.sum() + 1.0))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a two-way table into four quadrants: its gain and its value in every cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, out = 0.0, np.zeros_like(g)
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = cg[-1, -1] - a_g - b_g - c_g, ch[-1, -1] - a_h - b_h - c_h
    gain = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h) - _gain(cg[-1, -1], ch[-1, -1])
    if gain.size and gain.max() > 0:
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        best = float(gain[i, j])
        for rows, cols, sg, sh in ((slice(0, i + 1), slice(0, j + 1), a_g, a_h), (slice(0, i + 1), slice(j + 1, None), b_g, b_h),
                                   (slice(i + 1, None), slice(0, j + 1), c_g, c_h), (slice(i + 1, None), slice(j + 1, None), d_g, d_h)):
            out[rows, cols] = -sg[i, j] / (sh[i, j] + 1.0)
    return best, out


class AdditiveModel:
    """An intercept, a table over bins for each feature, and a table over pairs of bins for each interaction."""

    def __init__(self, cuts, intercept: float, tables, pairs):
        self.cuts, self.intercept, self.tables, self.pairs = cuts, intercept, tables, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            z += table[b[:, f]]
        for (f, g), table in self.pairs.items():
            z += table[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, n_pairs: int = 6) -> AdditiveModel:
    """Cyclic boosting of the logistic loss: ``rounds`` times once round all features, then round the ``n_pairs`` pairs
    whose quadrants explain most of what is left.  Without rows of both classes nothing is learned: every score is 0.5,
    so that such a model rejects nothing."""
    n1 = float(y.sum()) if len(y) else 0.0
    intercept = float(np.log((n1 + 1) / (len(y) - n1 + 1)))
    width = x.shape[1]
    if not 0 < n1 < len(y):
        return AdditiveModel([np.zeros(0)] * width, 0.0, [np.zeros(1)] * width, {})
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(width)]
    model = AdditiveModel(cuts, intercept, [np.zeros(len(c) + 1) for c in cuts], {})
    b = model.bins(x)
    z = np.full(len(y), intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            m = len(model.tables[f])
            step = rate * _tree(np.bincount(b[:, f], g, m), np.bincount(b[:, f], h, m))
            model.tables[f] += step
            z += step[b[:, f]]

    def two_way(f, k, v):
        m, n = len(model.tables[f]), len(model.tables[k])
        return np.bincount(b[:, f] * n + b[:, k], v, m * n).reshape(m, n)

    g, h = slopes()
    found = [(_quadrants(two_way(f, k, g), two_way(f, k, h))[0], f, k) for f in range(width) for k in range(f + 1, width)]
    chosen = [(f, k) for gain, f, k in sorted(found, reverse=True)[:n_pairs] if gain > 0]
    for f, k in chosen:
        model.pairs[f, k] = np.zeros((len(model.tables[f]), len(model.tables[k])))
    for _ in range(rounds // 4):
        for f, k in chosen:
            g, h = slopes()
            step = rate * _quadrants(two_way(f, k, g), two_way(f, k, h))[1]
            model.pairs[f, k] += step
            z += step[b[:, f], b[:, k]]
    return model


def fit_quality(sample: DataFrame) -> AdditiveModel:
    """Features are computed where the texts are; the driver gets one short row of numbers per sampled document."""
    ship(sample.sparkSession)

    def run(batches):
        for batch in batches:
            x = [text_features(t) for t in utf8(batch.column(0))]
            yield pa.record_batch([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    rows = sample.mapInArrow(run, "x array<double>, y int").collect()
    return fit_additive(np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r.y for r in rows], float))


def score_quality(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)``: one row per document, null text as empty; empty texts have a score too."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few small tables

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array([text_features(t) for t in utf8(batch.column(1))])
                yield pa.record_batch([batch.column(0), pa.array(shared.value.scores(x))], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, score double")


def filter_by(docs: DataFrame, model, keep, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose scores ``keep`` (a function of an array) accepts."""
    ship(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(at))
            for a, z in batches_of_text(texts, 1 << 20):
                some = texts[a:z]
                yield batch.slice(a, z - a).filter(pa.array(keep(shared.value.scores(np.array([text_features(t) for t in some])))))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.3,
            learn_from: DataFrame | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Learns from at most ``sample`` labelled rows of ``learn_from`` (``docs`` itself unless given) that are not held
    out.  Only texts enter a score.  Null and empty texts are scored as empty; ids are passed on, null and repeated
    ones too; other columns are ignored; an empty table gives no rows.  Where nothing could be learned all scores are
    0.5 (see ``fit_additive``).
    """
    model = fit_quality(labelled_sample(learn_from if learn_from is not None else docs, labels, "quality", sample))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
