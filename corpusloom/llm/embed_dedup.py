"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one representative per group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, saved, ship
from corpusloom.llm.components import connected_components

BLOCK_BYTES = 1 << 23  # of vectors in a block
STRIP = 256  # rows of a block multiplied at a time


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, unit)``: the unit vector in double precision, or null where the id or the vector is null or the
    vector is empty, zero or holds a null, a NaN or an infinity."""
    ship(vectors.sparkSession)

    def unit(values):
        if not values or None in values:
            return None
        x = np.array(values, float)
        top = np.abs(x).max()
        if not (0 < top < np.inf):
            return None
        x /= top  # so that squares neither overflow nor vanish
        return x / np.sqrt(x @ x)

    def run(batches):
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            units = [None if i is None else unit(v) for i, v in zip(ids, rows)]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(units, pa.list_(pa.float64()))],
                                  names=["id", "unit"])

    rows = vectors.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
    return rows.mapInArrow(run, "id long, unit array<double>")


def fit_cells(vectors: DataFrame, n_cells: int, sample: int, rounds: int, seed: int = 7) -> np.ndarray:
    """Centroids of spherical k-means, fitted on the ``sample`` vectors with the smallest hash (a bounded sample;
    only the fit uses it, every vector is put into cells)."""
    rows = vectors.select("unit", F.xxhash64("node", F.lit(seed)).alias("h")).orderBy("h", "unit").limit(sample)
    x = np.array([r.unit for r in rows.select("unit").collect()], float)
    k = min(n_cells, len(x))
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def whole_margin(threshold: float) -> float:
    """The distance to a border at which no link is lost.

    The straight line between two vectors crosses the border between their homes, so their distances to it add up to
    at most ``sqrt(2 - 2 * threshold)`` and one of them is at most half of that (and a bit, for rounding).
    """
    return float(np.sqrt(max(0.0, 1 - threshold) / 2)) + 1e-6


def block_rows(dim: int) -> int:
    """Rows of a block: at most BLOCK_BYTES of vectors."""
    return max(256, min(16384, BLOCK_BYTES // (8 * dim)))


def _cells(vectors: DataFrame, centroids: np.ndarray, margin: float) -> DataFrame:
    """Each vector with its home cell and ``probes``: home and every other cell whose border lies within ``margin``."""
    # centroids nearly the same count as 1e-4 apart, which makes distances smaller, not larger
    gaps = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 1e-8))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(2).to_pylist(), float)
            score = x @ centroids.T
            home = score.argmax(axis=1)
            best = score[np.arange(len(x)), home]
            near = (best[:, None] - score) / gaps[home] <= margin
            near[np.arange(len(x)), home] = True
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array(home.astype(np.int32)),
                pa.array([np.flatnonzero(n).tolist() for n in near], pa.list_(pa.int32())),
                pa.array([v.tobytes() for v in x], pa.binary()),
            ], names=["node", "weight", "home", "probes", "vec"])

    return vectors.select("node", "weight", "unit").mapInArrow(
        run, "node long, weight long, home int, probes array<int>, vec binary")


def _blocks(cells: DataFrame, rows: int) -> DataFrame:
    """The rows of every pair of blocks ``(cell, i, j)`` to compare: blocks of home vectors with each other and with
    those of the cell's visitors.  Visitors are not compared among themselves: each pair meets in one of its homes."""
    at = cells.withColumn("cell", F.explode("probes")).withColumn("visits", F.col("cell") != F.col("home"))
    n = lambda visits: F.ceil(F.sum((F.col("visits") == visits).cast("long")) / F.lit(rows)).cast("int")
    # a row for each cell
    sizes = at.groupBy("cell").agg(n(False).alias("homes"), n(True).alias("visitors")).where("homes > 0")
    at = at.join(F.broadcast(sizes), "cell")
    part = F.xxhash64("node")
    at = at.withColumn("block", F.when(F.col("visits"), F.col("homes") + F.pmod(part, F.col("visitors")))
                       .otherwise(F.pmod(part, F.col("homes"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("homes") + F.when(F.col("visits"), 0).otherwise(F.col("visitors")) - 1)
    at = at.withColumn("other", F.explode(others))
    # only a home vector's probes are asked for
    return at.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                     "node", "weight", "home", F.when(~F.col("visits"), F.col("probes")).alias("probes"), "vec")


def _join(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Join the groups of places ``p`` and ``q`` in ``label`` (each place's smallest place of its group), in place."""
    while True:
        p, q = label[p], label[q]
        apart = p != q
        if not apart.any():
            return
        p, q = np.minimum(p[apart], q[apart]), np.maximum(p[apart], q[apart])
        np.minimum.at(label, q, p)
        while (label != label[label]).any():
            label[:] = label[label]


def _products(threshold: float, n_cells: int):
    """For one pair of blocks of a cell: links per vector and the links that join its groups."""

    def side(table):
        x = np.frombuffer(b"".join(table["vec"].to_pylist()), np.float64).reshape(table.num_rows, -1)
        return x, table["node"].to_numpy(), table["weight"].to_numpy(), table["home"].to_numpy(), table["probes"].to_pylist()

    def run(key, table):
        cell, i, j = (k.as_py() for k in key)
        left = side(table.filter(pa.compute.equal(table["block"], i)))
        right = left if i == j else side(table.filter(pa.compute.equal(table["block"], j)))
        n, m = len(left[0]), len(right[0])
        links = np.zeros(n, np.int64), np.zeros(m, np.int64)
        shift = 0 if i == j else n
        label = np.arange(m + shift)
        away = bool(n and m) and right[3][0] != cell  # the right block's vectors are visitors
        # a pair may meet in both its homes: the lower one counts it
        if away:
            probes = np.zeros((n, n_cells), bool)
            for r, cells in enumerate(left[4]):
                probes[r, cells] = True
        for r in range(0, n if m else 0, STRIP):
            c = r if i == j else 0
            a, b = np.nonzero(left[0][r : r + STRIP] @ right[0][c:].T >= threshold)
            a, b = a + r, b + c
            if i == j:
                a, b = a[a < b], b[a < b]
            if away:
                ok = ~(probes[a, right[3][b]] & (right[3][b] < cell))
                a, b = a[ok], b[ok]
            np.add.at(links[0], a, right[2][b])
            np.add.at(links[1], b, left[2][a])
            _join(label, a, b + shift)
        nodes = left[1] if i == j else np.concatenate((left[1], right[1]))
        total = links[0] + links[1] if i == j else np.concatenate(links)
        some, far = np.flatnonzero(total), np.flatnonzero(label != np.arange(len(label)))
        return pa.table({
            "node": pa.array(np.concatenate((nodes[some], nodes[far])), pa.int64()),
            "links": pa.array(total[some].tolist() + [None] * len(far), pa.int64()),
            "other": pa.array([None] * len(some) + nodes[label[far]].tolist(), pa.int64()),
        })

    return run


def embedding_groups(vectors: DataFrame, threshold: float = 0.95, margin: float | None = None, max_cells: int = 2048,
                     sample: int = 16384, rounds: int = 8, id_col: str = "vec_id",
                     vec_col: str = "embedding") -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per input row.

    Spherical k-means (fitted on at most ``sample`` vectors, about a cell for each block of distinct vectors,
    ``max_cells`` at most) gives each vector a home cell; a vector also visits the cells whose border is within
    ``margin``.  Within cells all home vectors are compared with each other and with the visitors, block by block, by
    exact cosine in double precision.  No link is lost: ``margin`` is what ``whole_margin`` derives from the
    threshold, and a larger one only compares more (1.0: everything); a smaller one is raised to it.
    Equal vectors are folded into one weighted row first.  ``n_links`` counts other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` marks the row with that id.

    Vectors that are null, empty, zero or hold null, NaN or infinite components link with nothing, and vectors of
    different lengths never link.  Rows with a null id make no links and have null component and kept false.
    Rows repeated with the same id are one vector when equal (a null-safe choice: they do not link to themselves).
    An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = saved(unit_vectors(vectors, id_col, vec_col), "embed-rows")
    classes = rows.where("unit is not null").groupBy("unit").agg(
        F.min("id").alias("node"), F.count_distinct("id").alias("weight"))
    classes = saved(classes, "embed-classes")
    found = None
    for (dim,) in [tuple(r) for r in classes.groupBy(F.size("unit").alias("d")).count().select("d").collect()]:
        part = classes.where(F.size("unit") == dim)
        n_cells = max(1, min(max_cells, round(part.count() / block_rows(dim))))
        centroids = fit_cells(part, n_cells, sample, rounds)
        cells = saved(_cells(part, centroids, max(margin or 0.0, whole_margin(threshold))), "embed-cells")
        got = _blocks(cells, block_rows(dim)).groupBy("cell", "i", "j").applyInArrow(
            _products(threshold, len(centroids)), "node long, links long, other long")
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, other long")
    found = saved(found, "embed-links")
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("other is not null"), "node", "other")
    classes = classes.join(counts, "node", "left").join(parts, "node", "left").select(
        "unit", F.coalesce("component", "node").alias("component"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.join(classes, "unit", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op2_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_groups(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
                       AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                      THEN embedding::DOUBLE[] END AS e
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id,
       (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links,
       least(v.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = v.vec_id), v.vec_id)) AS component_id,
       least(v.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = v.vec_id), v.vec_id)) = v.vec_id AS kept
FROM v
"""
