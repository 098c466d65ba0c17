"""One large JSON array read by many tasks: a transducer prefix scan over the splits of its files.

Spark reads the files cut at ``}``, a one-byte separator, so they are split like lines.  Whether a byte lies inside a
string, and how deep, depends on all that comes before; so the first pass computes for every split its *effect*: what it
does to the state it may begin in (outside or inside a string) and to the depth.  Effects are composed by a prefix scan
(a few numbers a split), which tells every split the state it begins in, and the second pass cuts the records where they
lie.  Only what lies on both sides of a split border is moved and joined.

An escape never reaches over a border: a border follows a ``}``, and ``\\}`` is no JSON escape.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.joins import bounded_broadcast
from corpusloom.session import checkpoint_root

SEPARATOR = "}"


def _pieces(spark: SparkSession, path, glob: str) -> DataFrame:
    """``(path, split, text, quotes, d0, d1)``: the text before each ``}``; whether it turns inside into outside; and
    its change of depth if it begins outside (``d0``) or inside (``d1``) a string, the ``}`` left out."""
    raw = spark.read.option("lineSep", SEPARATOR).option("pathGlobFilter", glob).text(path)
    # without escapes, the text between quotes lies outside and inside strings in turn
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"', -1)

    def depth(odd: int):
        out = F.array_join(F.filter("parts", lambda _, i: i % 2 == odd), "")
        count = lambda chars: F.length(out) - F.length(F.translate(out, chars, ""))
        return (count("[{") - count("]}")).cast("int")

    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                      F.col("value").alias("text"), parts.alias("parts"))
    return rows.select("path", "split", "text", ((F.size("parts") - 1) % 2).cast("int").alias("quotes"),
                       depth(0).alias("d0"), depth(1).alias("d1"))


def _runs(batch) -> list[tuple[str, int, int, int]]:
    """``(path, split, first row, end row)`` of the runs of rows of one split."""
    paths, splits = batch.column("path"), batch.column("split").to_numpy()
    codes = paths.dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero((np.diff(splits) != 0) | (np.diff(codes) != 0)) + 1
    begin = np.concatenate(([0], edges)).tolist()
    return [(paths[a].as_py(), int(splits[a]), a, z) for a, z in zip(begin, [*begin[1:], batch.num_rows])]


def _walk(batch, a: int, z: int, state: int, depth: int):
    """State before each row (0 outside, 1 inside a string), state and depth after each row and its ``}``."""
    quotes = batch.column("quotes").to_numpy()[a:z]
    after = (state + np.cumsum(quotes)) % 2
    before = (after + quotes) % 2
    change = np.where(before == 1, batch.column("d1").to_numpy()[a:z], batch.column("d0").to_numpy()[a:z])
    return after, depth + np.cumsum(change - (after == 0))


def _effects(batches):
    """One row a split: the state it ends in and its change of depth, for either state it may begin in."""
    at, flip, change = None, 0, [0, 0]

    def row():
        return pa.record_batch([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([flip], pa.int32()),
                                pa.array([change[0]], pa.int64()), pa.array([change[1]], pa.int64())],
                               names=["path", "split", "flip", "from0", "from1"])

    for batch in batches:
        if not batch.num_rows:
            continue
        for path, split, a, z in _runs(batch):
            if at != (path, split):
                if at is not None:
                    yield row()
                at, flip, change = (path, split), 0, [0, 0]
            for s in (0, 1):
                after, depth = _walk(batch, a, z, (s + flip) % 2, change[s])
                change[s] = int(depth[-1])
            flip = int((after[-1] + 1) % 2)  # of s = 1
    if at is not None:
        yield row()


def _cut(batches):
    """The records of each split: ``whole`` ones, the ``end`` of one begun earlier, the ``begin`` of one ended later,
    or the ``middle`` of one."""
    at, depth, state, inside, n, text = None, 0, 0, False, 0, []

    def rows(out):
        cols = list(zip(*out)) or [()] * 5
        return pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
                               names=["path", "split", "n", "part", "json"])

    def rest():
        """What is left at the end of a split: the beginning or the middle of a record, if it ends within one."""
        joined = SEPARATOR.join([*text, ""])
        if depth < 2 and not state:
            return []
        if not inside:
            joined = joined[joined.index("{"):]
        return [(*at, n, "middle" if inside else "begin", joined)]

    for batch in batches:
        if not batch.num_rows:
            continue
        out = []
        for path, split, a, z in _runs(batch):
            if at != (path, split):
                if at is not None:
                    out += rest()
                at, n, text = (path, split), 0, []
                state, depth = batch.column("state")[a].as_py(), batch.column("depth")[a].as_py()
                inside = depth >= 2  # the split begins within a record
            after, depths = _walk(batch, a, z, state, depth)
            values = batch.column("text").slice(a, z - a).to_pylist()
            begin = 0
            # a } outside strings that leads back to the array's own depth ends a record
            for e in np.flatnonzero((after == 0) & (depths == 1)).tolist():
                joined = SEPARATOR.join([*text, *values[begin : e + 1], ""])
                if not inside:
                    joined = joined[joined.index("{"):]
                out.append((*at, n, "end" if inside else "whole", joined))
                text, begin, inside, n = [], e + 1, False, n + 1
            text += values[begin:]
            state, depth = int(after[-1]), int(depths[-1])
        yield rows(out)
    if at is not None:
        yield rows(rest())


def read_json_array(spark: SparkSession, path, glob: str = "*.json") -> DataFrame:
    """``(path, split, n, json)``: the objects of the files at ``path``, each file one JSON array of objects; ``split``
    and ``n`` give their order in a file.

    A file is read by as many tasks as it has splits; a task holds a batch of rows and one record.  Empty arrays and
    empty files give no rows.  A file that does not end where its array ends raises.
    """
    checkpoint_root(spark)
    pieces = _pieces(spark, path, glob)
    effects = pieces.drop("text").mapInArrow(_effects, "path string, split long, flip int, from0 long, from1 long")
    effects = effects.checkpoint(eager=True)  # one row a split
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    known = effects.withColumn("state", (F.coalesce(F.sum("flip").over(earlier), F.lit(0)) % 2).cast("int"))
    known = known.withColumn("change", F.when(F.col("state") == 0, F.col("from0")).otherwise(F.col("from1")))
    starts = known.withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    # the last piece of a file has no }, but was given one
    ends = starts.groupBy("path").agg(F.sum("change").alias("depth"), (F.sum("flip") % 2).alias("state"))
    broken = ends.where("depth <> -1 OR state <> 0").limit(3).collect()
    if broken:
        raise ValueError(f"no whole JSON array of objects: {sorted(r.path for r in broken)}")
    placed = pieces.join(bounded_broadcast(starts.select("path", "split", "state", "depth")), ["path", "split"])
    cut = placed.mapInArrow(_cut, "path string, split long, n long, part string, json string").checkpoint(eager=True)
    # the parts of a record that lies in several splits meet under the place where it begins
    broken_up = cut.where("part <> 'whole'")
    keys = broken_up.select("path", "split", "n", "part")
    order = Window.partitionBy("path").orderBy("split", "n").rowsBetween(Window.unboundedPreceding, 0)
    of = F.last(F.when(F.col("part") == "begin", F.struct(F.col("split").alias("s"), F.col("n").alias("k"))), ignorenulls=True)
    keys = keys.withColumn("of", of.over(order)).select("path", "split", "n", F.col("of.s").alias("s"), F.col("of.k").alias("k"))
    parts = broken_up.join(keys, ["path", "split", "n"])
    joined = parts.groupBy("path", "s", "k").agg(F.array_sort(F.collect_list(F.struct("split", "json"))).alias("p"))
    joined = joined.select("path", F.col("s").alias("split"), F.col("k").alias("n"), F.array_join(F.col("p.json"), "").alias("json"))
    return cut.where("part = 'whole'").drop("part").unionByName(joined)
