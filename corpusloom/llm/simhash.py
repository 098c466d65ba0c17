"""SimHash near-duplicate groups: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import forget_worker_caches, saved, ship, utf8
from corpusloom.llm.components import connected_components

SEED = 42
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Majority bits over the XXH64 hashes of all word shingles of a UTF-8 text; zero without words."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and only the six ASCII white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle_words, len(words)) - 1
    starts, ends = starts[: len(words) - last], ends[last:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(ones * 2 > n, bitorder="little")
    return int(major.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp)`` with the 64 fingerprint bits as a signed long; one row per input row, null text as empty."""
    ship(docs.sparkSession)

    def run(batches):
        forget_worker_caches()
        for batch in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in utf8(batch.column(1))], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fps)], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, fp long")


def _block_keys(max_bits: int, n_blocks: int):
    """One key per choice of the ``n_blocks - max_bits`` blocks that a pair within ``max_bits`` must share."""
    if n_blocks <= max_bits:
        raise ValueError("n_blocks must exceed max_bits")
    edges = [round(i * 64 / n_blocks) for i in range(n_blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n_blocks)]
    keys = []
    for number, chosen in enumerate(combinations(masks, n_blocks - max_bits)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("c"), F.col("fp").bitwiseAND(F.lit(signed)).alias("v")))
    return F.explode(F.array(*keys))


def _close(x: str, y: str, max_bits: int):
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= max_bits


def fingerprint_links(classes: DataFrame, max_bits: int = 4, n_blocks: int = 6, rounds: int = 2) -> DataFrame:
    """Links ``(a, b)`` whose components equal those of all pairs of fingerprints within ``max_bits``.

    ``classes`` has one row ``(fp, node)`` per distinct fingerprint.  Pairs within the bound share the bits of
    at least one choice of blocks.  Within a block bucket not all pairs are emitted: ``rounds`` times each row is
    held against one centre of its bucket; then only buckets that still hold several components are joined with
    themselves, on rows of different components.  No link between different components is lost.
    """
    rows = classes.select("node", "fp", _block_keys(max_bits, n_blocks).alias("k"))
    shared = rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    rows = saved(rows.join(shared, "k"), "simhash-buckets")
    links = None
    for r in range(rounds):
        centre = rows.groupBy("k").agg(
            F.min(F.struct(F.xxhash64("fp", F.lit(r)).alias("h"), "fp", "node")).alias("z"))
        centre = centre.select("k", F.col("z.fp").alias("fp2"), F.col("z.node").alias("b"))
        found = rows.join(centre, "k").where(F.col("node") != F.col("b")).where(_close("fp", "fp2", max_bits))
        found = found.select(F.col("node").alias("a"), "b").distinct()
        links = found if links is None else links.unionByName(found)
    parts = saved(connected_components(links), "simhash-parts")
    rows = rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("k").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    rows = saved(rows.join(mixed.where("lo < hi").select("k"), "k"), "simhash-mixed")
    x = rows.select("k", F.col("fp").alias("fp1"), F.col("component").alias("a"))
    y = rows.select("k", F.col("fp").alias("fp2"), F.col("component").alias("b"))
    cross = x.join(y, "k").where("a < b").where(_close("fp1", "fp2", max_bits)).select("a", "b").distinct()
    return parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(cross)


def simhash_groups(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, n_blocks: int = 6,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp, component_id)``, one row per input row; ``component_id`` is the smallest id reachable by links.

    Fingerprints link at ``max_bits`` or fewer differing bits, equal ones included.  Texts without words (empty,
    blank, null) have fingerprint zero and link like any other.  Rows repeated with the same id stay repeated.
    A row with a null id makes no link; it gets the component of the rows with its fingerprint, or null.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    Equal fingerprints are folded into one class before any join.
    """
    rows = saved(fingerprints(docs, shingle_words, id_col, text_col), "simhash-fp")
    classes = rows.where(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("node"))
    classes = saved(classes, "simhash-classes")
    parts = connected_components(fingerprint_links(classes, max_bits, n_blocks))
    classes = classes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return rows.join(classes, "fp", "left").select(id_col, "fp", "component_id")


def op1_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from corpusloom.llm.common import read_table

    out = simhash_groups(read_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are their group's smallest id (rows without an id and repeated ids stay; for one row a
    group whatever the ids, see ``one_per_group``)."""
    drop = groups.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(drop, id_col, "left_anti")


def one_per_group(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id") -> DataFrame:
    """Exactly one row of ``docs`` for each SimHash group of its rows: the smallest id, null ids last, and any one of
    the rows that repeat that id.

    Rows are grouped by a number of their own, so ids that are null or repeated link by their texts like any other.
    """
    # written once: the numbers must be the same wherever they are read
    rows = saved(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "simhash-rows")
    texts = rows.select("row", F.col("doc.text").alias("text"))
    groups = simhash_groups(texts, shingle_words, max_bits, id_col="row").select("row", "component_id")
    ids = rows.select("row", F.col("doc")[id_col].alias("id"))
    first = groups.join(ids, "row").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select("doc.*")
