"""Merkle manifest by a butterfly exchange.

The leaves of each tree are cut into aligned blocks, whose subtrees are hashed in tasks.  Then the blocks exchange: in
round ``r`` an aligned group of ``fanout ** (r + 1)`` blocks falls into ``fanout`` parts, and every block receives the
roots of the other parts, each from one of that part's blocks.  All blocks of the group hash the same new root,
redundantly; so after the last round each of them holds its tree's root and all siblings on its way up, without a pass
downwards.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, saved, ship
from corpusloom.operators.index import contiguous_index

FANOUT = 2
DEPTH = 12  # levels within a block: 4,096 leaves at fanout 2
WRITE_EVERY = 4  # rounds from one table in the shared folder to the next
PATH = "at array<int>, siblings array<array<string>>"


def encoded(column: str) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value (numbers in decimal)."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def numbered_in_trees(items: DataFrame, tree: str, order: list[str], span: int = 1 << 14) -> DataFrame:
    """``items`` with ``tree`` (the number of its value in ascending order, null first), ``pos`` (its place in the
    tree by ``order``, nulls first) and ``size`` (the tree's items)."""
    placed = contiguous_index(items.withColumn("value", F.col(tree)), ["value", *order], "g")
    per = placed.groupBy("value").agg(F.min("g").alias("g0"), F.count("*").alias("size"))
    per = contiguous_index(per, ["value"], "tree").withColumnRenamed("value", "of")
    # joined span by span, so that a large tree is not one join key
    last = F.col("g0") + F.col("size") - 1
    per = per.withColumn("span_of", F.explode(F.sequence(F.floor(F.col("g0") / span), F.floor(last / span))))
    placed = placed.withColumn("span", F.floor(F.col("g") / span))
    found = placed.join(per, (F.col("span") == F.col("span_of")) & F.col("value").eqNullSafe(F.col("of")))
    return found.withColumn("pos", F.col("g") - F.col("g0")).drop("g", "g0", "span", "span_of", "value", "of")


def _levels(size: int, fanout: int) -> int:
    n = 0
    while fanout ** n < size:
        n += 1
    return n


def _subtree(leaves: list[str], size: int, fanout: int, depth: int) -> list[list[str]]:
    """A block's nodes, level by level: up to its single root, also where its tree goes on above it."""
    levels = [leaves]
    for _ in range(min(depth, _levels(size, fanout))):
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest()
                       for i in range(0, len(below), fanout)])
    return levels


def block_roots(items: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """``(tree, block, blocks, node)``: the root of each aligned block of ``fanout ** depth`` items (bounded groups)."""
    many = fanout ** depth

    def root(table):
        pos, size = table["pos"].to_numpy(), table["size"][0].as_py()
        leaves = table["leaf"].take(pa.array(np.argsort(pos))).to_pylist()
        node = _subtree(leaves, size, fanout, depth)[-1][0]
        return pa.table({"tree": table["tree"][:1], "block": pa.array([int(pos.min()) // many], pa.int64()),
                         "blocks": pa.array([-(-size // many)], pa.int64()), "node": [node]})

    keyed = items.select("tree", "pos", "size", "leaf", F.floor(F.col("pos") / many).alias("block"))
    return keyed.groupBy("tree", "block").applyInArrow(root, "tree long, block long, blocks long, node string")


def exchange(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(tree, block, root, at, siblings)``: what the butterfly leaves with each block.  ``siblings`` are the other
    nodes of each run on the way up, ``at`` the place in the run."""
    state = blocks.withColumns({"at": F.lit(None).cast("array<int>"), "siblings": F.lit(None).cast("array<array<string>>")})
    state = saved(state.withColumns({"at": F.coalesce("at", F.array().cast("array<int>")),
                                     "siblings": F.coalesce("siblings", F.array().cast("array<array<string>>"))}), "merkle-blocks")
    most = state.agg(F.max("blocks")).first()[0] or 0
    for r in range(_levels(most, fanout)):
        part = fanout ** r
        run = F.floor(F.col("block") / (part * fanout)) * (part * fanout)
        start = lambda i: F.col("run") + i * part
        length = lambda i: F.least(F.lit(part), F.col("blocks") - start(i))
        active = F.col("blocks") > part
        mine = F.floor((F.col("block") - F.col("run")) / part).cast("int")
        state = state.withColumn("run", run).withColumn("part", mine)
        # the k-th block of a part sends to the k-th of every other; if that has more, every so many blocks again
        sent = state.where(active).withColumn("to_part", F.explode(F.array(*[F.lit(i) for i in range(fanout)])))
        k = F.col("block") - start(F.col("part"))
        sent = sent.where((F.col("to_part") != F.col("part")) & (k < length(F.col("to_part"))))
        sent = sent.select("tree", F.explode(F.sequence(
            start(F.col("to_part")) + k, start(F.col("to_part")) + length(F.col("to_part")) - 1, length(F.col("part")))).alias("block"),
            F.struct("part", "node").alias("message"))
        received = sent.groupBy("tree", "block").agg(F.sort_array(F.collect_list("message")).alias("messages"))
        state = state.join(received, ["tree", "block"], "left")
        messages = F.coalesce("messages", F.array().cast("array<struct<part:int,node:string>>"))
        nodes = F.array_sort(F.concat(messages, F.array(F.struct("part", "node"))))
        state = state.select(
            "tree", "block", "blocks",
            F.when(active, F.sha2(F.array_join(nodes["node"], ""), 256)).otherwise(F.col("node")).alias("node"),
            F.when(active, F.concat("at", F.array("part"))).otherwise(F.col("at")).alias("at"),
            F.when(active, F.concat("siblings", F.array(messages["node"]))).otherwise(F.col("siblings")).alias("siblings"))
        if r % WRITE_EVERY == WRITE_EVERY - 1:
            state = saved(state, "merkle-round")
    return saved(state.withColumnRenamed("node", "root").drop("blocks"), "merkle-paths")


def with_proofs(items: DataFrame, paths: DataFrame, keep: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """``keep`` columns of the items, their tree's ``root`` and their proof (``at``, ``siblings``): each block's subtree
    is hashed once more and gives the lower levels, ``paths`` (one row a block, further columns allowed) the upper."""
    many = fanout ** depth
    more = [c for c in paths.columns if c not in ("tree", "block", "at", "siblings")]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in items.select(*keep).schema.fields]
    kinds += [f"`{f.name}` {f.dataType.simpleString()}" for f in paths.select(*more).schema.fields]

    def prove(table, path):
        pos = table["pos"].to_numpy()
        order = np.argsort(pos)
        table, pos = table.take(pa.array(order)), pos[order]
        levels = _subtree(table["leaf"].to_pylist(), table["size"][0].as_py(), fanout, depth)[:-1]
        above_at, above = path["at"][0].as_py(), path["siblings"][0].as_py()
        first = int(pos[0]) // many * many
        at, flat, counts = [], [], []
        for i in (pos - first).tolist():
            for nodes in levels:
                begin, k = i - i % fanout, i % fanout
                others = nodes[begin:i] + nodes[i + 1 : begin + fanout]
                at.append(k)
                flat += others
                counts.append(len(others))
                i //= fanout
            at += above_at
            for others in above:
                flat += others
                counts.append(len(others))
        runs = np.arange(len(pos) + 1, dtype=np.int32) * (len(levels) + len(above))
        inner = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts, dtype=np.int32))).astype(np.int32), pa.array(flat, pa.string()))
        columns = {c: table[c] for c in keep}
        columns |= {c: pa.array([path[c][0].as_py()] * len(pos), path.schema.field(c).type) for c in more}
        columns["at"] = pa.ListArray.from_arrays(runs, pa.array(at, pa.int32()))
        columns["siblings"] = pa.ListArray.from_arrays(runs, inner)
        return pa.table(columns)

    left = items.select(*dict.fromkeys([*keep, "tree", "pos", "size", "leaf"]), F.floor(F.col("pos") / many).alias("block"))
    return left.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(prove, f"{', '.join(kinds)}, {PATH}")


def folded(leaf: Column, at: str = "at", siblings: str = "siblings") -> Column:
    """The root that a leaf leads to with a proof's siblings."""
    steps = F.arrays_zip(F.col(at).alias("at"), F.col(siblings).alias("others"))
    join = lambda s, begin, n: F.array_join(F.slice(s["others"], begin, n), "")
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(
        join(s, F.lit(1), s["at"]), h, join(s, s["at"] + 1, F.size(s["others"]))), 256))


def merkle_manifest(rows: DataFrame, tree: str, order: list[str], keep: list[str], fanout: int = FANOUT,
                    depth: int = DEPTH) -> DataFrame:
    """``keep`` columns of ``rows`` (which have a column ``leaf``), ``subroot``, ``root``, and the proof ``at``,
    ``siblings`` from the leaf to the root.

    Each value of ``tree`` (null is one) has a tree of its leaves by ``order`` (nulls first; what ``order`` leaves open
    is settled by ``leaf``, so repeated rows only swap places with their equals).  Every ``fanout`` consecutive nodes,
    the last fewer, become the SHA-256 of their joined digests until one is left, the subroot; the subroots by ``tree``
    (null first, bytewise) lead to the root in the same way.  Columns of ``rows`` that are not named here are ignored; an
    empty table gives no rows.
    """
    ship(rows.sparkSession)
    items = saved(numbered_in_trees(rows.select(*dict.fromkeys([tree, *order, *keep, "leaf"])), tree, [*order, "leaf"]), "merkle-leaves")
    paths = exchange(block_roots(items, fanout, depth), fanout)
    # the subroots are the leaves of one more tree, each joined to its blocks' paths
    subroots = paths.where("block = 0").select("tree", F.col("root").alias("leaf"))
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "leaf",
                          F.lit(subroots.count()).cast("long").alias("size"), F.col("tree").alias("of"))
    top_paths = exchange(block_roots(top, fanout, depth), fanout)
    top = with_proofs(top, top_paths, ["of"], fanout, depth).select(
        F.col("of").alias("tree"), F.col("root").alias("whole"), F.col("at").alias("top_at"), F.col("siblings").alias("top_siblings"))
    paths = paths.join(top, "tree").select("tree", "block", F.col("root").alias("subroot"), F.col("whole").alias("root"),
                                           F.concat("at", "top_at").alias("at"), F.concat("siblings", "top_siblings").alias("siblings"))
    return with_proofs(items, paths, list(dict.fromkeys([*keep, "leaf"])), fanout, depth)


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = lambda d: F.sha2(F.concat(*[encoded(c) for c in fields]), 256)
    docs = read_table(spark, sf_dir, "documents").select(*fields)
    docs = docs.withColumn("leaf", leaf(docs))
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    docs = docs.withColumn("n_chars", F.col("n_chars") + F.coalesce(changed, F.lit(False)).cast("int"))
    docs = docs.withColumn("now", leaf(docs)).select("doc_id", "lang", "leaf", "now")
    out = merkle_manifest(docs, "lang", ["doc_id"], ["doc_id", "leaf", "now"])
    out = out.withColumn("folded_root", folded(F.col("now")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(F.flatten("siblings"), ""), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = """
WITH RECURSIVE
-- CRC-32 byte by byte: eight shifts a byte
crc AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 1 AS i, 4294967295::BIGINT AS v FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, i + 1, list_reduce([xor(v, ascii(s[i])::BIGINT)] || range(8),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) FROM crc WHERE i <= len(s)),
tampered AS (SELECT doc_id FROM crc WHERE i = len(s) + 1 AND xor(v, 4294967295::BIGINT) % 7 = 0),
field AS (
  SELECT d.doc_id, d.lang,
         coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(d.lang) || ':' || d.lang, '-') AS head,
         n_chars::VARCHAR AS n, (n_chars + (t.doc_id IS NOT NULL)::BIGINT)::VARCHAR AS n_now,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents d LEFT JOIN tampered t USING (doc_id)),
leaf AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, sha256(head || coalesce(strlen(n) || ':' || n, '-') || tail) AS leaf,
               sha256(head || coalesce(strlen(n_now) || ':' || n_now, '-') || tail) AS now FROM field)),
node AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM leaf
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM node
  WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
sub AS (SELECT tree, lvl AS height, h AS subroot FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, tree AS pos, (SELECT count(*) FROM sub) AS n, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top
  WHERE n > 1 GROUP BY lvl, pos // 2, n),
root AS (SELECT lvl AS height, h AS root FROM top WHERE n = 1),
step AS (
  SELECT l.tree, l.pos, s.lvl AS i, (l.pos >> s.lvl) % 2 AS k, node.h AS other
  FROM leaf l JOIN sub USING (tree), LATERAL (SELECT unnest(range(sub.height)) AS lvl) s
  LEFT JOIN node ON node.tree = l.tree AND node.lvl = s.lvl AND node.pos = xor(l.pos >> s.lvl, 1)
  UNION ALL
  SELECT l.tree, l.pos, sub.height + s.lvl, (l.tree >> s.lvl) % 2, top.h
  FROM leaf l JOIN sub USING (tree), root, LATERAL (SELECT unnest(range(root.height)) AS lvl) s
  LEFT JOIN top ON top.lvl = s.lvl AND top.pos = xor(l.tree >> s.lvl, 1)),
proof AS (SELECT tree, pos, string_agg(other, '' ORDER BY i) AS others FROM step GROUP BY tree, pos),
fold AS (
  SELECT tree, pos, 0 AS i, now AS h FROM leaf
  UNION ALL
  SELECT tree, pos, i + 1, sha256(CASE WHEN other IS NULL THEN h WHEN k = 1 THEN other || h ELSE h || other END)
  FROM fold JOIN step USING (tree, pos, i))
SELECT l.doc_id, l.leaf, sub.subroot, root.root, sha256(coalesce(p.others, '')) AS proof_sha256, fold.h AS folded_root,
       fold.h = root.root AS verified
FROM leaf l JOIN sub USING (tree) CROSS JOIN root LEFT JOIN proof p USING (tree, pos)
JOIN fold ON fold.tree = l.tree AND fold.pos = l.pos AND fold.i = sub.height + root.height
"""
