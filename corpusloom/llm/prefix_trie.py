"""Conversation prefix trie: ROLLUP over positional turn-id columns aggregates all prefixes of a block of turns at once;
longer conversations go on in further blocks, keyed by the node that the block before ended in.

A node is a distinct sequence of first turns.  Only nodes with several members need the ROLLUP: once a conversation is
alone on its path, the rest of it is a chain whose numbers are known, so the number of blocks follows from the longest
*shared* prefix, not from the longest conversation.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, saved, ship
from corpusloom.operators.index import contiguous_index

WIDTH = 8  # turns in a block
_SPAN = 1 << 16  # turns of one conversation that may meet on one join key
_CHUNK = 4096  # bytes of an ends list in one row
FIRST_TURNS = 8  # the most turns that a rebuilt conversation takes over


def turn_id(role: Column, text: Column) -> Column:
    """A turn's id: the UTF-8 length of its text, a colon and 128 bits of a SHA-256 of role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), F.substring(digest, 1, 32))


def _spread(per_conv: DataFrame, first: str, last: str, span: str) -> DataFrame:
    """One row per conversation and span of places from ``first`` to ``last`` (none if there is none)."""
    some = per_conv.where(f"{last} >= {first}")
    return some.withColumn(span, F.explode(F.sequence(F.floor(F.col(first) / _SPAN), F.floor(F.col(last) / _SPAN))))


def numbered(messages: DataFrame) -> DataFrame:
    """``(conv_id, pos, tid, len)``: a conversation's turns by number from 0, and how many it has.

    Turns are ordered by ``turn`` (null first), ties by turn id; repeated rows are turns of their own.  Null roles and
    texts are empty.  Rows without ``conv_id`` belong to no conversation and are left out; other columns are ignored.
    Rows are numbered by range partitions, so that a conversation with very many turns is spread over tasks.
    """
    rows = messages.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(F.col("role"), F.col("text")).alias("tid"))
    placed = contiguous_index(rows, ["conv_id", "turn", "tid"], "g").select("conv_id", "tid", "g")
    per = placed.groupBy("conv_id").agg(F.min("g").alias("g0"), F.max("g").alias("g1"))
    per = _spread(per, "g0", "g1", "span")
    return placed.withColumn("span", F.floor(F.col("g") / _SPAN)).join(per, ["conv_id", "span"]).select(
        "conv_id", (F.col("g") - F.col("g0")).alias("pos"), "tid", (F.col("g1") - F.col("g0") + 1).alias("len"))


def rebuilt(turns: DataFrame, group: int = 5, most: int = FIRST_TURNS) -> DataFrame:
    """Numbered turns of rebuilt conversations: the first ``h`` turns of conversation ``c - c % group`` (all if it has
    fewer, none if it is absent), then ``c``'s own after its first ``h``; ``h`` = CRC-32 of ``c`` in decimal, modulo
    ``most + 1``.  A conversation that is left without turns keeps one row with a null ``pos`` and ``len`` 0."""
    turns = saved(turns, "trie-turns")
    size = turns.where("pos = 0").select("conv_id", F.col("len").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % group
    c = size.withColumns({"base": base, "h": F.crc32(F.col("conv_id").cast("string")) % (most + 1)})
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    c = c.join(size.select(F.col("conv_id").alias("base"), F.col("own").alias("base_len")), "base", "left").withColumns(
        {"taken": taken, "len": taken + F.greatest(F.col("own") - F.col("h"), F.lit(0)), "end": F.col("own") - 1})
    c = saved(c.select("conv_id", "base", "h", "taken", "len", "end"), "trie-conversations")
    own = turns.drop("len").withColumn("span", F.floor(F.col("pos") / _SPAN)).join(
        _spread(c, "h", "end", "span"), ["conv_id", "span"])
    own = own.where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tid", "len")
    # at most `most` turns of a base, for at most `group` conversations
    head = turns.where((F.col("pos") < most) & (F.col("conv_id") == base)).select(F.col("conv_id").alias("base"), "pos", "tid")
    head = head.join(c, "base").where("pos < h").select("conv_id", "pos", "tid", "len")
    none = c.where("len = 0").select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("tid"), "len")
    return own.unionByName(head).unionByName(none)


def _ids(names: list[str]) -> Column:
    """The id of the node that ``prev`` and the turn ids (null from some place on) lead to."""
    return F.when(F.col(names[0]).isNull(), F.col("prev")).otherwise(F.sha2(F.concat_ws("|", "prev", *names), 256))


def _rollup(rows: DataFrame, names: list[str], values: str) -> DataFrame:
    """``values`` of every prefix of the columns ``names`` (and of ``prev`` alone), with the prefix's length ``j``."""
    out = rows.sparkSession.sql(
        f"SELECT prev, {', '.join(names)}, {len(names)} - bit_count(grouping_id()) AS j, {values} "
        f"FROM {{rows}} GROUP BY prev, ROLLUP ({', '.join(names)})", rows=rows)
    # a conversation that ends within the block is no member of longer prefixes
    return out.where((F.col("j") == 0) | F.get(F.array(*names), F.col("j") - 1).isNotNull())


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of numbered turns (as ``numbered`` or ``rebuilt`` gives them): ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes in its subtree, itself included), ``saved_tokens`` (over its subtree, ``n_convs - 1`` times the UTF-8 bytes of
    a node's last text) and ``ends_sha256`` (of the comma-joined ids, ascending, of the members that end there).

    The root has depth 0 and all conversations as members.  An empty table has no nodes, not even a root.
    """
    ship(turns.sparkSession)
    names = [f"t{k + 1}" for k in range(width)]
    turns = saved(turns, "trie-rebuilt")
    blocks, ends, tails, going = [], [], [], None
    while True:
        at = len(blocks) * width
        block = turns.where((F.col("pos") >= at) & (F.col("pos") < at + width))
        if going is None:
            block = block.unionByName(turns.where("pos is null"))
        cols = [F.max(F.when(F.col("pos") == at + k, F.col("tid"))).alias(n) for k, n in enumerate(names)]
        rows = block.groupBy("conv_id").agg(F.max("len").alias("len"), *cols)
        if going is None:
            rows = rows.withColumns({"prev": F.lit(""), "top": F.lit(None).cast("long")})
        else:
            rows = rows.join(going, "conv_id")
        rows = saved(rows.withColumn("id", _ids(names)), "trie-rows")
        nodes = _rollup(rows, names, "min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS longest, min(top) AS top")
        last = F.get(F.array(*names), F.col("j") - 1)
        nodes = nodes.withColumns({
            "id": _ids(names), "conv_id": F.when(F.col("j") == 0, F.coalesce("top", "conv_id")).otherwise(F.col("conv_id")),
            "saved": F.when(F.col("j") == 0, 0).otherwise((F.col("n_convs") - 1) * F.substring_index(last, ":", 1).cast("long")),
            # the rest of a conversation that is alone from here on has one leaf
            "leaf": ((F.col("longest") == at + F.col("j")) | ((F.col("j") == width) & (F.col("n_convs") == 1))).cast("long"),
            "alone": ((F.col("j") == width) & (F.col("n_convs") == 1) & (F.col("longest") > at + width)).cast("long"),
        })
        blocks.append(saved(nodes, "trie-nodes"))
        ends.append(rows.where(F.col("len") <= at + width).select("id", "conv_id"))
        on = rows.where(F.col("len") > at + width).select("conv_id", "len", F.col("id").alias("prev"))
        bottom = blocks[-1].where(F.col("j") == width).select(F.col("id").alias("prev"), "n_convs", F.col("conv_id").alias("top"))
        on = saved(on.join(bottom, "prev"), "trie-going")
        tails.append(on.where("n_convs = 1").select("conv_id", F.lit(at + width).cast("long").alias("first"),
                                                    (F.col("len") - 1).alias("last")))
        going = on.where("n_convs > 1").select("conv_id", "prev", "top")
        if going.isEmpty():
            break
    out, carry = [], None
    for b in reversed(range(len(blocks))):
        nodes = blocks[b]
        if carry is not None:
            nodes = nodes.join(carry, "id", "left")
            nodes = nodes.withColumns({"leaf": F.col("leaf") + F.coalesce("below_leaves", F.lit(0)),
                                       "saved": F.col("saved") + F.coalesce("below_saved", F.lit(0)),
                                       "alone": F.col("alone") + F.coalesce("below_children", F.lit(0))})
        counts = ", ".join(f"count_if(j = {k + 1}) AS c{k + 1}" for k in range(width))
        whole = _rollup(nodes, names, "min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf) AS n_leaves, "
                        f"sum(saved) AS saved_tokens, max_by(alone, j) AS further, {counts}")
        n_children = F.when(F.col("j") == width, F.col("further")).otherwise(
            F.get(F.array(*[f"c{k + 1}" for k in range(width)]), F.col("j")))
        whole = whole.withColumns({"id": _ids(names), "n_children": n_children, "depth": (F.col("j") + b * width).cast("long"),
                                   "parent": _parent(names)}).drop(*[f"c{k + 1}" for k in range(width)], "further")
        whole = saved(whole, "trie-whole")
        parents = whole.where(F.col("j") < width).select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        found = whole.join(parents, "parent", "left")
        out.append(found if b == 0 else found.where("j > 0"))
        carry = whole.where("j = 0").select("id", F.col("n_leaves").alias("below_leaves"),
                                            F.col("saved_tokens").alias("below_saved"), F.col("n_children").alias("below_children"))
    some = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = _union(out).join(id_list_digests(_union(ends)), "id", "left").select(
        *some, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    chain = turns.where("pos is not null").withColumn("span", F.floor(F.col("pos") / _SPAN)).join(
        _spread(_union(tails), "first", "last", "span"), ["conv_id", "span"]).where("pos >= first")
    ends_here = F.col("pos") == F.col("last")
    one = F.lit(1).cast("long")
    chain = chain.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"),
                         one.alias("n_convs"), F.when(ends_here, 0).otherwise(1).cast("long").alias("n_children"),
                         one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                         F.sha2(F.when(ends_here, F.col("conv_id").cast("string")).otherwise(""), 256).alias("ends_sha256"))
    return inner.unionByName(chain)


def _parent(names: list[str]) -> Column:
    """The id of a node's parent, of a node of this block (null for its top)."""
    out = F.lit(None).cast("string")
    for k, name in enumerate(names):
        above = F.col("prev") if k == 0 else F.sha2(F.concat_ws("|", "prev", *names[:k]), 256)
        out = F.when(F.col("j") == k + 1, above).otherwise(out)
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def id_list_digests(pairs: DataFrame) -> DataFrame:
    """``(id, ends_sha256)``: for each ``id`` the SHA-256 of its ``conv_id`` in decimal, ascending, comma-joined.

    SHA-256 has to read a list from its beginning, so a list ends in one task; but there it arrives as chunks of 4 KB
    that many tasks have joined from ranges of (id, conv_id), and is read as a stream, never held whole.
    """

    def chunks(batches):
        key, first, text, size = None, 0, [], 0
        out = []
        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i != key or size > _CHUNK:
                    if text:
                        out.append((key, first, ",".join(text)))
                    key, first, text, size = i, c, [], 0
                text.append(str(c))
                size += len(text[-1]) + 1
            yield _rows(out, ["id", "first", "text"], [pa.string(), pa.int64(), pa.string()])
            out = []
        if text:
            yield _rows([(key, first, ",".join(text))], ["id", "first", "text"], [pa.string(), pa.int64(), pa.string()])

    def digests(batches):
        key, sha, out = None, None, []
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if sha is not None and i == key:
                    sha.update(b"," + text.encode())
                    continue
                if sha is not None:
                    out.append((key, sha.hexdigest()))
                key, sha = i, hashlib.sha256(text.encode())
            yield _rows(out, ["id", "ends_sha256"], [pa.string(), pa.string()])
            out = []
        if sha is not None:
            yield _rows([(key, sha.hexdigest())], ["id", "ends_sha256"], [pa.string(), pa.string()])

    parts = pairs.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    parts = parts.mapInArrow(chunks, "id string, first long, text string")
    return parts.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digests, "id string, ends_sha256 string")


def _rows(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(numbered(read_table(spark, sf_dir, "conversations"))))


OP12_SQL = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    strlen(text)::VARCHAR || ':' || sha256(strlen(role)::VARCHAR || ':' || role || text)) - 1 AS pos FROM m),
-- CRC-32 byte by byte: eight shifts a byte
crc AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR AS s, 1 AS i, 4294967295::BIGINT AS v FROM t
  UNION ALL
  SELECT conv_id, s, i + 1, list_reduce([xor(v, ascii(s[i])::BIGINT)] || range(8),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) FROM crc WHERE i <= len(s)),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(v, 4294967295::BIGINT) % 9 AS h FROM crc WHERE i = len(s) + 1),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
path AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS p
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
member AS (SELECT conv_id, p, p[:d] AS node, d FROM (SELECT conv_id, p, unnest(range(len(p) + 1)) AS d FROM path)),
node AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(p) = d) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(node[d].text) END AS own
  FROM member GROUP BY node, d),
child AS (SELECT node[:d - 1] AS node, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (node, d)),
-- every node counts once at each of its ancestors and itself
up AS (SELECT node[:a] AS node, a AS d, own, n_children FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_node)),
total AS (SELECT node, d, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM up GROUP BY node, d)
SELECT n.conv_id, n.d AS depth, par.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_node n JOIN total t ON t.node = n.node AND t.d = n.d
LEFT JOIN full_node par ON par.d = n.d - 1 AND par.node = n.node[:n.d - 1]
"""
