"""Byte-level BPE: recursive DuckDB queries inside each partition contract token-position rows by a merge table.

Spark splits the texts over tasks; a task gathers the distinct word pieces it has not met, and one recursive query
contracts, in each of them at once, the leftmost pair of least rank until no pair is left.  Decoding joins token
positions with the token bytes and aggregates them in order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, ship, worker_cache
from corpusloom.llm.segments import SegmentCache, batches_of_text, joinable

LONG = 192  # bytes; the recursion's work on one piece grows with the square of its length, so a heap takes longer ones
AT_ONCE = 40_000  # pieces in one recursive query

CODE = """
WITH RECURSIVE word(step, piece, tokens) AS (
  SELECT 0, piece, list(token ORDER BY position) FROM start GROUP BY piece
  UNION ALL
  SELECT step + 1, piece, tokens[: spot - 1] || [least_rank] || tokens[spot + 2 :]
  FROM word JOIN (
    SELECT p.piece AS which, min(m.merged::BIGINT << 16 | p.position) AS first_least,
           (first_least >> 16)::INT AS least_rank, (first_least & 65535)::INT AS spot
    FROM (SELECT piece, unnest(tokens) AS token, unnest(tokens[2:]) AS follower,
                 unnest(range(1, len(tokens) + 1)) AS position FROM word) p
    JOIN merges m ON m.pair = (p.token::BIGINT << 32 | p.follower)
    GROUP BY p.piece) ON piece = which
),
coded AS MATERIALIZED (SELECT piece, arg_max(tokens, step) AS tokens FROM word GROUP BY piece)
"""

DECODE = """
SELECT piece, len(tokens) AS n, (' ' || array_to_string(tokens, ' '))::BLOB AS ids, unhex(hex) AS back
FROM coded JOIN (
  SELECT piece, string_agg(v.hex, '' ORDER BY position) AS hex
  FROM (SELECT piece, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS position FROM coded)
  JOIN vocabulary v USING (token) GROUP BY piece) USING (piece)
ORDER BY piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceCoder:
    """Encodes and decodes distinct pieces with DuckDB, one connection per Python worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks, self.split = read_ranks(path), regex.compile(pattern).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        pairs = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.pairs = dict(pairs)
        self._load("merges", pair=pa.array([p for p, _ in pairs], pa.int64()), merged=pa.array([r for _, r in pairs], pa.int32()))
        self._load("vocabulary", token=pa.array(list(self.ranks.values()), pa.int32()),
                   hex=pa.array([t.hex() for t in self.ranks]))
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pieces: dict[str, tuple] = {}

    def _load(self, name: str, **columns) -> None:
        table = pa.table(columns)
        self.con.register("loading", table)
        self.con.sql(f"CREATE TABLE {name} AS SELECT * FROM loading")
        self.con.unregister("loading")

    def _long(self, piece: bytes) -> list[int]:
        """The same contractions, least rank first and leftmost among equals, kept in a heap."""
        token = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        heap, end = [], len(token)

        def offer(i):
            if i >= 0 and after[i] < end:
                rank = self.pairs.get(token[i] << 32 | token[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, token[i], token[after[i]]))

        for i in range(end):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= end or token[j] != b:
                continue
            token[i], token[j], after[i] = rank, None, after[j]
            if after[j] < end:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in token if t is not None]

    def _answer(self, query: str) -> list[tuple[int, bytes, bytes]]:
        """Per piece: the number of its ids, the ids in decimal (each after a space), the bytes that they decode to."""
        t = self.con.sql(query).to_arrow_table()
        return list(zip(*(t[c].combine_chunks().to_numpy(zero_copy_only=False).tolist() for c in ("n", "ids", "back"))))

    def _contract(self, pieces: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        position = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.con.register("start", pa.table({"piece": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes),
                                             "position": position.astype(np.int32), "token": self.single[data]}))
        return self._answer(CODE + DECODE)

    def _decode(self, coded: list[list[int]]) -> list[tuple[int, bytes, bytes]]:
        self.con.register("coded", pa.table({"piece": np.arange(len(coded), dtype=np.int32),
                                             "tokens": pa.array(coded, pa.list_(pa.int32()))}))
        return self._answer(DECODE)

    def code(self, pieces: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Per piece: the number of its ids, the ids in decimal (each after a space), the bytes that they decode to."""
        out: list = [None] * len(pieces)
        raw = [p.encode() for p in pieces]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG]
        for at in range(0, len(short), AT_ONCE):
            some = short[at : at + AT_ONCE]
            for i, found in zip(some, self._contract([raw[i] for i in some])):
                out[i] = found
        long = [i for i, b in enumerate(raw) if len(b) > LONG]
        if long:
            for i, found in zip(long, self._decode([self._long(raw[i]) for i in long])):
                out[i] = found
        return out

    def segments(self, some: list[str]) -> list[tuple[int, bytes, bytes]]:
        """What ``code`` gives, for segments of several pieces."""
        if len(self.pieces) > 600_000:
            self.pieces.clear()
        out: list = [None] * len(some)
        for kind, which in joinable(some).items():
            if kind == "alone":
                cut = [self.split(some[i]) for i in which]
                pieces = [p for c in cut for p in c]
                last = np.cumsum([len(c) for c in cut], dtype=np.int64)
                first = np.concatenate(([0], last))[:-1]
            else:
                # the pattern's pieces of the joined text, parted again where the segments begin
                pieces = self.split(kind.join([some[i] for i in which]))
                ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
                size = np.fromiter((len(some[i]) for i in which), np.int64, len(which)) + len(kind)
                begin = np.cumsum(size) - size
                first, last = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, begin + size - len(kind), "left") + 1
            new = list(set(pieces).difference(self.pieces))
            self.pieces.update(zip(new, self.code(new)))
            found = list(map(self.pieces.__getitem__, pieces))
            for i, a, z in zip(which, first.tolist(), last.tolist()):
                if z - a == 1:
                    out[i] = found[a]
                else:
                    n, ids, back = zip(*found[a:z])
                    out[i] = sum(n), b"".join(ids), b"".join(back)
        return out


def _cache(path: str, pattern: str) -> SegmentCache:
    return worker_cache(f"bpe:{path}:{pattern}", lambda: SegmentCache(PieceCoder(path, pattern).segments, 500_000))


def bpe_round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = True) -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` and, with ``with_ids``, ``ids`` and ``decoded`` (the bytes
    that the ids decode to).

    ``ranks`` names a rank file, ``pattern`` the word pattern; there are no special tokens.  Whole texts are encoded;
    null and empty texts have no ids.  Ids of rows are passed on as they are (null, repeated); other columns are
    ignored; an empty table gives no rows.  Pieces over 192 bytes are contracted in the same order by a heap.
    """
    ship(docs.sparkSession)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if with_ids else [])

    def run(batches):
        cache = _cache(ranks, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in batches_of_text(texts):
                n, ids_sha, back_sha, ids, decoded = [], [], [], [], []
                values, places = cache.looked_up(texts[a:z])
                counts, lines, backs = list(zip(*values)) or ((), (), ())
                for some in places:
                    line = b"".join(map(lines.__getitem__, some))[1:]
                    back = b"".join(map(backs.__getitem__, some))
                    n.append(sum(map(counts.__getitem__, some)))
                    ids_sha.append(hashlib.sha256(line).hexdigest())
                    back_sha.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        ids.append(list(map(int, line.split())))
                        decoded.append(back)
                cols = [batch.column(0).slice(a, z - a), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                        pa.array(back_sha, pa.string())]
                if with_ids:
                    cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                yield pa.record_batch(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded binary"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def op7_byte_level_bpe(spark, sf_dir: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    return bpe_round_trip(read_table(spark, sf_dir, "documents"), ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          pattern or public_tokenizers.PATTERN, with_ids=False)
