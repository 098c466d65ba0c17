"""Exact removal of repeated byte strings, by the common-prefix intervals of an enhanced suffix array.

A string of ``min_len`` bytes (a *window*) that also starts earlier is removed with every byte it covers.  Two
equal windows hold the same rarest-hash ``k``-gram at the same place (their *anchor*), so all windows fall into
runs of neighbours with one anchor, and equal windows have anchors of equal hash:

1. every task finds the runs of its texts and folds equal runs; a run that is not the first of its content is
   covered whole, since all its windows start earlier too;
2. runs are brought together by anchor hash in packed blocks, and folded again over the whole corpus;
   (an anchor so common that its runs would overfill a block has them split into single windows, which go to blocks
   by their own content; equal windows still meet, and that content is all there is to compare);
3. only runs whose anchor occurs in different surroundings are left.  Their bytes are fetched, their suffixes are
   put into an enhanced suffix array per hash block, and a stack scan of its common-prefix intervals lists the
   maximal repeats (intervals whose occurrences differ in the byte before) with all their occurrences: each
   occurrence but the first of a group covers its bytes;
4. the covered spans return to their texts, which are cut there.

Texts are written once, in blocks bucketed by the block number, and never shuffled: both visits (fetching bytes,
cutting) bring the small side to the text's bucket.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import forget_worker_caches, read_table, saved, scratch, ship, utf8

K = 32  # bytes of an anchor
FLUSH = 24 << 20  # text bytes whose runs are folded together before they leave a task
PIECE = 2 << 20  # a longer text is scanned in pieces of so many window starts
PLACE = 23  # bits for a place in what is scanned at once, under twice a piece and a window
RUNS = 200_000  # aimed at for each hash block
SAMPLE = 64  # one text in so many is looked at for common anchors; this only settles which block a window goes to
COMMON = 10_000  # common anchors at most
MUL = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
RUN = np.dtype([("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8"), ("n", "<u1")])
SPAN = np.dtype([("row", "<i4"), ("at", "<i8"), ("n", "<i4")])
ROWS = "bucket int, kind int, chunk int, blob binary"
COVERED, FOLD, FETCH = 0, 1, 2

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(16, int(n).bit_length())
        both = []
        for base in (BASE, INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[0] = tuple(both)
    return _powers[0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MUL
    h ^= h >> np.uint64(29)
    h *= BASE
    return h ^ (h >> np.uint64(32))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * MUL)


def _prefix_hash(buf: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=out[1:])
    return out


def _runs(buf: np.ndarray, first: np.ndarray, last: np.ndarray, min_len: int, common: np.ndarray):
    """Runs of the windows starting in each ``[first, last)`` of ``buf``: starts, counts, anchor and content hash.

    ``first``/``last`` hold ranges in rising order that do not overlap; a window from ``last - 1`` ends in ``buf``.
    """
    w = min_len - K + 1
    n = len(buf) - min_len + 1
    if n <= 0 or not len(first):
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    pre = _prefix_hash(buf)
    _, down = _power_tables(len(buf) + 1)
    g = (pre[K:] - pre[:-K]) * down[: len(buf) - K + 1]
    g = _mixed(g)
    # the place in the low bits: the leftmost of equal hashes is the anchor, as it is in every equal window
    low = np.uint64((1 << PLACE) - 1)
    m, span = (g & ~low) | np.arange(len(g), dtype=np.uint64), 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[: len(m) - (w - span)], m[w - span :])
    m = m[:n]
    valid = np.zeros(len(buf) + 1, np.int8)
    valid[first] += 1
    valid[last] -= 1
    valid = np.cumsum(valid[:n], dtype=np.int8).astype(bool)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(m[1:], m[:-1], out=new[1:])
    new[first[first < n]] = True
    new &= valid
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], n)
    stops = np.minimum(stops, last[np.searchsorted(first, starts, side="right") - 1])

    def content(a, z):
        return _mixed((pre[z] - pre[a]) * down[a] + (z - a).astype(np.uint64) * MUL)

    n, anchor, c = stops - starts, g[(m[starts] & low).astype(np.int64)], content(starts, stops + min_len - 1)
    split = np.isin(anchor, common)
    if split.any():
        k = n[split]
        each = np.repeat(starts[split] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        own = content(each, each + min_len)
        # anchor and content must both agree here too
        anchor = np.concatenate((anchor[~split], np.repeat(anchor[split], k) + own * MUL))
        starts, n, c = (np.concatenate(x) for x in ((starts[~split], each), (n[~split], np.ones(len(each), np.int64)), (c[~split], own)))
    return starts, n, anchor, c


def _pieces(texts: list[bytes], min_len: int):
    """``(row, offset, piece)``: whole short texts, long ones in overlapping pieces."""
    for row, t in enumerate(texts):
        if len(t) >= min_len:
            for at in range(0, len(t) - min_len + 1, PIECE):
                yield row, at, t[at : at + PIECE + min_len - 1] if len(t) > PIECE else t


def _text_runs(docs: list[int], rows: list[int], texts: list[bytes], min_len: int, common: np.ndarray) -> np.ndarray:
    found = []
    group, size = [], 0

    def scan():
        lens = np.fromiter((len(p) for _, _, p in group), np.int64, len(group))
        begin = np.cumsum(lens) - lens
        buf = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        s, n, h, c = _runs(buf, begin, begin + lens - min_len + 1, min_len, common)
        of = np.searchsorted(begin, s, side="right") - 1
        out = np.empty(len(s), RUN)
        out["h"], out["c"], out["n"] = h, c, n
        out["doc"] = np.array([docs[r] for r, _, _ in group], np.int64)[of]
        out["row"] = np.array([rows[r] for r, _, _ in group], np.int32)[of]
        out["at"] = s - begin[of] + np.array([a for _, a, _ in group], np.int64)[of]
        found.append(out)

    for piece in _pieces(texts, min_len):
        group.append(piece)
        size += len(piece[2])
        if size >= PIECE:
            scan()
            group, size = [], 0
    if group:
        scan()
    return np.concatenate(found) if found else np.empty(0, RUN)


def _ordered(runs: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """Order by content, then by what counts as earlier: doc id, then (for repeated ids) block and row, then place."""
    return np.lexsort((runs["at"], runs["row"], chunk, runs["doc"], runs["c"], runs["h"]))


def _spans(runs: np.ndarray, min_len: int) -> np.ndarray:
    out = np.empty(len(runs), SPAN)
    out["row"], out["at"] = runs["row"], runs["at"]
    out["n"] = runs["n"].astype(np.int32) + (min_len - 1)
    return out


def _fold(runs: np.ndarray, chunk: np.ndarray):
    """Masks of the runs that are the first with their content, and that are not."""
    order = _ordered(runs, chunk)
    r = runs[order]
    same = np.zeros(len(r), bool)
    same[1:] = (r["h"][1:] == r["h"][:-1]) & (r["c"][1:] == r["c"][:-1])
    first = np.zeros(len(r), bool)
    first[order] = ~same
    return first


def _rows(bucket, kind, chunk, blobs) -> pa.RecordBatch:
    return pa.record_batch([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(chunk, pa.int32()),
                            pa.array(blobs, pa.binary())], names=["bucket", "kind", "chunk", "blob"])


def _scan(min_len: int, n_buckets: int, common: np.ndarray):
    """Texts of a block in, its folded runs by hash block out, with the spans that are known to be covered."""

    def flush(chunk, docs, rows, texts):
        runs = _text_runs(docs, rows, texts, min_len, common)
        if not len(runs):
            return
        first = _fold(runs, np.zeros(len(runs), np.int8))
        gone = _spans(runs[~first], min_len)
        runs = runs[first]
        bucket = (runs["h"] % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        runs, bucket = runs[order], bucket[order]
        own, begin = np.unique(bucket, return_index=True)
        blobs = [runs[a:b].tobytes() for a, b in zip(begin, np.append(begin[1:], len(runs)))]
        buckets, kinds = own.tolist(), [FOLD] * len(own)
        if len(gone):
            # a block's covered spans only pass through
            buckets.append(chunk % n_buckets)
            kinds.append(COVERED)
            blobs.append(gone.tobytes())
        yield _rows(buckets, kinds, [chunk] * len(blobs), blobs)

    def run(batches):
        forget_worker_caches()
        at, docs, rows, texts, size = None, [], [], [], 0
        for batch in batches:
            for chunk, row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), utf8(batch.column(3))):
                if texts and (chunk != at or size >= FLUSH):
                    yield from flush(at, docs, rows, texts)
                    docs, rows, texts, size = [], [], [], 0
                at = chunk
                docs.append(doc)
                rows.append(row)
                texts.append(text)
                size += len(text)
        if texts:
            yield from flush(at, docs, rows, texts)

    return run


def _common_anchors(texts: DataFrame, min_len: int, bound: int, sample: int) -> np.ndarray:
    """Anchors that more than ``bound`` runs share, judged by one text in ``sample``: at most ``COMMON`` of them."""

    def run(batches):
        none = np.zeros(0, np.uint64)
        for batch in batches:
            values = utf8(batch.column(0))
            if sum(map(len, values)):
                runs = _text_runs([0] * len(values), list(range(len(values))), values, min_len, none)
                h, n = np.unique(runs["h"], return_counts=True)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    some = texts.where(F.pmod(F.xxhash64("chunk", "row"), F.lit(sample)) == 0).select("text")
    counts = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") * sample > bound)
    return np.array([r.h for r in counts.orderBy(F.desc("n"), "h").limit(COMMON).collect()], np.int64).view(np.uint64)


def _by_chunk(chunk: np.ndarray, data: np.ndarray, bucket: int, kind: int):
    order = np.argsort(chunk, kind="stable")
    chunk, data = chunk[order], data[order]
    own, begin = np.unique(chunk, return_index=True)
    blobs = [data[a:b].tobytes() for a, b in zip(begin, np.append(begin[1:], len(data)))]
    return [bucket] * len(own), [kind] * len(own), own.tolist(), blobs


def _unpack(table, kind: int, dtype) -> tuple[np.ndarray, np.ndarray]:
    table = table.filter(pa.compute.equal(table["kind"], kind))
    blobs, chunks = table["blob"].to_pylist(), table["chunk"].to_pylist()
    data = np.frombuffer(b"".join(blobs), dtype)
    return data, np.repeat(np.array(chunks, np.int32), [len(b) // dtype.itemsize for b in blobs])


def _fold_block(min_len: int):
    """Runs of one hash block: the covered spans, and the runs whose anchor has several surroundings."""

    def run(key, table):
        bucket = key[0].as_py()
        passed = table.filter(pa.compute.equal(table["kind"], COVERED))
        runs, chunk = _unpack(table, FOLD, RUN)
        parts = [([bucket] * len(passed), [COVERED] * len(passed), passed["chunk"].to_pylist(), passed["blob"].to_pylist())]
        if len(runs):
            # the sort that settles ties is only for anchors that occur more than once
            sort = np.argsort(runs["h"], kind="stable")
            h = runs["h"][sort]
            same = h[1:] == h[:-1]
            often = np.zeros(len(h), bool)
            often[1:] |= same
            often[:-1] |= same
            sort = sort[often]
            runs, chunk = runs[sort], chunk[sort]
        if len(runs):
            first = _fold(runs, chunk)
            parts.append(_by_chunk(chunk[~first], _spans(runs[~first], min_len), bucket, COVERED))
            runs, chunk = runs[first], chunk[first]
            _, back, n = np.unique(runs["h"], return_inverse=True, return_counts=True)
            mixed = n[back] > 1
            parts.append(_by_chunk(chunk[mixed], runs[mixed], bucket, FETCH))
        out = [sum((list(p[i]) for p in parts), []) for i in range(4)]
        return pa.Table.from_batches([_rows(*out)])

    return run


def _fetch(min_len: int):
    """A block of texts and the runs wanted from it: each run with its bytes and the byte before it."""

    def run(key, texts, wanted):
        chunk = key[0].as_py()
        if not len(wanted):
            return pa.Table.from_batches([_rows([], [], [], [])])
        at = {r: i for i, r in enumerate(texts["row"].to_pylist())}
        values = texts["text"].cast(pa.binary())
        buckets, kinds, blobs = [], [], []
        for bucket, blob in zip(wanted["bucket"].to_pylist(), wanted["blob"].to_pylist()):
            runs = np.frombuffer(blob, RUN)
            body = []
            for row, start, n in zip(runs["row"].tolist(), runs["at"].tolist(), runs["n"].tolist()):
                text = values[at[row]].as_buffer()
                body.append(bytes(text[start : start + n + min_len - 1]))
            buckets.append(bucket)
            kinds.append(FETCH)
            blobs.append(len(runs).to_bytes(8, "little") + runs.tobytes() + b"".join(body))
        return pa.Table.from_batches([_rows(buckets, kinds, [chunk] * len(blobs), blobs)])

    return run


def maximal_repeats(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, min_len: int):
    """Maximal repeats of ``min_len`` or more bytes among the suffixes ``buf[starts[i]:ends[i]]``.

    Builds the suffix array and the common-prefix array of these suffixes, scans it once with a stack of open
    intervals, and yields ``(length, occurrences)`` (indices into ``starts``) for every interval whose occurrences
    do not all follow the same byte (``before``: that byte, or a negative number where there is none, which differs
    from any other).  An interval holds all occurrences of its repeat, not only neighbours.
    """
    n = len(starts)
    if n < 2:
        return
    lens = ends - starts
    width = int(lens.max())
    at = starts[:, None] + np.arange(width)
    text = np.where(at < ends[:, None], buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint8)
    order = np.lexsort((lens, np.ascontiguousarray(text).view(f"S{width}")[:, 0]))
    text, lens = text[order], lens[order]
    differ = text[1:] != text[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.minimum(lcp, np.minimum(lens[1:], lens[:-1]))
    left = np.where(before[order] < 0, -1 - order, before[order])
    # number of changes of the byte before, so that an interval's diversity is one subtraction
    change = np.concatenate(([0], np.cumsum(left[1:] != left[:-1])))
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp.tolist(), -1]):
        begin = i
        while stack and stack[-1][0] > depth:
            length, begin = stack.pop()
            if change[i] > change[begin]:
                yield length, order[begin : i + 1]
        if depth >= min_len and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))


def _resolve(min_len: int):
    """Runs of one hash block with their bytes: the spans covered by maximal repeats."""

    def run(key, table):
        bucket = key[0].as_py()
        runs, chunk, bodies = [], [], []
        for c, blob in zip(table["chunk"].to_pylist(), table["blob"].to_pylist()):
            n = int.from_bytes(blob[:8], "little")
            got = np.frombuffer(blob, RUN, n, 8)
            runs.append(got)
            chunk.append(np.full(n, c, np.int32))
            bodies.append(blob[8 + n * RUN.itemsize :])
        runs, chunk = np.concatenate(runs), np.concatenate(chunk)
        buf = np.frombuffer(b"".join(bodies), np.uint8)
        size = runs["n"].astype(np.int64) + (min_len - 1)
        end = np.cumsum(size)
        begin = end - size
        # rank of a run among all: earlier text, then earlier place
        rank = np.empty(len(runs), np.int64)
        rank[np.lexsort((runs["at"], runs["row"], chunk, runs["doc"]))] = np.arange(len(runs))
        counts = runs["n"].astype(np.int64)
        of = np.repeat(np.arange(len(runs)), counts)
        shift = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begin[of] + shift
        pre = _prefix_hash(buf)
        _, down = _power_tables(len(buf) + 1)
        window = (pre[start + min_len] - pre[start]) * down[start]
        sort = np.argsort(window, kind="stable")
        same = window[sort][1:] == window[sort][:-1]
        keep = np.zeros(len(sort), bool)
        keep[1:] |= same
        keep[:-1] |= same
        pick = sort[keep]
        covered = []
        # windows of equal hash lie together: cut where the hash changes, some thousands of suffixes at a time
        cuts = np.flatnonzero(np.concatenate(([True], window[pick][1:] != window[pick][:-1]))) if len(pick) else []
        at = 0
        while at < len(cuts):
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 20_000)))
            some = pick[cuts[at] : cuts[to] if to < len(cuts) else len(pick)]
            at = to
            s, o, sh = start[some], of[some], shift[some]
            before = np.where(sh > 0, buf[np.maximum(s - 1, 0)].astype(np.int64), -1)
            for length, group in maximal_repeats(buf, s, end[o], before, min_len):
                who, where = o[group], sh[group]
                key_ = rank[who] * 256 + where
                first = key_.min()
                rest = group[key_ > first]
                out = np.empty(len(rest), SPAN)
                out["row"], out["at"] = runs["row"][o[rest]], runs["at"][o[rest]] + sh[rest]
                out["n"] = length
                covered.append((chunk[o[rest]], out))
        if not covered:
            return pa.Table.from_batches([_rows([], [], [], [])])
        spans = np.concatenate([c[1] for c in covered])
        return pa.Table.from_batches([_rows(*_by_chunk(np.concatenate([c[0] for c in covered]), spans, bucket, COVERED))])

    return run


def _merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, sorted, maximal spans of one text."""
    order = np.argsort(spans["at"], kind="stable")
    a = spans["at"][order]
    z = np.maximum.accumulate(a + spans["n"][order])
    new = np.concatenate(([True], a[1:] > z[:-1]))
    return a[new], z[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]


def _cut(with_text: bool):
    """A block of texts and its covered spans: one row per text."""

    def run(key, texts, covered):
        spans = np.frombuffer(b"".join(covered["blob"].to_pylist()), SPAN) if len(covered) else np.empty(0, SPAN)
        spans = spans[np.argsort(spans["row"], kind="stable")]
        rows = texts["row"].to_pylist()
        lo, hi = (np.searchsorted(spans["row"], rows, side=s) for s in ("left", "right"))
        n_bytes, n_removed, n_spans, sha, kept, gone = [], [], [], [], [], []
        for text, a, b in zip(utf8(texts["text"].combine_chunks()), lo.tolist(), hi.tolist()):
            begin, end = _merged(spans[a:b]) if b > a else ((), ())
            parts, at = [], 0
            for x, z in zip(list(begin), list(end)):
                parts.append(text[at:x])
                at = z
            parts.append(text[at:])
            left = b"".join(parts)
            n_bytes.append(len(text))
            n_removed.append(len(text) - len(left))
            n_spans.append(len(begin))
            sha.append(hashlib.sha256(left).hexdigest())
            if with_text:
                kept.append(left.decode("utf-8", "ignore"))
                gone.append([{"start": int(x), "end": int(z)} for x, z in zip(begin, end)])
        cols = [texts["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            cols += [pa.array(kept, pa.string()), pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names += ["kept_text", "removed"]
        more = [n for n in texts.column_names if n.startswith("other_")]
        cols += [texts[n] for n in more]
        names += more
        return pa.Table.from_arrays(cols, names=names)

    return run


MOST_BUCKETS = 20_000  # Spark allows 100,000; a bucket then holds several blocks, which are read one after another
BLOCK_ROWS = 1 << 15  # texts of a block


def _n_buckets(partitions: int) -> int:
    return max(1, min(partitions, MOST_BUCKETS))


def _bucketed(docs: DataFrame, id_col: str, text_col: str, others: list[str]) -> DataFrame:
    """The texts written in blocks (at most ``BLOCK_ROWS`` texts of an input partition; a 64th block of a partition
    takes all further ones), bucketed by block number without a shuffle.

    The table is dropped from the catalog at once: its files stay, and the plan has already found them.
    """
    spark = docs.sparkSession
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    blocks = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         *(F.col(c).alias(f"other_{i}") for i, c in enumerate(others)),
                         (F.spark_partition_id() * 64 + F.least(F.floor(row / BLOCK_ROWS), F.lit(63))).cast("int").alias("chunk"),
                         row.cast("int").alias("row"))
    blocks = blocks.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    path = scratch(spark, "suffix-texts")
    name = "suffix_texts_" + path.rpartition("-")[2]
    n = _n_buckets(docs.select(id_col).rdd.getNumPartitions())
    blocks.write.option("compression", "zstd").option("path", path).bucketBy(n, "chunk").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def repeated_text(docs: DataFrame, min_len: int = 100, id_col: str = "doc_id", text_col: str = "text",
                  with_text: bool = True, others: tuple[str, ...] = (), block_runs: int = RUNS,
                  sample: int = SAMPLE) -> DataFrame:
    """One row per text: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, unless ``with_text`` is false,
    ``kept_text`` and ``removed`` (spans of byte offsets).  ``others`` names columns to hand on (``other_0``, ...).

    Removed is every byte covered by a ``min_len``-byte string that also starts earlier (smaller id, or the same
    text further left), judged on the input.  Matches never cross texts.  A null text is empty.  Rows repeated with
    one id are separate texts, ordered as they lie in the table; a null id orders before every other.  A kept text
    loses the odd bytes of a character that a span cuts in two (``kept_sha256`` is over the exact bytes).
    An empty table gives no rows; other columns are ignored.

    ``block_runs`` bounds what one anchor may bring into a hash block, ``sample`` is the share of texts looked at for
    anchors above that; neither changes the result.

    Equal runs are told by two 64-bit hashes (of the anchor and of the whole run) that must both agree; runs that
    share only the anchor are compared byte by byte.
    """
    if not K < min_len <= K + 127:
        raise ValueError(f"min_len must lie between {K + 1} and {K + 127}")
    spark = docs.sparkSession
    ship(spark)
    texts = _bucketed(docs, id_col, text_col, list(others))
    total = texts.agg(F.sum("n_bytes")).first()[0] or 0
    n_runs = total / ((min_len - K) / 2)
    n_buckets = max(16, int(n_runs / block_runs))
    common = _common_anchors(texts, min_len, max(block_runs, int(n_runs / COMMON)), sample)
    scan = texts.select("chunk", "row", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "text")
    runs = scan.mapInArrow(_scan(min_len, n_buckets, common), ROWS)
    folded = saved(runs.groupBy("bucket").applyInArrow(_fold_block(min_len), ROWS), "suffix-folded")
    blocks = texts.select("chunk", "row", "doc_id", "text").groupBy("chunk")
    fetched = blocks.cogroup(folded.where(F.col("kind") == FETCH).groupBy("chunk")).applyInArrow(_fetch(min_len), ROWS)
    resolved = saved(fetched.groupBy("bucket").applyInArrow(_resolve(min_len), ROWS), "suffix-resolved")
    covered = folded.where(F.col("kind") == COVERED).unionByName(resolved)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema += ", kept_text string, removed array<struct<start: bigint, end: bigint>>"
    more = [f for f in texts.schema.fields if f.name.startswith("other_")]
    schema += "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)
    whole = texts.drop("n_bytes").groupBy("chunk")
    return whole.cogroup(covered.groupBy("chunk")).applyInArrow(_cut(with_text), schema)


def without_repeats(docs: DataFrame, min_len: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all rows and columns, with ``text_col`` cut by :func:`repeated_text`."""
    others = tuple(c for c in docs.columns if c not in (id_col, text_col))
    cut = repeated_text(docs, min_len, id_col, text_col, others=others)
    back = {f"other_{i}": c for i, c in enumerate(others)} | {"doc_id": id_col, "kept_text": text_col}
    names = {c: old for old, c in back.items()}
    return cut.select(*(F.col(names[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = repeated_text(read_table(spark, sf_dir, "documents"), min_len=100, with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, x, unnest(range(0, len(x) // 2)) AS i FROM d),
w AS (SELECT doc_id, i, substring(x, 2 * i + 1, 2) AS byte,
             CASE WHEN 2 * i + 200 <= len(x) THEN hash(substring(x, 2 * i + 1, 200)) END AS s FROM p),
r AS (SELECT doc_id, i, byte,
             s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM w),
c AS (SELECT doc_id, i, byte,
             bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
g AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed,
             count(*) FILTER (WHERE begins) AS n_spans,
             coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
