"""SimHash, embedding and suffix-array deduplication against brute force, and their edge cases."""

import hashlib

import numpy as np
import pytest
import xxhash

from corpusloom.llm import embed_dedup, simhash, suffix_dedup
from corpusloom.llm.components import connected_components

WORDS = [f"w{i}" for i in range(400)]


def groups_of(n, linked):
    """Smallest index reachable from each, by repeated relaxation over all pairs."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked(i, j) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def docs_frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], "doc_id long, text string, fp string, k int, node string")


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(5, i) for i in range(500, 540)]
    ring = [(900, 901), (901, 902), (902, 900), (902, 902), (None, 900)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(path + star + ring, "a long, b long")).collect()}
    assert got == ({i: 100 for i in range(100, 141)} | {i: 5 for i in range(500, 540)} | {5: 5}
                   | {900: 900, 901: 900, 902: 900})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words, current = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [current] if current else []
            current = ""
        else:
            current += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows():
    rng = np.random.default_rng(3)
    rows, base = [], [" ".join(rng.choice(WORDS, 120)) for _ in range(6)]
    for i in range(90):
        words = base[i % 6].split()
        for _ in range(i % 4):
            words[int(rng.integers(120))] = "Edit"
        rows.append((1000 - i, " ".join(words)))
    rows += [(1, None), (2, ""), (3, " \t\r\n"), (4, "Ä one\xa0word"), (5, "ONE two"), (6, "one  TWO"), (7, "É"),
             (8, "w1 " * 30000), (9, " ".join(WORDS * 60)), (1000, base[0])]
    return rows


def test_simhash_equals_brute_force(spark):
    rows = simhash_rows()
    fps = [brute_fingerprint(t) for _, t in rows]
    label = groups_of(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    best = {}
    for (i, _), c in zip(rows, label):
        best[c] = min(i, best.get(c, i))
    want = sorted((i, f"{f:016x}", best[c]) for (i, _), f, c in zip(rows, fps, label))
    got = simhash.simhash_groups(docs_frame(spark, rows)).collect()
    assert sorted((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got) == want
    assert len({w[2] for w in want}) < len(want) - 25  # near copies do link


def test_simhash_pigeonhole_finds_every_pair_at_the_bound(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60).tolist()
    fps = base + [b ^ sum(1 << int(x) for x in rng.choice(63, 4, replace=False)) for b in base]
    fps += [b ^ sum(1 << int(x) for x in rng.choice(63, 5, replace=False)) for b in base[:20]]
    frame = spark.createDataFrame(list(enumerate(fps)), "node long, fp long")
    parts = {r.node: r.component for r in connected_components(simhash.fingerprint_links(frame)).collect()}
    want = groups_of(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert [parts.get(i, i) for i in range(len(fps))] == want


def test_simhash_dense_bucket_emits_no_pairs(spark):
    """All fingerprints two bits from a hidden centre: 2,016 rows, over two million pairs, one component."""
    fps = [(1 << i) | (1 << j) for i in range(63) for j in range(i)]
    frame = spark.createDataFrame(list(enumerate(fps)), "node long, fp long")
    links = simhash.fingerprint_links(frame)
    assert links.count() < 30 * len(fps)
    assert connected_components(links).select("component").distinct().count() == 1


def test_simhash_null_ids_and_empty_table(spark):
    got = simhash.simhash_groups(docs_frame(spark, [(None, "a b c"), (4, "a b c"), (None, "x y z")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 4), (4, 4)]
    assert simhash.simhash_groups(docs_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash.simhash_groups(docs_frame(spark, [(1, "a")]), max_bits=6, n_blocks=6).count()


def test_keep_one_per_group(spark):
    docs = docs_frame(spark, [(1, "a b c d"), (2, "a b c d"), (3, "other words here now")])
    kept = simhash.keep_one_per_group(docs, simhash.simhash_groups(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns.sort() == docs.columns.sort()


def vectors(seed=1, n=400, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    x = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape), base + 0.3 * rng.normal(size=base.shape),
                        base * rng.uniform(0.1, 9, size=(len(base), 1))])
    return x


def embedding_frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, "z") for i, v in rows], "vec_id long, embedding array<float>, unit int, weight string")


def test_embedding_links_equal_brute_force(spark):
    x = vectors().astype(np.float32).tolist()
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [1.0, 0.0], [2.0, 0.0], [1e-38] * 16]
    values = x + odd + x[:3]
    ids = [7 * i % 1000 for i in range(len(values))]
    sound = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for v in values]

    def linked(i, j):
        a, b = values[i], values[j]
        if i == j or not (sound[i] and sound[j]) or len(a) != len(b):
            return False
        a, b = np.array(a, float), np.array(b, float)
        return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)) >= 0.95

    n = len(values)
    near = [[linked(i, j) for j in range(n)] for i in range(n)]
    label = groups_of(n, lambda i, j: near[i][j])
    best = {}
    for i, c in zip(ids, label):
        best[c] = min(i, best.get(c, i))
    want = sorted((ids[i], sum(near[i]), best[label[i]], ids[i] == best[label[i]]) for i in range(n))
    got = embed_dedup.embedding_groups(embedding_frame(spark, list(zip(ids, values))), margin=1.0)
    assert sorted(map(tuple, got.collect())) == want
    # the default margin: nothing below the threshold, and nearly all above it
    got = {r.vec_id: r.n_links for r in embed_dedup.embedding_groups(embedding_frame(spark, list(zip(ids, values)))).collect()}
    assert all(got[i] <= w for i, w, _, _ in want) and sum(got.values()) >= 0.95 * sum(w[1] for w in want)


def test_embedding_group_larger_than_a_block(spark):
    rng = np.random.default_rng(2)
    x = np.ones((2500, 8)) + 0.02 * rng.normal(size=(2500, 8))
    got = embed_dedup.embedding_groups(embedding_frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(2499, 0)} and sum(r.kept for r in got) == 1


def test_embedding_links_across_borders_are_all_found(spark, monkeypatch):
    """Pairs at the threshold planted on both sides of borders, with the default margin, in many cells."""
    monkeypatch.setattr(embed_dedup, "block_rows", lambda dim: 60)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    across = rng.normal(size=x.shape)
    across -= (across * x).sum(axis=1)[:, None] * x
    across /= np.linalg.norm(across, axis=1)[:, None]
    x = np.concatenate((x, 0.9501 * x + np.sqrt(1 - 0.9501**2) * across))
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label, low = None, np.arange(len(x))
    while label is None or (low != label).any():
        label = low
        low = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embed_dedup.embedding_groups(frame).collect()
    want = [(i, int(near[i].sum()), int(label[i]), bool(label[i] == i)) for i in range(len(x))]
    assert sorted(map(tuple, got)) == want
    assert sorted(map(tuple, embed_dedup.embedding_groups(frame, margin=0.01).collect())) == want  # raised


def test_embedding_empty_table_and_null_id(spark):
    assert embed_dedup.embedding_groups(embedding_frame(spark, [])).count() == 0
    got = embed_dedup.embedding_groups(embedding_frame(spark, [(None, [1.0, 2.0]), (3, [1.0, 2.0])])).collect()
    assert sorted(map(str, got)) == sorted(["Row(vec_id=None, n_links=0, component_id=None, kept=False)",
                                            "Row(vec_id=3, n_links=0, component_id=3, kept=True)"])


def brute_removed(rows, m):
    """Per row: its bytes and which are covered, with every window of m bytes seen in order."""
    seen, out = set(), {}
    for i, doc, text in sorted(rows, key=lambda r: (r[1], r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - m + 1):
            w = data[p : p + m]
            if w in seen:
                gone[p : p + m] = True
            seen.add(w)
        out[i] = (doc, data, gone)
    return out


def check_repeats(spark, texts, m=100, **how):
    rows = [(i, d, t) for i, (d, t) in enumerate(texts)]
    want = []
    for doc, data, gone in brute_removed(rows, m).values():
        spans = int((np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        want.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    got = suffix_dedup.repeated_text(docs_frame(spark, texts).repartition(3, "doc_id"), m, **how)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in got.collect()]
    assert sorted(got) == sorted(want)
    return sorted(want)


def test_suffix_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    prose = lambda n: " ".join(rng.choice(["alpha", "béta", "gamma", "中文", "delta", "x"], n))
    passages = [prose(40) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(30)]
        for _ in range(int(rng.integers(0, 3))):
            parts += [passages[int(rng.integers(4))], prose(int(rng.integers(0, 20)))]
        texts.append((int(i * 37 % 101), "\n".join(parts)))
    texts += [(200, texts[0][1]), (201, texts[1][1][10:-10]), (202, "a" * 1000), (203, "ab" * 400), (204, "a" * 130),
              (205, "abcdefghij" * 60), (206, None), (207, ""), (208, "short"), (209, passages[0].encode()[3:].decode("utf-8", "ignore")),
              (210, "x" * 99), (211, "x" * 100), (212, "x" * 101), (213, "\x00" * 300), (214, "\x00" * 120 + "q")]
    want = check_repeats(spark, texts)
    assert sum(w[2] for w in want) > 5000


def test_suffix_dedup_splits_common_anchors(spark):
    """A 60-byte line in every text between different words, and a passage in many: blocks of a few runs."""
    rng = np.random.default_rng(4)
    line = "the same sixty bytes stand here in the middle of every text "
    word = lambda: bytes(rng.integers(97, 123, 45).astype(np.uint8)).decode()
    texts = [(i, word() + line + word() + (line * 3 if i % 4 == 0 else "") + word()) for i in range(80)]
    texts += [(100, None), (101, line * 2), (102, "z" * 400)]
    want = check_repeats(spark, texts)
    assert check_repeats(spark, texts, block_runs=5, sample=1) == want and sum(w[2] for w in want) > 2000


def test_suffix_dedup_with_several_blocks_a_bucket(spark, monkeypatch):
    """More blocks than buckets, several blocks of a partition; the catalog keeps no table."""
    assert suffix_dedup._n_buckets(200_000) < 100_000 and suffix_dedup._n_buckets(3) == 3
    monkeypatch.setattr(suffix_dedup, "MOST_BUCKETS", 2)
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(5)
    word = lambda: bytes(rng.integers(97, 123, 30).astype(np.uint8)).decode()
    passage = "".join(word() for _ in range(6))
    texts = [(i, word() + (passage if i % 3 else passage[20:150]) + word()) for i in range(50)]
    assert sum(w[2] for w in check_repeats(spark, texts)) > 2000
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix_texts_")]


def test_suffix_dedup_text_longer_than_a_piece(spark):
    rng = np.random.default_rng(9)
    noise = bytes(rng.integers(97, 123, suffix_dedup.PIECE + 3000).astype(np.uint8)).decode()
    at = suffix_dedup.PIECE
    got = suffix_dedup.repeated_text(docs_frame(spark, [(1, noise), (2, "?" + noise[at - 400 : at + 400] + "!")])).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in got) == [(1, 0, 0), (2, 800, 1)]


def test_suffix_dedup_empty_table_columns_and_null_id(spark):
    assert suffix_dedup.repeated_text(docs_frame(spark, [])).count() == 0
    text = "one two three four five six " * 6
    docs = docs_frame(spark, [(4, text), (None, text[:110])])
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns
    # the null id comes first; of text 4, all windows but those of its own first period repeat
    assert {(r.doc_id, r.fp, r.k) for r in got.collect()} == {(4, "x", 7), (None, "x", 7)}
    with pytest.raises(ValueError):
        suffix_dedup.repeated_text(docs, min_len=20)


def test_maximal_repeats_lists_all_occurrences():
    text = b"xabcdeyabcdezabcdqbcde"
    buf = np.frombuffer(text, np.uint8)
    starts = np.arange(len(text))
    before = np.concatenate(([-1], buf[:-1].astype(int)))
    found = {(text[starts[g[0]] : starts[g[0]] + n], tuple(sorted(starts[g].tolist()))) for n, g in
             suffix_dedup.maximal_repeats(buf, starts, np.full(len(text), len(text)), before, 3)}
    assert found == {(b"abcde", (1, 7)), (b"abcd", (1, 7, 13)), (b"bcde", (2, 8, 18))} | {
        f for f in found if f[0] == b"bcd"} and (b"bcd", (2, 8, 14, 18)) in found
