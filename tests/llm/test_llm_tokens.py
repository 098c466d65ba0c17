"""Byte-level BPE, packing and token counts against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import bpe, packing, token_counts
from corpusloom.llm.segments import SegmentCache, encode_joined, segments

RANKS = P.path("byte_bpe_50k.tiktoken")
ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
TEXTS = ["Hello world, it's 2024!", "", None, "  two  spaces \n\n and\ttabs \r\n", "naïve café 中文字 🙂🙂", "<|endoftext|> is text",
         "a" * 5000, "ab " * 3000, " " * 700 + "x", "\x1c!\x1c x\xa0 y　z", "\n", " ", "x" * 191 + "é", "don't we'll I'D", "1234567890" * 50,
         "".join(random.Random(4).choice("abcdefgh") for _ in range(900)), "Hello world, it's 2024!"]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, 1, "q", b"z") for i, t in enumerate(texts)], "doc_id long, text string, part int, n string, ids binary")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1!é \n\t\x1c\xa0 '　sL中\r", max_size=24))
def test_segments_are_independent(text):
    cut = segments(text)
    split = regex.compile(P.PATTERN).findall
    assert "".join(cut) == text and [p for s in cut for p in split(s)] == split(text)


def test_joined_segments_are_parted_again():
    rng = random.Random(7)
    some = list({"".join(rng.choice("ab1!é \n\t\x1c\xa0 '　sL中") for _ in range(rng.randint(1, 9))) for _ in range(3000)})
    some = list({s for t in some for s in segments(t)})
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        size[i] = len(token)
    got = encode_joined(some, lambda texts: [coder.encode_ordinary(t) for t in texts], size, "<u4", at_once=50)
    assert got == [np.array(coder.encode_ordinary(s), "<u4").tobytes() for s in some]


def library_bytes(texts):
    return [np.array(coder.encode_ordinary(t), "<u4").tobytes() for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab1!é,.' \n\t\x1c\xa0²ªʰсĳ　sL中\r", max_size=24), min_size=1, max_size=6))
def test_joined_values_are_the_texts(texts):
    cache = SegmentCache(library_bytes, 40)
    for some in (texts, texts[::-1], texts):  # the second and third time from the cache
        assert cache.joined(some, b"end.").to_pylist() == [x + b"end." for x in library_bytes(some)]
    assert cache.joined(texts).to_pylist() == library_bytes(texts)
    assert cache.joined([""]).to_pylist() == [b""]


def test_joined_after_every_character():
    """Punctuation may be cut off after whatever the library takes for a letter or a digit, and after nothing else."""
    t = Tokenizer.from_file(packing.tokenizer_path())
    texts = [f"x a{chr(c)}.), b{chr(c)}'s," for c in range(0x3100)]
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert packing._json_cache(packing.tokenizer_path()).joined(texts).to_pylist() == want


def test_a_word_is_encoded_once_whatever_punctuation_follows():
    seen = []

    def encode(some):
        seen.extend(some)
        return library_bytes(some)

    cache = SegmentCache(encode, 1000)
    texts = ["One word, two words. word; a word! (word) 3.5, 3.5", "And word: word\nword,", "odd  word,"]
    assert cache.joined(texts).to_pylist() == library_bytes(texts)
    assert seen.count(" word") == 1 and seen.count(" 3.5") == 1 and not {" word,", " word;", " word!", " word:", " 3.5,"} & set(seen)


def test_pieces_contract_as_the_library_does():
    rng = random.Random(2)
    pieces = list({"".join(rng.choice("theandingéß123中 ") for _ in range(rng.randint(1, 40))) for _ in range(1500)})
    pieces += ["a" * 192, "a" * 193, "abc" * 200, "é" * 150]
    one = bpe.PieceCoder(RANKS, P.PATTERN)
    for piece, (n, line, back) in zip(pieces, one.code(pieces)):
        ids = list(map(int, line.split()))
        assert n == len(ids) and ids == coder._encode_single_piece(piece) and back == piece.encode()
        if len(piece.encode()) > 1:
            assert one._long(piece.encode()) == ids  # the heap's order is the recursion's


def test_bpe_equals_the_library(spark):
    got = {r.doc_id: r for r in bpe.bpe_round_trip(docs(spark), RANKS, P.PATTERN).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = coder.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and bytes(got[i].decoded) == (t or "").encode()
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.bpe_round_trip(docs(spark, []), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("length", [7, 64, 2048])
def test_packing(spark, length):
    path = packing.tokenizer_path()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for i, x in enumerate(TEXTS)}
    total = sum(map(len, want.values()))
    pieces = packing.pack(docs(spark).repartition(3), path, length)
    rows = pieces.collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        assert bytes(r.ids) == want[r.doc_id][r.start : r.start + r.length].tobytes() and r.doc_tokens == len(want[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens, r.padded_tokens))
    for i, spans in by_doc.items():
        assert [s for s, _ in sorted(spans)] == np.cumsum([0] + [n for _, n in sorted(spans)])[:-1].tolist()
        assert sum(n for _, n in spans) == len(want[i])
    assert sorted(by_seq) == list(range(-(-total // length))) and set(by_doc) == set(want)
    for s, spans in by_seq.items():
        spans.sort()
        used = sum(x[1] for x in spans)
        assert [x[0] for x in spans] == np.cumsum([0] + [x[1] for x in spans])[:-1].tolist()
        assert used == (length if s < max(by_seq) else total - length * max(by_seq))
        assert {x[2:] for x in spans} == {(used, used if used & (used - 1) == 0 else length)}
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.op6_columns(pieces).collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
    packed = {r.sequence_id: r.ids for r in packing.packed_sequences(pieces, pad_id=9).collect()}
    assert sum(map(len, packed.values())) == sum({s: x[0][3] for s, x in by_seq.items()}.values())


def test_packing_empty_table(spark):
    assert packing.pack(docs(spark, []), packing.tokenizer_path()).count() == 0


def test_token_counts_of_written_files(spark, tmpdir_path):
    path = f"{tmpdir_path}/flat"
    token_counts.write_token_files(docs(spark).repartition(2), path, RANKS, P.PATTERN)
    want = sorted(len(coder.encode_ordinary(t or "")) for t in TEXTS)
    for block in (1, 5, 1000, 1 << 20):
        rows = token_counts.count_tokens(spark, path, block=block).collect()
        assert sorted(r.n_tokens for r in rows) == want and all(r.ended for r in rows)


def test_token_counts_stitch_blocks(spark, tmpdir_path):
    """Documents over several blocks, empty documents, a tail without separator, an empty file."""
    ids = np.array([5, 9, 5, 5, 5, 5, 5, 5, 9, 9, 1, 2], "<u2")
    ids.tofile(f"{tmpdir_path}/a.bin")
    ids[:10].tofile(f"{tmpdir_path}/b.bin")
    ids[:0].tofile(f"{tmpdir_path}/c.bin")
    for block in (1, 2, 3, 4, 50):
        rows = sorted(map(tuple, token_counts.count_tokens(spark, tmpdir_path, end_id=9, block=block).collect()))
        a = [("a.bin", 0, 0, 1, True), ("a.bin", 1, 2, 6, True), ("a.bin", 2, 9, 0, True), ("a.bin", 3, 10, 2, False)]
        assert rows == a + [("b.bin", *r[1:]) for r in a[:3]]
    np.array([1, 2, 3], np.uint8).tofile(f"{tmpdir_path}/d.bin")
    with pytest.raises(Exception, match="no whole number of ids"):
        token_counts.count_tokens(spark, tmpdir_path).count()


def test_token_counts_empty_table(spark, tmpdir_path):
    token_counts.write_token_files(docs(spark, []), f"{tmpdir_path}/none", RANKS, P.PATTERN)
    assert token_counts.count_tokens(spark, f"{tmpdir_path}/none").count() == 0
