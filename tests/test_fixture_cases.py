"""Remaining fixture cases of FIXTURES.md."""

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import batching, chat, collate, dialogue, images, metrics, tokenize, vocab
from helpers import py_tok

SCHEMA = "conv_id long, system string, image string, msgs array<struct<from:string,value:string>>"
IMG, PAD = K.IMAGE_TOKEN_ID, K.PAD_ID


def test_image_mark_twice(spark):
    df = spark.createDataFrame([(1, None, "x.jpg", [{"from": "human", "value": "a <image> b <image>"}])], SCHEMA)
    out = dialogue.normalise_image_placeholder(df).first().msgs[0]["value"]
    assert out == "<image>\na  b"
    t = tokenize.tokenize_image_text(spark.createDataFrame([("x<image>y<image>z",)], "p string"), "p").first()
    assert t.input_ids == [1, ord("x") + 3, IMG, ord("y") + 3, IMG, ord("z") + 3]


def test_vocab_all_present(spark):
    base = vocab.specials_frame(spark).unionByName(
        spark.createDataFrame([(3, "a", 2.0), (4, "b", 1.0)], "id int, piece string, score double"))
    ext = vocab.specials_frame(spark).unionByName(spark.createDataFrame([(3, "b", 5.0)], "id int, piece string, score double"))
    merged = vocab.merge_vocab(base, ext)
    assert [(r.id, r.piece) for r in merged.orderBy("id").collect()] == [(0, "<unk>"), (1, "<s>"), (2, "</s>"),
                                                                         (3, "a"), (4, "b")]


def test_single_modality_sorts_raw_signed_lengths(spark):
    rows = [(i, -(i % 7 + 1)) for i in range(24)]
    df = spark.createDataFrame(rows, "conv_id long, modality_length long")
    out = batching.modality_batches(df, "conv_id", batch_size=4, world_size=1).collect()
    by = {}
    for r in out:
        by.setdefault(r.batch_no, []).append(r)
    lens = dict(rows)
    for rs in by.values():
        seq = [lens[r.conv_id] for r in sorted(rs, key=lambda r: r.pos)]
        assert seq == sorted(seq, reverse=True)  # signed order: shortest text first
    assert sorted(r.conv_id for r in out) == list(range(24))


def test_pad_id_inside_text_is_masked(spark):
    df = spark.createDataFrame([(0, 0, [1, 9, 5], [-100, 9, 5])], "batch_id long, pos long, input_ids array<int>, labels array<int>")
    assert collate.collate_pad(df, 9).first().attention_mask == [True, False, True]


def _expand(spark, rows, p):
    df = spark.createDataFrame(rows, "batch_id long, pos long, input_ids array<int>, labels array<int>")
    return {r.pos: r for r in images.expand_image_tokens(df, p).collect()}


def test_expand_two_images_right_padded(spark):
    out = _expand(spark, [(0, 0, [1, IMG, 5, IMG], [-100, -100, 5, -100]), (0, 1, [1, 7, PAD, PAD], [-100, 7, -100, -100])], 2)
    a, b = out[0], out[1]
    assert (a.max_embed_dim, a.left_padding, a.nb_image_pad, a.n_images) == (6, False, 0, 2)
    assert a.final_labels == [-100, -100, -100, 5, -100, -100] and a.final_attention == [1] * 6
    assert a.position_ids == [0, 1, 2, 3, 4, 5]
    assert b.nb_image_pad == 2 and b.final_labels == [-100, 7, -100, -100, -100, -100]
    assert b.final_attention == [1, 1, 0, 0, 0, 0] and b.position_ids == [0, 1, 1, 1, 1, 1]


def test_expand_unpadded_batch_counts_as_left_padded(spark):
    out = _expand(spark, [(0, 0, [1, IMG, 5], [-100, -100, 5]), (0, 1, [1, 6, 7], [-100, 6, 7])], 3)
    a, b = out[0], out[1]
    assert a.left_padding and b.left_padding and a.max_embed_dim == 5
    assert a.final_labels == [-100, -100, -100, -100, 5]
    assert b.nb_image_pad == 2 and b.final_labels == [-100, -100, -100, 6, 7]
    assert b.final_attention == [0, 0, 1, 1, 1] and b.position_ids == [1, 1, 0, 1, 2]
    none = _expand(spark, [(0, 0, [1, 5, 6], [-100, 5, 6])], 3)[0]
    assert none.n_images == 0 and none.final_labels == [-100, 5, 6]


def test_perplexity_overflow(spark):
    r = spark.range(1).select(metrics.perplexity(F.lit(1000.0)).alias("p")).first()
    assert r.p == float("inf")


def test_trim_exact_budget(spark):
    msgs = [{"from": "human", "value": "q" * 30}, {"from": "gpt", "value": "a" * 30},
            {"from": "human", "value": "r" * 10}]
    df = spark.createDataFrame([(1, "s", None, msgs)], SCHEMA)
    hist = chat.chat_history(df)
    full = ("[INST] <<SYS>>\ns\n<</SYS>>\n\n" + "q" * 30 + " [/INST] " + "a" * 30 + "</s><s>[INST] " + "r" * 10 + " [/INST]")
    n = len(py_tok(full))
    assert chat.trim_history(hist, n).first().start_pair == 0
    assert chat.trim_history(hist, n - 1).first().start_pair == 1
