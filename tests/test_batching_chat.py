from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import batching, chat, collate, images, metrics
from helpers import py_tok

SCHEMA = "conv_id long, system string, image string, msgs array<struct<from:string,value:string>>"


def test_chunks_follow_rule_and_partition_megabatch(spark):
    lengths = spark.createDataFrame([(i, (i * 37) % 101 + 1) for i in range(70)], "conv_id long, length long")
    g = batching.length_grouped(lengths.withColumn("modality_length", F.col("length")), "conv_id", "length",
                                batch_size=4, world_size=2)
    rows = g.collect()
    assert sorted(r.conv_id for r in rows) == list(range(70))
    by_mb = {}
    for r in rows:
        by_mb.setdefault(r.mb, []).append(r)
    for rs in by_mb.values():
        by_rank = sorted(rs, key=lambda r: r.rank)
        assert [r.length for r in by_rank] == sorted((r.length for r in rs), reverse=True)
        share = {c: sorted((r for r in rs if r.chunk == c), key=lambda r: r.chunk_pos) for c in range(2)}
        assert [r.chunk_pos for c in share.values() for r in c] == [i for c in share.values() for i in range(len(c))]
        assert all([r.rank for r in c] == sorted(r.rank for r in c) for c in share.values())
        if len(rs) % 2:
            assert all((r.rank - 1) % 2 == r.chunk for r in rs)  # dealt in turn
            continue
        assert len(share[0]) == len(share[1])  # equal shares
        # a row went to the chunk that was lighter, while that chunk had room
        for r in by_rank:
            mine, other = ([x for x in share[c] if x.rank < r.rank] for c in (r.chunk, 1 - r.chunk))
            room = len(other) < len(share[0])
            weigh = lambda rows: sum(x.length for x in rows)
            assert not room or weigh(mine) < weigh(other) or (weigh(mine) == weigh(other) and r.chunk == 0)


def test_chunks_golden(spark):
    """Lengths 9 8 7 2: 9 | 8, then 7 to the lighter (8), then 2 to the one with room."""
    lengths = spark.createDataFrame([(i, n) for i, n in enumerate([7, 2, 9, 8])], "conv_id long, length long")
    rows = batching.length_grouped(lengths, "conv_id", "length", batch_size=2, world_size=2).collect()
    assert sorted((r.chunk, r.chunk_pos, r.length) for r in rows) == [(0, 0, 9), (0, 1, 2), (1, 0, 8), (1, 1, 7)]


def test_modality_batches_cover_all(spark):
    rows = [(i, (i % 13 + 1) * (1 if i % 3 == 0 else -1)) for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, modality_length long")
    out = batching.modality_batches(df, "conv_id", batch_size=2, world_size=2).collect()
    assert sorted(r.conv_id for r in out) == list(range(50))
    last = max(r.batch_no for r in out)
    tail = sorted((r for r in out if r.batch_no == last), key=lambda r: r.pos)
    assert [r.conv_id for r in tail] == sorted(r.conv_id for r in tail)  # merged tail sorted by index


def _pairs(*p):
    return [{"from": f, "value": v} for f, v in p]


def test_history_trim_keeps_the_longest_tail_that_fits(spark):
    msgs = _pairs(("human", "a" * 40), ("gpt", "b" * 50), ("human", "c" * 30), ("gpt", "d" * 60),
                  ("human", "e" * 20), ("gpt", "f"))
    tails = spark.createDataFrame([(k, "sys", None, msgs[2 * k:]) for k in range(3)], SCHEMA)
    whole = {r.conv_id: r for r in chat.trim_history(chat.chat_history(tails), 10**6).collect()}
    assert all(r.start_pair == 0 and r.n_tokens == len(py_tok(r.prompt)) for r in whole.values())
    assert whole[2].prompt == "[INST] <<SYS>>\nsys\n<</SYS>>\n\n" + "e" * 20 + " [/INST]"
    assert whole[1].prompt == ("[INST] <<SYS>>\nsys\n<</SYS>>\n\n" + "c" * 30 + " [/INST] " + "d" * 60 + "</s><s>[INST] "
                               + "e" * 20 + " [/INST]")
    one = chat.chat_history(spark.createDataFrame([(1, "sys", None, msgs)], SCHEMA))
    sizes = [whole[k].n_tokens for k in range(3)]
    assert sizes == sorted(sizes, reverse=True)
    for budget in {1, *(n + d for n in sizes for d in (-1, 0, 1))}:
        got = chat.trim_history(one, budget).first()
        fits = [k for k in range(3) if sizes[k] <= budget]
        assert got.start_pair == (fits[0] if fits else 2)  # the last pair stays whatever its size
        assert (got.prompt, got.n_tokens) == (whole[got.start_pair].prompt, sizes[got.start_pair])


def test_default_system_prompt(spark):
    df = spark.createDataFrame([(1, "", None, _pairs(("human", "q")))], SCHEMA)
    r = chat.chat_history(df).first()
    assert r.system == K.CHAT_DEFAULT_SYSTEM_PROMPT


def test_collate_pad_and_fault(spark):
    df = spark.createDataFrame([(0, 0, [1, 5, 6], [-100, 5, 6]), (0, 1, [1, 7], [-100, 7]), (1, 0, [1], [1])],
                               "batch_id long, pos long, input_ids array<int>, labels array<int>")
    p = {(r.batch_id, r.pos): r for r in collate.collate_pad(df, 9).collect()}
    assert p[(0, 1)].input_ids == [1, 7, 9] and p[(0, 1)].labels == [-100, 7, -100]
    assert p[(0, 1)].attention_mask == [True, True, False]
    f = {(r.batch_id, r.pos): r for r in collate.collate_fault_tolerant(df, ["input_ids", "labels"]).collect()}
    assert f[(0, 1)].ragged and f[(0, 1)].input_ids == [1, 5, 6]  # every row repeats the first
    assert not f[(1, 0)].ragged


def test_image_geometry(spark):
    df = spark.createDataFrame([(1, 100, 100, "Pad"), (2, 3000, 1000, "Default"), (3, 500, 2000, "Pad"),
                                (4, 800, 600, "Resize"), (5, 1400, 1400, "Crop")], "k long, w long, h long, mode string")
    g = {r.k: r for r in images.process_geometry(images.pad_to_square(df)).collect()}
    assert (g[1].side, g[1].offset_x, g[1].offset_y) == (100, 0, 0)
    assert (g[3].side, g[3].offset_x, g[3].offset_y) == (2000, 750, 0)
    # 3000x1000: ratio 3 -> shortest int(min(448, 672, 1000)) = 448, longest 1344
    assert (g[2].out_w, g[2].out_h) == (1344, 448)
    assert (g[4].out_w, g[4].out_h) == (336, 336)
    assert (g[5].out_w, g[5].out_h) == (672, 672)


def test_image_expansion_counts(spark):
    img, pad = K.IMAGE_TOKEN_ID, K.PAD_ID
    df = spark.createDataFrame([(0, 0, [1, img, 5, 6], [-100, -100, 5, 6]), (0, 1, [1, 7, pad, pad], [-100, 7, -100, -100])],
                               "batch_id long, pos long, input_ids array<int>, labels array<int>")
    out = {r.pos: r for r in images.expand_image_tokens(df, 3).collect()}
    assert out[0].max_embed_dim == 2 + 4 and not out[0].left_padding
    assert out[0].final_labels == [-100, -100, -100, -100, 5, 6]
    assert len(out[1].final_labels) == 6


def test_metrics(spark):
    import math

    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1), ([0.0, 0.0, 5.0], -100)], "s array<double>, label int")
    assert [r[0] for r in df.select(metrics.argmax(F.col("s"))).collect()] == [1, 2]
    loss = metrics.masked_loss(df, "s", "label").first()
    exp = -math.log(math.exp(3) / (math.exp(1) + 2 * math.exp(3)))
    assert abs(loss.loss - exp) < 1e-12 and loss.n_tokens == 1
    acc = metrics.token_accuracy(spark.createDataFrame([([1, 2, 3], [0, 1, 2])], "p array<int>, l array<int>"),
                                 "p", "l").first()
    assert acc.accuracy == 1.0 and acc.n_positions == 2


def test_sampler_order_choices(spark):
    rows = [(i, (i % 9 + 1), (i % 9 + 1) * (1 if i % 2 else -1)) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, length long, modality_length long")
    for grouped in (True, False):
        out = batching.sampler_order(df, "conv_id", batch_size=2, world_size=2, grad_accum=2,
                                     group_by_modality=grouped).collect()
        assert sorted(r.conv_id for r in out) == list(range(40))
        assert len({(r.batch_no, r.pos) for r in out}) == 40


def test_image_count_check_refuses_a_batch(spark):
    img = K.IMAGE_TOKEN_ID
    df = spark.createDataFrame([(0, [1, img, 5], 1), (0, [1, img, img], 2), (1, [1, 7, 7], 1)],
                               "batch_id long, input_ids array<int>, n_given long")
    got = {r.batch_id: (r.n_image_tokens, r.n_given, r.count_ok) for r in images.image_count_check(df).collect()}
    assert got == {0: (3, 3, True), 1: (0, 1, False)}


def test_plain_sampler_ignores_lengths(spark):
    order = lambda f: sorted(map(tuple, batching.sampler_order(spark.createDataFrame(
        [(i, f(i), f(i)) for i in range(30)], "conv_id long, length long, modality_length long"), "conv_id", 2, 2,
        group_by_modality=False).collect()))
    assert order(lambda i: i) == order(lambda i: 100 - i)
    assert sorted((b, p) for _, b, p in order(lambda i: i)) == [(i // 4, i % 4) for i in range(30)]


def test_shifted_loss_counts_only_seen_next_positions(spark):
    rows = [(0, 0, [0.0, 0.0], 0, 1), (0, 1, [5.0, 0.0], 1, 1), (0, 2, [0.0, 9.0], 0, 0), (1, 0, [1.0, 1.0], 1, 1)]
    df = spark.createDataFrame(rows, "seq long, pos long, scores array<double>, label int, mask int")
    out = metrics.shifted_loss(df, "seq", "pos", "scores", "label", "mask").first()
    # only position 0 of sequence 0 has a seen successor: label 1 under even scores
    assert out.n_tokens == 1 and abs(out.loss - 0.6931471805599453) < 1e-12


def test_image_expand_plan_has_every_slot(spark, tmpdir_path):
    """labels, attention and position ids slot by slot; the runs of the same rows cover the same slots."""
    from corpusloom.plans import extras

    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t}" * (1 + c)) for c in range(6) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    plan = extras.image_expand_plan(spark, tmpdir_path).collect()
    assert sorted((r.batch_id, r.pos) for r in plan) == [(i // 4, i % 4) for i in range(6)]
    attended = {}
    for r in extras.image_expand_runs(spark, tmpdir_path).collect():
        attended.setdefault((r.batch_id, r.pos), [None] * r.max_embed_dim)[r.start:r.start + r.length] = [int(r.attended)] * r.length
    for r in plan:
        slots = [x.split(",") for x in (r.final_labels, r.final_attention, r.position_ids)]
        assert [len(x) for x in slots] == [r.max_embed_dim] * 3
        assert list(map(int, slots[1])) == attended[r.batch_id, r.pos]
        seen = 0
        for on, position in zip(slots[1], slots[2]):
            assert int(position) == (seen if on == "1" else 1)
            seen += on == "1"
        assert r.n_images == (1 if (4 * r.batch_id + r.pos) % 3 == 0 else 0)
        assert r.count_ok
