"""Message-level dialogue forms equal the record forms, also when a conversation spans many buckets."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import dialogue, masks, render, turns

TURNS = "conv_id long, turn long, role string, text string"


def _turn_rows():
    rows = []
    # 1: plain exchange with a system turn
    rows += [(1, 0, "system", "Be brief."), (1, 1, "user", "hi"), (1, 2, "assistant", "yo")]
    # 2: starts with the assistant (dropped), separator strings inside the texts
    rows += [(2, 0, "assistant", "first"), (2, 1, "user", "a [/INST] b"), (2, 2, "assistant", "c </s> d"),
             (2, 3, "user", "e"), (2, 4, "assistant", "f")]
    # 3: image conversation (3 % 3 == 0), '<image>' already in the text, ends on a user turn
    rows += [(3, 0, "user", "look <image> here"), (3, 1, "assistant", "ok"), (3, 2, "user", "and?")]
    # 4: empty answer in the middle, '<pad>' inside a message
    rows += [(4, 0, "user", "q1"), (4, 1, "assistant", ""), (4, 2, "user", "q2 <pad> x"), (4, 3, "assistant", "a2")]
    # 5: system only
    rows += [(5, 0, "system", "alone")]
    # 7: a long conversation, past the 2048-token cut, turns not dense
    for t in range(40):
        role = "user" if t % 2 == 0 else "assistant"
        rows.append((7, 10 * t + 3, role, f"{role} turn {t} " + "x" * (60 + t)))
    # 8: long with '[/INST] ' crossing into the next message and a late separator
    for t in range(30):
        role = "user" if t % 2 == 0 else "assistant"
        txt = f"m{t} " + "y" * 90
        if t == 21:
            txt += " [/INST] inside"
        rows.append((8, t, role, txt))
    # 9: image conversation, long (not cut)
    for t in range(24):
        rows.append((9, t, "user" if t % 2 == 0 else "assistant", "z" * 130 + str(t)))
    return rows


def _records(spark):
    df = spark.createDataFrame(_turn_rows(), TURNS)
    recs = dialogue.records_from_turns(df)
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    recs = dialogue.attach_image(recs, has_img, F.lit("x.jpg"))
    return df, dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(recs))


@pytest.fixture(params=[turns.BUCKET_ROWS, 3], ids=["one-bucket", "bucket-3"])
def bucket(request, monkeypatch):
    monkeypatch.setattr(turns, "BUCKET_ROWS", request.param)
    return request.param


@pytest.mark.parametrize("name", ["llama_2", "llama_3", "v1", "mpt", "plain", "llava_v0"])
def test_pieces_concatenate_to_prompt(spark, bucket, name):
    df, recs = _records(spark)
    want = {r.conv_id: r.prompt for r in render.render(recs, name).collect()}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    pieces = turns.render_pieces(msgs, convs, name).collect()
    got = {}
    for r in sorted(pieces, key=lambda r: (r.conv_id, r.pos)):
        got[r.conv_id] = got.get(r.conv_id, "") + (r.piece or "")
    assert got == want


@pytest.mark.parametrize("family,legacy", [("llama_2", True), ("llama_3", False), ("llama_3", True),
                                           ("default", True), ("default", False)])
def test_mask_from_pieces_equals_record_mask(spark, bucket, family, legacy):
    df, recs = _records(spark)
    rec = masks.mask_dialogues(recs, family, 2048, legacy).collect()
    want = {r.conv_id: (len(r.input_ids), r.n_supervised, r.status) for r in rec}
    want_pos = {r.conv_id: {j for j, x in enumerate(r.labels) if x != K.IGNORE_INDEX} for r in rec}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    summary, segments = turns.mask_messages(msgs, convs, family, 2048, legacy)
    got = {r.conv_id: (r.n_tokens, r.n_supervised, r.status) for r in summary.collect()}
    assert got == want
    got_pos = {k: set() for k in want_pos}
    for s in segments.collect():
        got_pos[s.conv_id] |= set(range(s.lo, s.hi))
    assert got_pos == want_pos
    # the fixture reaches the cut, the mismatch rule and both image / text rows
    assert any(v[0] == 2048 for v in want.values()) and any(v[2] == "mismatch" for v in want.values())


def test_templates_without_a_checked_cut_are_refused():
    with pytest.raises(ValueError):
        turns._check_template("mpt", "<|im_end|>", "<|im_start|>assistant\n")


def test_segmented_scan_and_spread_back(spark, bucket):
    rows = [(k, g, g % 5, None if g % 4 else f"h{g}") for k, n in ((1, 11), (2, 1), (3, 7)) for g in range(n)]
    df = spark.createDataFrame(rows, "k long, g long, v long, h string")
    out = {(r.k, r.g): (r.v_before, r.h_next) for r in turns.segmented_scan(df, "k", "g", ["v"], "h").collect()}
    for k, g, _, _ in rows:
        mine = [r for r in rows if r[0] == k]
        before = sum(r[2] for r in mine if r[1] < g)
        nxt = next((r[3] for r in sorted(mine, key=lambda r: r[1]) if r[1] > g and r[3] is not None), None)
        assert out[(k, g)] == (before, nxt)
    per_key = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, tag string")
    back = turns.spread_back(df.withColumn("_b", F.floor(F.col("g") / bucket)), "k", "_b", per_key)
    assert back.count() == len(rows) and {(r.k, r.tag) for r in back.collect()} == {(1, "a"), (2, "b"), (3, "c")}


@pytest.mark.parametrize("budget", [60, 300, 1024])
def test_history_trim_at_pair_level(spark, bucket, budget):
    from corpusloom.operators import chat

    df, recs = _records(spark)
    want = {tuple(r) for r in chat.trim_history(chat.chat_history(recs), budget).collect()}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    got = {tuple(r) for r in turns.trim_history_messages(msgs, convs, budget).collect()}
    assert got == want
    # some chats are cut; with the smallest budget a chat whose last pair alone is over it keeps that pair
    assert any(r[1] > 0 for r in want)
    if budget == 60:
        assert any(r[2] == 1 and r[3] > budget for r in want)


def test_chat_prompt_pieces_concatenate_to_prompt(spark, bucket):
    from corpusloom.operators import chat

    df, recs = _records(spark)
    h = chat.chat_history(recs)
    want = {r.conv_id: r.p for r in h.select("conv_id", chat.multi_turn_prompt(F.col("pairs"), F.col("system"))
                                               .alias("p")).collect()}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    got = {}
    for r in sorted(turns.chat_prompt_pieces(msgs, convs).collect(), key=lambda r: (r.conv_id, r.pair_no)):
        got[r.conv_id] = got.get(r.conv_id, "") + r.piece
    assert got == want


def test_image_tokens_per_piece_concatenate_to_prompt_ids(spark, bucket):
    from corpusloom.operators.tokenize import tokenize_image_text

    df, recs = _records(spark)
    want = {r.conv_id: list(r.input_ids) for r in tokenize_image_text(render.render(recs, "llama_2"), "prompt")
            .collect()}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    t = tokenize_image_text(turns.render_pieces(msgs, convs, "llama_2"), "piece", bos=F.col("pos") == -1)
    got = {}
    for r in sorted(t.collect(), key=lambda r: (r.conv_id, r.pos)):
        got.setdefault(r.conv_id, []).extend(r.input_ids)
    assert got == want and any(K.IMAGE_TOKEN_ID in v for v in want.values())


@pytest.mark.parametrize("name,mmtag,fewshot,stage", [("v1_mmtag", True, False, "raw"), ("v1", True, False, "raw"),
                                                     ("v0", False, True, "clean")])
def test_mmtag_and_fewshot_pieces(spark, bucket, name, mmtag, fewshot, stage):
    df, clean = _records(spark)
    raw = dialogue.attach_image(dialogue.records_from_turns(df), F.pmod(F.col("conv_id"), F.lit(3)) == 0,
                                F.lit("x.jpg"))
    recs = raw if stage == "raw" else clean
    want = {r.conv_id: r.prompt for r in render.render(recs, name, mmtag=mmtag, fewshot=fewshot).collect()}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0, stage=stage)
    m = turns.template_messages(msgs, convs, name, mmtag=mmtag, fewshot=fewshot)
    got = {}
    for r in sorted(turns.render_pieces(m, convs, name).collect(), key=lambda r: (r.conv_id, r.pos)):
        got[r.conv_id] = got.get(r.conv_id, "") + (r.piece or "")
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.booleans()), min_size=1, max_size=60),
       st.sampled_from([1, 2, 5, 1 << 16]))
def test_segmented_scan_property(spark, rows, bucket_rows):
    """Exclusive running sums and next non-null value per key, against their definition, for any bucket size."""
    old = turns.BUCKET_ROWS
    turns.BUCKET_ROWS = bucket_rows
    try:
        data = [(k, 3 * i + k, v, f"h{i}" if keep else None) for i, (k, v, keep) in enumerate(rows)]
        df = spark.createDataFrame(data, "k long, g long, v long, h string")
        got = {(r.k, r.g): (r.v_before, r.h_next) for r in turns.segmented_scan(df, "k", "g", ["v"], "h").collect()}
    finally:
        turns.BUCKET_ROWS = old
    for k, g, _, _ in data:
        mine = sorted((r for r in data if r[0] == k), key=lambda r: r[1])
        before = sum(r[2] for r in mine if r[1] < g)
        nxt = next((r[3] for r in mine if r[1] > g and r[3] is not None), None)
        assert got[(k, g)] == (before, nxt)


@pytest.mark.parametrize("family,legacy,keep", [("llama_2", True, None), ("llama_3", False, None),
                                                ("default", True, None), ("llama_2", True, 2048),
                                                ("default", False, 300)])
def test_training_rows_equal_record_rows(spark, bucket, family, legacy, keep):
    df, recs = _records(spark)
    rec = masks.mask_dialogues(recs, family, 2048, legacy).collect()
    cut = (lambda a: a) if keep is None else (lambda a: a[:keep])
    want = {r.conv_id: (cut(list(r.input_ids)), cut(list(r.labels))) for r in rec}
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    rows = turns.training_rows(msgs, convs, family, 2048, legacy, keep_tokens=keep).collect()
    got = {r.conv_id: (list(r.input_ids), list(r.labels)) for r in rows}
    assert got == want
    # image rows longer than the cut exist, so both the uncut and the cut paths are exercised
    assert any(len(v[0]) > 2048 for v in want.values()) or keep is not None


def test_message_level_tables_equal_record_tables_on_odd_inputs(spark):
    from corpusloom.operators import batching, chat

    rows = _turn_rows() + [
        # an unknown role keeps its name; negative and sparse turn numbers
        (10, -7, "user", "q"), (10, -3, "tool", "t"), (10, 40, "assistant", "a"), (10, 41, "user", "q2"),
        # image conversation with only a system turn
        (12, 0, "system", "s"),
        # a null text
        (13, 0, "user", None), (13, 1, "assistant", "x"),
    ]
    df = spark.createDataFrame(rows, TURNS)
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    raw = dialogue.attach_image(dialogue.records_from_turns(df), has_img, F.lit("x.jpg"))
    clean = dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(raw))
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)

    def exploded(recs):
        return {(r.conv_id, p, m["from"], m["value"]) for r in recs.collect() for p, m in enumerate(r.msgs)}

    assert {(r.conv_id, r.pos, r["from"], r.value) for r in msgs.collect()} == exploded(clean)
    raw_msgs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0, stage="raw")[0]
    assert {(r.conv_id, r.pos, r["from"], r.value) for r in raw_msgs.collect()} == exploded(raw)
    want_pairs = {tuple(r) for r in dialogue.turn_pairs(clean).select("conv_id", "pair_no", "user", "assistant",
                                                                      "system").collect()}
    got_pairs = {tuple(r) for r in turns.message_pairs(msgs, convs).select("conv_id", "pair_no", "user", "assistant",
                                                                           "system").collect()}
    assert got_pairs == want_pairs
    want_len = {tuple(r) for r in batching.dialogue_lengths(raw).select("conv_id", "length").collect()}
    words = turns.conversation_word_counts(*turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0,
                                                                        stage="raw"))
    got_len = {tuple(r) for r in batching.lengths_from_words(words).select("conv_id", "length").collect()}
    # a null text is invalid input: it counts as no words here (as in the SQL oracle), null in the record form
    assert {r for r in got_len if r[0] != 13} == {r for r in want_len if r[0] != 13}
    assert (13, 1) in got_len and (13, None) in want_len
    want_trim = {tuple(r) for r in chat.trim_history(chat.chat_history(clean), 200).collect()}
    assert {tuple(r) for r in turns.trim_history_messages(msgs, convs, 200).collect()} == want_trim


@pytest.mark.parametrize("family,legacy", [("llama_2", True), ("default", False)])
def test_masks_on_odd_inputs(spark, family, legacy):
    rows = _turn_rows() + [(10, -7, "user", "q"), (10, -3, "tool", "t"), (10, 40, "assistant", "a"),
                           (10, 41, "user", "q2"), (12, 0, "system", "s"), (14, 0, "user", ""), (14, 1, "assistant", "")]
    df = spark.createDataFrame(rows, TURNS)
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    raw = dialogue.attach_image(dialogue.records_from_turns(df), has_img, F.lit("x.jpg"))
    clean = dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(raw))
    rec = masks.mask_dialogues(clean, family, 2048, legacy).collect()
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    summary = turns.mask_messages(msgs, convs, family, 2048, legacy)[0]
    assert {(r.conv_id, r.n_tokens, r.n_supervised, r.status) for r in summary.collect()} == \
        {(r.conv_id, len(r.input_ids), r.n_supervised, r.status) for r in rec}
    rows_ = turns.training_rows(msgs, convs, family, 2048, legacy).collect()
    assert {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in rows_} == \
        {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in rec}


def test_hot_conversation_across_many_buckets(spark, monkeypatch):
    """One conversation with most of the turns, spread over ~30 buckets of 64 messages."""
    from corpusloom.operators import chat

    monkeypatch.setattr(turns, "BUCKET_ROWS", 64)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t} " + ("[/INST] " if t % 97 == 5 else "") + "w" * (t % 7))
            for t in range(2000)]
    rows += [(k, t, "user" if t % 2 == 0 else "assistant", f"s{k}.{t}") for k in (2, 3, 4) for t in range(4)]
    df = spark.createDataFrame(rows, TURNS)
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    clean = dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(
        dialogue.attach_image(dialogue.records_from_turns(df), has_img, F.lit("x.jpg"))))
    msgs, convs = turns.conversation_messages(df, lambda k: F.pmod(k, F.lit(3)) == 0)
    assert msgs.filter(F.col("conv_id") == 1).select("_b").distinct().count() >= 30
    want = {r.conv_id: r.prompt for r in render.render(clean, "llama_2").collect()}
    got = {}
    for r in sorted(turns.render_pieces(msgs, convs, "llama_2").collect(), key=lambda r: (r.conv_id, r.pos)):
        got[r.conv_id] = got.get(r.conv_id, "") + r.piece
    assert got == want
    rec = masks.mask_dialogues(clean, "llama_2", 2048).collect()
    summary = turns.mask_messages(msgs, convs, "llama_2", 2048)[0]
    assert {(r.conv_id, r.n_tokens, r.n_supervised, r.status) for r in summary.collect()} == \
        {(r.conv_id, len(r.input_ids), r.n_supervised, r.status) for r in rec}
    want_trim = {tuple(r) for r in chat.trim_history(chat.chat_history(clean), 1024).collect()}
    assert {tuple(r) for r in turns.trim_history_messages(msgs, convs, 1024).collect()} == want_trim
