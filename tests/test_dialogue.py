import pytest
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import dialogue, masks, render
from helpers import py_tok, supervised_texts

SCHEMA = "conv_id long, system string, image string, msgs array<struct<from:string,value:string>>"


def recs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def m(*pairs):
    return [{"from": f, "value": v} for f, v in pairs]


GOLDEN = {
    "llava_v0": "S###Human: hi###Assistant: yo###",
    "v1": "S USER: hi ASSISTANT: yo</s>",
    "mpt": "S<|im_end|><|im_start|>user\nhi<|im_end|><|im_start|>assistant\nyo<|im_end|>",
    "llama_2": "<<SYS>>\nS\n<</SYS>>\n\n<s>[INST] hi [/INST] yo </s>",
    "llama_3": ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>S<|eot_id|>"
                "<|start_header_id|>user<|end_header_id|>hi<|eot_id|> "
                "<|start_header_id|>assistant<|end_header_id|>yo <|end_of_text|>"),
    "plain": "Shi\nyo\n",
    "mistral_instruct": "<<SYS>>\nS\n<</SYS>>\n\n[INST] hi [/INST] yo </s>",
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_render_golden(spark, name):
    df = recs(spark, [(1, "S", None, m(("human", "hi"), ("gpt", "yo")))])
    assert render.render(df, name).first().prompt == GOLDEN[name]


def test_render_empty_message_and_fewshot(spark):
    df = recs(spark, [(1, "S", None, m(("human", "hi"), ("gpt", "")))])
    assert render.render(df, "v1").first().prompt == "S USER: hi ASSISTANT:"
    assert render.render(df, "llama_2").first().prompt == "<<SYS>>\nS\n<</SYS>>\n\n<s>[INST] hi [/INST]"
    few = render.render(df, "v0", fewshot=True).first().prompt
    assert few.startswith("S###Human: What are the key differences") and few.endswith("###Human: hi###Assistant:")


def test_mmtag_and_image_prefix(spark):
    df = recs(spark, [(1, "S", "a.jpg", m(("human", "look <image> here"), ("gpt", "ok")))])
    out = render.render(df, "v1_mmtag", mmtag=True).first().prompt
    assert out == "S USER: <Image><image></Image> ASSISTANT: Received.</s>USER: look  here ASSISTANT: ok</s>"
    out = render.render(df, "v1", mmtag=True).first().prompt
    assert out == "S USER: <image>\nlook  here ASSISTANT: ok</s>"


def test_registry_has_17_names_13_objects(spark):
    reg = render.registry_frame(spark)
    assert reg.count() == 17
    assert reg.select("object").distinct().count() == 13


def test_clean_validate_placeholder(spark):
    rows = [
        (1, None, None, m(("gpt", "first from gpt"), ("human", "q"), ("gpt", "a"))),
        (2, None, None, m(("human", "q"), ("human", "broken"))),
        (3, None, "x.jpg", m(("human", "what is <image> this?  "), ("gpt", "a"))),
        (4, None, None, m(("human", "text with <image> but no image"), ("gpt", "a"))),
    ]
    df = dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(recs(spark, rows)))
    got = {r.conv_id: r for r in df.select("conv_id", "msgs", dialogue.role_alternation_ok(F.col("msgs")).alias("ok"))
           .collect()}
    assert [x["value"] for x in got[1].msgs] == ["q", "a"] and got[1].ok
    assert not got[2].ok
    assert got[3].msgs[0]["value"] == "<image>\nwhat is  this?"
    assert got[4].msgs[0]["value"] == "text with <image> but no image"


MASK_CASES = [
    (1, m(("human", "hi"), ("gpt", "yo"))),
    (2, m(("human", "hi"), ("gpt", "yo"), ("human", "more"))),  # ends on human
    (3, m(("human", "hi"), ("gpt", "yo"), ("human", "more"), ("gpt", ""))),  # empty last answer
    (4, m(("human", "a [/INST] b"), ("gpt", "yo"))),  # separator inside text
    (5, m(("human", "x" * 300), ("gpt", "y" * 300), ("human", "z"), ("gpt", "w"))),  # over the limit
    (6, m(("human", "q1"), ("gpt", ""), ("human", "q2"), ("gpt", "a2"))),  # empty middle answer
    (7, m(("human", "<image>\nq"), ("gpt", "a"), ("human", "q2"), ("gpt", "a2"))),
]


def _l3(answer):
    return f"<|start_header_id|>assistant<|end_header_id|>{answer} <|end_of_text|>"


# worked by hand: per conversation the supervised texts, or None where the whole row is masked as a mismatch
SUPERVISED = {
    # rounds end in </s>; a human end or an empty last answer leaves the walk short, a separator inside splits in three
    ("llama_2", True): {1: ["yo </s>"], 2: None, 3: None, 4: None, 5: [], 6: ["a2 </s>"], 7: ["a </s>", "a2 </s>"]},
    ("llama_3", False): {1: [_l3("yo")], 2: None, 3: None, 4: [_l3("yo")], 5: [], 6: [_l3("a2")], 7: [_l3("a"), _l3("a2")]},
    # the later rounds' extra token puts a conversation of two full rounds off
    ("llama_3", True): {1: [_l3("yo")], 2: None, 3: None, 4: [_l3("yo")], 5: [], 6: [_l3("a2")], 7: None},
    ("default", True): {1: [" yo</s>"], 2: None, 3: None, 4: [" yo</s>"], 5: [], 6: [" a2</s>"], 7: [" a</s>", " a2</s>"]},
    ("default", False): {1: [" yo</s>"], 2: None, 3: None, 4: [" yo</s>"], 5: [], 6: [" a2</s>"], 7: None},
}


@pytest.mark.parametrize("family,legacy", sorted(SUPERVISED))
def test_masks_golden(spark, family, legacy):
    max_len = 256
    rows = [(cid, "sys", "i.jpg" if cid == 7 else None, msgs) for cid, msgs in MASK_CASES]
    for r in masks.mask_dialogues(recs(spark, rows), family, max_len, legacy).collect():
        whole = py_tok(r.prompt)
        assert list(r.input_ids) == (whole if r.conv_id == 7 else whole[:max_len])  # rows with an image are not cut
        want = SUPERVISED[family, legacy][r.conv_id]
        assert r.status == ("ok" if want is not None else "mismatch"), r.conv_id
        assert supervised_texts(r.input_ids, r.labels) == (want or []), (family, r.conv_id)


def test_sft_labels_rule(spark):
    df = spark.createDataFrame([("do it", None, "done"), ("do", "", None), ("x", "ctx", "y" * 600)],
                               "instruction string, input string, output string")
    rows = df.withColumn("source", masks.sft_source(F.col("instruction"), F.col("input"))).withColumn(
        "target", masks.sft_target(F.col("output")))
    got = rows.collect()
    assert got[0].source == K.SFT_PROMPT_PREFIX + "do it" + K.SFT_PROMPT_SUFFIX
    assert got[1].target is None  # null output rejected by default
    assert got[2].source == K.SFT_PROMPT_PREFIX + "x\nctx" + K.SFT_PROMPT_SUFFIX
    lab = masks.sft_labels(rows.filter("target is not null")).collect()
    for r in lab:
        assert len(r.input_ids) == len(r.labels) <= K.SFT_MAX_SEQ_LENGTH
    assert lab[0].labels[-1] == K.EOS_ID and lab[0].input_ids[0] == K.BOS_ID
    assert lab[1].supervised_tokens == sum(1 for x in lab[1].labels if x != K.IGNORE_INDEX)
