"""Dialogue, instruction-tuning and sampler queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import constants as K
from corpusloom.functions.tokens import ids_to_string
from corpusloom.operators import batching, collate, dialogue, masks, render, turns
from corpusloom.operators.index import contiguous_index
from corpusloom.session import scratch_path
from corpusloom.sources.files import read_instructions
from corpusloom.sources.testdata import table

MODEL_MAX_LENGTH = 2048
SFT_BATCH = 32
BATCH_SIZE, WORLD_SIZE = 4, 2  # megabatch = 8 dialogues


def records(spark: SparkSession, sf: str) -> DataFrame:
    """conversations -> dialogue records; every third conversation carries an image (fixture rule)."""
    recs = dialogue.records_from_turns(table(spark, sf, "conversations"))
    has_img = F.pmod(F.col("conv_id"), F.lit(3)) == 0
    return dialogue.attach_image(recs, has_img, F.concat(F.lit("images/"), F.col("conv_id").cast("string"),
                                                         F.lit(".jpg")))


def clean_records(spark, sf):
    return dialogue.drop_leading_non_human(dialogue.normalise_image_placeholder(records(spark, sf)))


def _messages(spark, sf, stage="clean", said=None):
    """Message-level form of ``records`` / ``clean_records``: no conversation becomes one row.

    ``said`` stands in for the conversations table (the odd forms of it below).
    """
    said = table(spark, sf, "conversations") if said is None else said
    return turns.conversation_messages(said, lambda k: F.pmod(k, F.lit(3)) == 0, stage=stage)


def wide_turns(spark, sf):
    """The conversations with the spaces of East Asian and typeset text in place of plain ones."""
    text = F.concat(F.lit("\u3000"), F.replace(F.col("text"), F.lit(" "), F.lit("\u00a0")), F.lit("\u2003"))
    return table(spark, sf, "conversations").withColumn("text", text)


def broken_turns(spark, sf):
    """The conversations with some of them broken: two human turns in a row, an empty first message, no words at all."""
    k = F.col("conv_id")
    text = F.when(F.pmod(k, F.lit(11)) == 0, F.when(F.col("role") == "user", F.lit("")).otherwise(F.col("text"))) \
        .when(F.pmod(k, F.lit(13)) == 0, F.lit(" \u3000")).otherwise(F.col("text"))
    role = F.when((F.pmod(k, F.lit(7)) == 0) & (F.col("role") == "assistant"), F.lit("user")).otherwise(F.col("role"))
    return table(spark, sf, "conversations").withColumns({"text": text, "role": role})


def system_turns(spark, sf):
    """System prompt of conversations that say a second and a third thing as system turns: all of them, in turn order."""
    said = table(spark, sf, "conversations")
    first = said.filter(F.col("turn") == 0)
    more = [first.withColumns({"turn": F.lit(n).cast("bigint"), "role": F.lit("system"), "text": F.concat(F.lit(head), F.col("text"))})
            for n, head in ((-2, "zzz "), (-1, "aaa "))]
    convs = _messages(spark, sf, said=said.unionByName(more[0]).unionByName(more[1]))[1]
    return convs.select("conv_id", "system")


def dialogue_rejects(spark, sf):
    """P8, C4 / C5 and B3 as guards: why a conversation is kept from rendering and sampling."""
    return turns.rejected(*_messages(spark, sf, said=broken_turns(spark, sf)))


def turn_pairs_offset(spark, sf):
    """C10 of a template with two example messages in front: pairs begin after them."""
    msgs, convs = _messages(spark, sf)
    shown = turns.template_messages(msgs, convs, "v0", fewshot=True)
    shown = shown.withColumn("_b", F.floor(F.coalesce("g", F.lit(0)) / 65536).cast("bigint"))
    per = shown.filter(F.col("pos") >= 2).select("conv_id", "_b").distinct()
    pairs = turns.message_pairs(shown, per.select("conv_id").distinct().join(convs.select("conv_id", "system"), "conv_id"), offset=2)
    return pairs.select("conv_id", "pair_no", "user", "assistant")


def image_placeholder_wide(spark, sf):
    return _message_rows(_messages(spark, sf, "placeholder", wide_turns(spark, sf))[0])


def sample_len_wide(spark, sf):
    words = turns.conversation_word_counts(*_messages(spark, sf, "raw", wide_turns(spark, sf)))
    return batching.lengths_from_words(words).select("conv_id", "length")


def sampler_plain(spark, sf):
    """B8 without modality grouping: a seeded permutation in steps of ``BATCH_SIZE * WORLD_SIZE``."""
    return batching.sampler_order(_lengths(spark, sf), "conv_id", BATCH_SIZE, WORLD_SIZE, group_by_modality=False)


def sft_target_literal(spark, sf):
    """P3 with ``null_output='literal'``: every third output is null and becomes the text ``None``."""
    r = instruction_rows(spark, sf).withColumn("output", F.when(F.pmod("conv_id", F.lit(3)) > 0, F.col("output")))
    return r.select("conv_id", "pair_no", masks.sft_target(F.col("output"), "literal").alias("target"))


def _message_rows(msgs: DataFrame) -> DataFrame:
    return msgs.select("conv_id", "pos", "from", "value")


def dialogue_turns(spark, sf):
    return _message_rows(_messages(spark, sf, "raw")[0])


def dialogue_clean(spark, sf):
    return _message_rows(_messages(spark, sf)[0])


def dialogue_valid(spark, sf):
    """P8 as a partial aggregate per conversation: message j must come from roles[j % 2]."""
    msgs, convs = _messages(spark, sf)
    want = F.when(F.col("pos") % 2 == 0, F.lit(dialogue.HUMAN)).otherwise(F.lit(dialogue.GPT))
    per = msgs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("from") == want).alias("ok"))
    return convs.join(per, "conv_id", "left").select(
        "conv_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_msgs"),
        F.coalesce("ok", F.lit(True)).alias("valid"))


def image_placeholder(spark, sf):
    """P5 over every record (records without an image keep their text)."""
    return _message_rows(_messages(spark, sf, "placeholder")[0])


def image_prefix(spark, sf):
    """P6 in the VQA form: '<image>\\n' before the first question of a chat that has an image."""
    first = _messages(spark, sf)[0].filter(F.col("pos") == 0)
    return first.select("conv_id", F.when(F.col("has_img"), F.concat(F.lit(K.IMAGE_TOKEN + "\n"), F.col("value")))
                        .otherwise(F.col("value")).alias("first_message"))


MODEL_IDS = ["meta-llama/Meta-Llama-3-8B-Instruct", "meta-llama/Llama-2-7b-chat-hf", "lmsys/vicuna-7b-v1.5"]
FAMILY_TEMPLATE = {"llama_3": "llama_3", "llama_2": "llama_2", "default": "default"}


def template_route(spark, sf):
    r = clean_records(spark, sf).withColumn(
        "model_id", F.element_at(F.array(*[F.lit(m) for m in MODEL_IDS]), (F.pmod("conv_id", F.lit(3)) + 1).cast("int")))
    r = r.withColumn("family", dialogue.preprocess_family(F.col("model_id")))
    prompt = None
    for fam, name in FAMILY_TEMPLATE.items():
        tm = render.template(name)
        p = render.render_prompt(F.col("msgs"), F.coalesce(F.col("system"), F.lit(tm[0])), tm)
        prompt = F.when(F.col("family") == fam, p) if prompt is None else prompt.when(F.col("family") == fam, p)
    return r.select("conv_id", "model_id", "family", prompt.alias("prompt"))


def _family_of(key: F.Column):
    model_id = F.element_at(F.array(*[F.lit(m) for m in MODEL_IDS]), (F.pmod(key, F.lit(3)) + 1).cast("int"))
    return model_id, dialogue.preprocess_family(model_id)


def template_route_pieces(spark, sf):
    """P10 at message level: each conversation's pieces under the template its model id selects."""
    msgs, convs = _messages(spark, sf)
    model_id, family = _family_of(F.col("conv_id"))
    outs = []
    for fam, name in FAMILY_TEMPLATE.items():
        mine = family == F.lit(fam)
        outs.append(turns.render_pieces(msgs.filter(mine), convs.filter(mine), name)
                    .select("conv_id", model_id.alias("model_id"), F.lit(fam).alias("family"), "pos", "piece"))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


def _render_query(name, fewshot=False, mmtag=False):
    def q(spark, sf):
        r = clean_records(spark, sf) if not mmtag else records(spark, sf)
        return render.render(r, name, fewshot=fewshot, mmtag=mmtag).select("conv_id", "prompt")

    return q


def conversation_json(spark, sf):
    return dialogue.conversation_json(clean_records(spark, sf), render.template("v1"))


def _message_pairs(spark, sf, said=None):
    return turns.message_pairs(*_messages(spark, sf, said=said))


def turn_pairs(spark, sf):
    return _message_pairs(spark, sf).select("conv_id", "pair_no", "user", "assistant")


def tok_image(spark, sf):
    from corpusloom.operators.tokenize import tokenize_image_text

    r = render.render(clean_records(spark, sf), "llama_2")
    t = tokenize_image_text(r, "prompt")
    return t.select("conv_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                    ids_to_string("input_ids").alias("input_ids"))


def _mask_query(family, legacy=True):
    def q(spark, sf):
        m = masks.mask_dialogues(clean_records(spark, sf), family, MODEL_MAX_LENGTH, legacy)
        return m.select("conv_id", F.size("input_ids").cast("bigint").alias("n_tokens"), "n_supervised", "status",
                        ids_to_string("labels").alias("labels"))

    return q


def mask_rejects(spark, sf):
    """L5 counts per family and status, from the message-level masks."""
    msgs, convs = _messages(spark, sf)
    outs = []
    for fam, legacy in (("llama_2", True), ("llama_3", False), ("default", True)):
        summary = turns.mask_messages(msgs, convs, fam, MODEL_MAX_LENGTH, legacy)[0]
        outs.append(summary.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
                    .withColumn("family", F.lit(fam)))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


def mask_rejects_records(spark, sf):
    outs = []
    for fam, legacy in (("llama_2", True), ("llama_3", False), ("default", True)):
        m = masks.mask_dialogues(clean_records(spark, sf), fam, MODEL_MAX_LENGTH, legacy)
        outs.append(m.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("family", F.lit(fam)))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


# ---------------------------------------------------------------- instruction rows
def instruction_rows(spark, sf):
    """Pairs as instruction records: instruction = user, input = the dialogue's system text, output = answer."""
    p = _message_pairs(spark, sf)
    return p.select("conv_id", "pair_no", F.col("user").alias("instruction"), F.col("system").alias("input"),
                    F.col("assistant").alias("output"))


def instruction_scan(spark, sf):
    """S2 round trip: the records are written as JSON lines to the shared folder and read back."""
    path = scratch_path(spark, "instructions")
    instruction_rows(spark, sf).write.mode("overwrite").json(path)
    keys = [T.StructField("conv_id", T.LongType()), T.StructField("pair_no", T.LongType())]
    return read_instructions(spark, path, layout="lines", extra_fields=keys).select(
        "conv_id", "pair_no", "instruction", "input", "output")


def _sft_rows(spark, sf):
    r = instruction_rows(spark, sf)
    return r.withColumn("source", masks.sft_source(F.col("instruction"), F.col("input"))).withColumn(
        "target", masks.sft_target(F.col("output")))


def sft_prompt(spark, sf):
    return _sft_rows(spark, sf).select("conv_id", "pair_no", "source")


def sft_target(spark, sf):
    return _sft_rows(spark, sf).filter(F.col("target").isNotNull()).select("conv_id", "pair_no", "target")


def _sft_labelled(spark, sf):
    return masks.sft_labels(_sft_rows(spark, sf).filter(F.col("target").isNotNull()))


def sft_labels(spark, sf):
    t = _sft_labelled(spark, sf)
    return t.select("conv_id", "pair_no", F.size("input_ids").cast("bigint").alias("n_tokens"), "supervised_tokens",
                    ids_to_string("input_ids").alias("input_ids"), ids_to_string("labels").alias("labels"))


def _sft_batched(spark, sf):
    t = contiguous_index(_sft_labelled(spark, sf).select("conv_id", "pair_no", "input_ids", "labels"),
                         ["conv_id", "pair_no"], "_idx")
    return t.withColumn("batch_id", F.floor(F.col("_idx") / F.lit(SFT_BATCH)).cast("bigint")).withColumn(
        "pos", F.pmod(F.col("_idx"), F.lit(SFT_BATCH)).cast("bigint")).drop("_idx")


def collate_pad(spark, sf):
    c = collate.collate_pad(_sft_batched(spark, sf), K.SFT_PAD_ID)
    return c.select("batch_id", "pos", ids_to_string("input_ids").alias("input_ids"),
                    ids_to_string("labels").alias("labels"),
                    F.concat_ws(",", F.transform("attention_mask", lambda x: x.cast("int").cast("string")))
                    .alias("attention_mask"))


def collate_fault(spark, sf):
    c = collate.collate_fault_tolerant(_sft_batched(spark, sf), ["input_ids", "labels"])
    return c.select("batch_id", "pos", "ragged", ids_to_string("input_ids").alias("input_ids"),
                    ids_to_string("labels").alias("labels"))


def collate_features(spark, sf):
    """B11 over rows with a label, a string feature (dropped) and one that is null in every third batch's first row."""
    rows = _sft_batched(spark, sf).select(
        "batch_id", "pos", F.size("input_ids").cast("bigint").alias("label"), F.col("conv_id").cast("string").alias("note"),
        F.slice("input_ids", 1, 8 + F.pmod("batch_id", F.lit(2)).cast("int") * F.pmod("pos", F.lit(2)).cast("int")).alias("head"),
        F.when((F.pmod("batch_id", F.lit(3)) > 0) | (F.col("pos") > 0), F.col("pair_no")).alias("weight"))
    c = collate.collate_features(rows)
    return c.select("batch_id", "pos", "labels", ids_to_string("head").alias("head"), "weight", "ragged")


# ---------------------------------------------------------------- sampler
def _lengths(spark, sf):
    return batching.lengths_from_words(turns.conversation_word_counts(*_messages(spark, sf, "raw")))


def sample_len(spark, sf):
    return _lengths(spark, sf).select("conv_id", "length")


def modality_len(spark, sf):
    return _lengths(spark, sf).select("conv_id", "modality_length", "zero_length")


def megabatch(spark, sf):
    mb = batching.megabatches(_lengths(spark, sf), "conv_id", "length", BATCH_SIZE * WORLD_SIZE)
    return mb.select("conv_id", "mb", F.col("rank").cast("bigint").alias("rank"))


def even_chunks_strided(spark, sf):
    mb = batching.megabatches(_lengths(spark, sf), "conv_id", "length", BATCH_SIZE * WORLD_SIZE + 1)
    return batching.strided_chunks(mb, WORLD_SIZE).select("conv_id", "mb", "chunk", "chunk_pos")


def even_chunks_greedy(spark, sf):
    g = batching.length_grouped(_lengths(spark, sf), "conv_id", "length", BATCH_SIZE, WORLD_SIZE)
    return g.select("conv_id", "mb", "chunk", "chunk_pos")


def modality_batches(spark, sf):
    return batching.modality_batches(_lengths(spark, sf), "conv_id", BATCH_SIZE, WORLD_SIZE)


# ---------------------------------------------------------------- message-level forms
def _pieces_query(name):
    def q(spark, sf):
        msgs, convs = _messages(spark, sf)
        return turns.render_pieces(msgs, convs, name).select("conv_id", "pos", "piece")

    return q


def render_mmtag_pieces(spark, sf):
    msgs, convs = _messages(spark, sf, "raw")
    m = turns.template_messages(msgs, convs, "v1_mmtag", mmtag=True)
    return turns.render_pieces(m, convs, "v1_mmtag").select("conv_id", "pos", "piece")


def render_v0_fewshot_pieces(spark, sf):
    msgs, convs = _messages(spark, sf)
    m = turns.template_messages(msgs, convs, "v0", fewshot=True)
    return turns.render_pieces(m, convs, "v0").select("conv_id", "pos", "piece")


def tok_image_pieces(spark, sf):
    """T3 per piece of the llama-2 prompt: the pieces' ids in order are the prompt's ids (BOS on the head)."""
    from corpusloom.operators.tokenize import tokenize_image_text

    msgs, convs = _messages(spark, sf)
    t = tokenize_image_text(turns.render_pieces(msgs, convs, "llama_2"), "piece", bos=F.col("pos") == -1)
    return t.select("conv_id", "pos", F.size("input_ids").cast("bigint").alias("n_tokens"),
                    ids_to_string("input_ids").alias("input_ids"))


def _long_mask(family, legacy, part):
    def q(spark, sf):
        msgs, convs = _messages(spark, sf)
        summary, segments = turns.mask_messages(msgs, convs, family, MODEL_MAX_LENGTH, legacy)
        return summary if part == "summary" else segments

    return q


def mask_llama2_words(spark, sf):
    """L3 by character offsets: prompts of the llama-2 template, word tokens of the conversations' own vocabulary."""
    from corpusloom.operators import offset_masks, vocab

    msgs, convs = _messages(spark, sf)
    pieces = turns.render_pieces(msgs, convs, "llama_2").filter(F.col("pos") >= 0)
    words = vocab.vocab_from_text(table(spark, sf, "conversations"), "text")
    return offset_masks.masked_tokens(pieces, convs, F.col("pos") % 2 == 1, words, MODEL_MAX_LENGTH)


QUERIES = {
    "mask_llama2_words": mask_llama2_words,
    "render_llama2_pieces": _pieces_query("llama_2"),
    "render_llama3_pieces": _pieces_query("llama_3"),
    "tok_image_pieces": tok_image_pieces,
    "render_mmtag_pieces": render_mmtag_pieces,
    "render_v0_fewshot_pieces": render_v0_fewshot_pieces,
    "render_single_pieces": _pieces_query("llava_v0"),
    "render_two_pieces": _pieces_query("v1"),
    "render_mpt_pieces": _pieces_query("mpt"),
    "render_plain_pieces": _pieces_query("plain"),
    "mask_llama2_long": _long_mask("llama_2", True, "summary"),
    "mask_llama3_long": _long_mask("llama_3", False, "summary"),
    "mask_llama2_segments": _long_mask("llama_2", True, "segments"),
    "mask_llama3_segments": _long_mask("llama_3", False, "segments"),
    "mask_two_long": _long_mask("default", True, "summary"),
    "mask_two_segments": _long_mask("default", True, "segments"),
    "dialogue_turns": dialogue_turns,
    "dialogue_clean": dialogue_clean,
    "dialogue_valid": dialogue_valid,
    "image_placeholder": image_placeholder,
    "image_prefix": image_prefix,
    "template_route": template_route,
    "render_single": _render_query("llava_v0"),
    "render_two": _render_query("v1"),
    "render_mpt": _render_query("mpt"),
    "render_llama2": _render_query("llama_2"),
    "render_llama3": _render_query("llama_3"),
    "render_plain": _render_query("plain"),
    "render_mmtag": _render_query("v1_mmtag", mmtag=True),
    "render_v0_fewshot": _render_query("v0", fewshot=True),
    "conversation_json": conversation_json,
    "turn_pairs": turn_pairs,
    "tok_image": tok_image,
    "mask_llama2": _mask_query("llama_2"),
    "mask_llama3": _mask_query("llama_3", legacy=False),
    "mask_two": _mask_query("default", legacy=True),
    "mask_rejects": mask_rejects,
    "mask_rejects_records": mask_rejects_records,
    "template_route_pieces": template_route_pieces,
    "instruction_scan": instruction_scan,
    "sft_prompt": sft_prompt,
    "sft_target": sft_target,
    "sft_labels": sft_labels,
    "collate_pad": collate_pad,
    "collate_fault": collate_fault,
    "collate_features": collate_features,
    "sample_len": sample_len,
    "modality_len": modality_len,
    "megabatch": megabatch,
    "even_chunks_strided": even_chunks_strided,
    "even_chunks_greedy": even_chunks_greedy,
    "modality_batches": modality_batches,
    "system_turns": system_turns,
    "dialogue_rejects": dialogue_rejects,
    "turn_pairs_offset": turn_pairs_offset,
    "image_placeholder_wide": image_placeholder_wide,
    "sample_len_wide": sample_len_wide,
    "sampler_plain": sampler_plain,
    "sft_target_literal": sft_target_literal,
}

from corpusloom.plans.dialogue_sql import ORACLE  # noqa: E402
