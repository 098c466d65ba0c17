"""Supervision labels for dialogues (L2-L5) and for instruction rows (L1, T5).

Dialogue rule being reproduced: the rendered prompt is tokenized (with BOS)
and cut to ``model_max_length`` (not for image records); the prompt is split
on the template's round separator, each round on the instruction separator;
instruction tokens are masked, answer tokens kept, everything after the last
good round masked; a round that is empty or does not split in exactly two
ends the walk; if the walked length is below ``model_max_length`` and differs
from the number of non-pad tokens, the whole row is masked.

All of it is one row-local expression: ``split`` for rounds, token counts
computed arithmetically from byte lengths (the tokenizer is additive), an
``aggregate`` over the rounds for the running offset, and ``transform`` over
the ids for the labels.  No per-token explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import regex_quote
from corpusloom.functions.tokens import encode_with_specials, n_tokens
from corpusloom.operators.render import render_prompt, template

FAMILIES = {
    # family: (template name, instruction separator, tokens subtracted from the instruction length)
    "llama_2": ("llama_2", K.LLAMA_2_INST_SEP, 1),
    "llama_3": ("llama_3", K.LLAMA_3_INST_SEP, 1),
    "default": ("default", None, 2),
}


def _inst_sep(family: str) -> str:
    name, sep, _ = FAMILIES[family]
    if sep is None:
        tmpl = template(name)
        sep = tmpl[5] + tmpl[1][1] + ": "
    return sep


def _walk_expr(prompt: Column, family: str, legacy: bool) -> Column:
    """struct(cur, stop, keep[lo, hi)): the reference's walk over the rounds of ``prompt``."""
    name, _, minus = FAMILIES[family]
    sep2 = template(name)[6]
    inst = _inst_sep(family)
    rounds = F.split(prompt, regex_quote(sep2), -1)

    def info(r, i):
        parts = F.split(r, regex_quote(inst), -1)
        ok = (r != F.lit("")) & (F.size(parts) == 2)
        round_len = F.lit(1) + n_tokens(r)
        instr = F.lit(1) + n_tokens(F.concat(parts.getItem(0), F.lit(inst))) - F.lit(minus)
        if family == "default" and not legacy:
            adj = F.when(i != 0, F.lit(-1)).otherwise(F.lit(0))
        elif family == "llama_3" and legacy:
            adj = F.when(i != 0, F.lit(1)).otherwise(F.lit(0))
        else:
            adj = F.lit(0)
        return F.struct(ok.alias("ok"), (round_len + adj).cast("int").alias("rl"),
                        (instr + adj).cast("int").alias("il"))

    zero = F.struct(F.lit(1).alias("cur"), F.lit(False).alias("stop"),
                    F.array().cast("array<struct<lo:int,hi:int>>").alias("keep"))

    def step(acc, x):
        go = ~acc["stop"] & x["ok"]
        return F.struct(
            F.when(go, acc["cur"] + x["rl"]).otherwise(acc["cur"]).alias("cur"),
            (acc["stop"] | ~x["ok"]).alias("stop"),
            F.when(go, F.concat(acc["keep"], F.array(F.struct(
                (acc["cur"] + x["il"]).alias("lo"), (acc["cur"] + x["rl"]).alias("hi"))))).otherwise(acc["keep"])
            .alias("keep"),
        )

    return F.aggregate(F.transform(rounds, info), zero, step)


def apply_mask(df: DataFrame, family: str, model_max_length: int, legacy: bool = True,
               truncate: Column | None = None, pad_id: int = K.PAD_ID) -> DataFrame:
    """``prompt`` -> input_ids, labels, status ('ok' / 'mismatch'), n_supervised."""
    truncate = F.lit(True) if truncate is None else truncate
    full = encode_with_specials(F.col("prompt"), bos=True)
    out = df.withColumn("input_ids", F.when(truncate, F.slice(full, 1, model_max_length)).otherwise(full))
    out = out.withColumn("_walk", _walk_expr(F.col("prompt"), family, legacy))
    total_len = F.size(F.filter("input_ids", lambda x: x != F.lit(pad_id)))
    out = out.withColumn("_rej", (F.col("_walk.cur") < F.lit(model_max_length)) & (F.col("_walk.cur") != total_len))
    out = out.withColumn(
        "labels",
        F.when(F.col("_rej"), F.array_repeat(F.lit(K.IGNORE_INDEX), F.size("input_ids"))).otherwise(
            F.transform("input_ids", lambda x, j: F.when(
                F.exists("_walk.keep", lambda r: (j >= r["lo"]) & (j < r["hi"])), x).otherwise(F.lit(K.IGNORE_INDEX)))
        ),
    )
    return out.withColumn("status", F.when(F.col("_rej"), F.lit("mismatch")).otherwise(F.lit("ok"))).withColumn(
        "n_supervised", F.size(F.filter("labels", lambda x: x != F.lit(K.IGNORE_INDEX))).cast("bigint")
    ).drop("_walk", "_rej")


def mask_dialogues(records: DataFrame, family: str, model_max_length: int, legacy: bool = True) -> DataFrame:
    """records (conv_id, system, image, msgs) -> + prompt, input_ids, labels, status, n_supervised.

    Image records are tokenized without the length cut, as in the reference.
    """
    tmpl = template(FAMILIES[family][0])
    system = F.coalesce(F.col("system"), F.lit(tmpl[0]))
    with_prompt = records.withColumn("prompt", render_prompt(F.col("msgs"), system, tmpl))
    return apply_mask(with_prompt, family, model_max_length, legacy, truncate=F.col("image").isNull())


# ---------------------------------------------------------------------------
# Instruction rows
# ---------------------------------------------------------------------------

def sft_source(instruction: Column, inp: Column) -> Column:
    """P1 + P2: instruction (+ '\\n' + input when present and non-empty) inside the prompt template."""
    merged = F.when(inp.isNotNull() & (inp != F.lit("")), F.concat(instruction, F.lit("\n"), inp)).otherwise(instruction)
    return F.concat(F.lit(K.SFT_PROMPT_PREFIX), merged, F.lit(K.SFT_PROMPT_SUFFIX))


def sft_target(output: Column, null_output: str = "reject") -> Column:
    """Output + EOS; a null output is rejected (null) unless ``null_output='literal'`` (text 'None')."""
    out = F.coalesce(output, F.lit("None")) if null_output == "literal" else output
    return F.concat(out, F.lit(K.EOS_TOKEN))


def sft_labels(df: DataFrame, max_seq_length: int = K.SFT_MAX_SEQ_LENGTH) -> DataFrame:
    """L1 + T5: ids = BOS+source ++ target, labels = -100 per source token ++ target; both cut."""
    src = encode_with_specials(F.col("source"), bos=True)
    tgt = encode_with_specials(F.col("target"), bos=False)
    out = df.withColumn("_src", src).withColumn("_tgt", tgt)
    out = out.withColumn("input_ids", F.slice(F.concat("_src", "_tgt"), 1, max_seq_length)).withColumn(
        "labels",
        F.slice(F.concat(F.array_repeat(F.lit(K.IGNORE_INDEX), F.size("_src")), F.col("_tgt")), 1, max_seq_length),
    )
    # invariant of the reference: equal lengths
    out = out.withColumn(
        "labels", F.when(F.size("labels") == F.size("input_ids"), F.col("labels")).otherwise(
            F.raise_error(F.lit("input_ids and labels differ in length")).cast("array<int>"))
    )
    return out.drop("_src", "_tgt").withColumn(
        "supervised_tokens", F.size(F.filter("labels", lambda x: x != F.lit(K.IGNORE_INDEX))).cast("bigint"))
