"""Chat prompts, history trimming and answer extraction.

A chat is a dialogue record seen as pairs [user, assistant]; the last
assistant answer is the one a model would generate, so it is blanked.  All
operators are row-local expressions on the pair array (its size is one
conversation), so nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import py_strip, rfind_slice, substring_after_last
from corpusloom.functions.tokens import n_tokens


def pairs_of(msgs: Column) -> Column:
    """ARRAY<STRUCT<u, a>> from a message array (even = user, odd = answer, missing answer = '')."""
    n_pairs = F.floor((F.size(msgs) + 1) / 2).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n_pairs - 1),
        lambda p: F.struct(F.element_at(msgs, p * 2 + 1)["value"].alias("u"),
                           F.coalesce(F.try_element_at(msgs, p * 2 + 2)["value"], F.lit("")).alias("a")),
    )


def _sys_block(system: Column) -> Column:
    return F.concat(F.lit(K.CHAT_SYS_OPEN), system, F.lit(K.CHAT_SYS_CLOSE))


def _resp(a: Column) -> Column:
    return F.when(F.length(a) > 0, F.concat(F.lit(" "), a)).otherwise(F.lit(""))


def single_turn_prompt(instruction: Column, system: Column | None, response: Column | None = None) -> Column:
    """With system: '[INST] <<SYS>>\\n{s}\\n<</SYS>>\\n\\n{q} [/INST]'; without: '[INST] {q} [/INST]'."""
    head = _sys_block(system) if system is not None else F.lit(K.CHAT_INST_OPEN)
    p = F.concat(head, instruction, F.lit(K.CHAT_INST_CLOSE))
    return p if response is None else F.concat(p, _resp(response))


def default_system(system: Column, default: str = K.CHAT_DEFAULT_SYSTEM_PROMPT) -> Column:
    """An empty (or absent) system prompt becomes the default."""
    return F.when(F.coalesce(F.length(system), F.lit(0)) == 0, F.lit(default)).otherwise(system)


def multi_turn_prompt(pairs: Column, system: Column) -> Column:
    """First pair with the system block and '</s>', middle pairs '<s>...</s>', last '<s>' + open prompt."""
    n = F.size(pairs)
    first = pairs.getItem(0)
    last = F.element_at(pairs, -1)
    one = single_turn_prompt(first["u"], system)
    head = F.concat(single_turn_prompt(first["u"], system, first["a"]), F.lit(K.EOS_TOKEN))
    middle = F.concat_ws("", F.transform(
        F.slice(pairs, 2, F.greatest(n - 2, F.lit(0))),
        lambda p: F.concat(F.lit(K.BOS_TOKEN), single_turn_prompt(p["u"], None, p["a"]), F.lit(K.EOS_TOKEN))))
    tail = F.concat(F.lit(K.BOS_TOKEN), single_turn_prompt(last["u"], None))
    return F.when(n == 1, one).otherwise(F.concat(head, middle, tail))


def chat_history(records: DataFrame) -> DataFrame:
    """records -> (conv_id, system, pairs) with the last answer blanked (the turn to generate)."""
    pairs = pairs_of(F.col("msgs"))
    blank_last = F.transform(pairs, lambda p, i: F.when(i == F.size(pairs) - 1, F.struct(
        p["u"].alias("u"), F.lit("").alias("a"))).otherwise(p))
    return records.filter(F.size("msgs") > 0).select(
        "conv_id", default_system(F.col("system")).alias("system"), blank_last.alias("pairs"))


def trim_history(chats: DataFrame, budget: int = K.CHAT_TOKEN_BUDGET) -> DataFrame:
    """H1: drop the oldest pairs until the rendered prompt (with BOS) fits ``budget`` or one pair is left.

    The prompt length for a start pair k is computed from per-pair token
    counts (the tokenizer is additive over the pair boundaries), and the
    first k that fits is kept, exactly as the reference's loop stops.
    """
    pairs = F.col("pairs")
    n = F.size(pairs)
    sysb = _sys_block(F.col("system"))
    first_len = F.transform(pairs, lambda p: n_tokens(F.concat(sysb, p["u"], F.lit(K.CHAT_INST_CLOSE), _resp(p["a"]),
                                                                 F.lit(K.EOS_TOKEN))))
    mid_len = F.transform(pairs, lambda p: n_tokens(F.concat(F.lit(K.BOS_TOKEN + K.CHAT_INST_OPEN), p["u"],
                                                               F.lit(K.CHAT_INST_CLOSE), _resp(p["a"]),
                                                               F.lit(K.EOS_TOKEN))))
    last = F.element_at(pairs, -1)
    last_len = n_tokens(F.concat(F.lit(K.BOS_TOKEN + K.CHAT_INST_OPEN), last["u"], F.lit(K.CHAT_INST_CLOSE)))
    single_len = n_tokens(F.concat(sysb, last["u"], F.lit(K.CHAT_INST_CLOSE)))
    out = chats.withColumn("_first", first_len).withColumn("_mid", mid_len).withColumn("_last", last_len) \
        .withColumn("_single", single_len)

    def total(k):
        mids = F.aggregate(F.slice("_mid", k + 2, F.greatest(n - k - 2, F.lit(0))), F.lit(0).cast("bigint"),
                           lambda a, x: a + x)
        return F.lit(1) + F.when(k == n - 1, F.col("_single")).otherwise(
            F.element_at("_first", k + 1) + mids + F.col("_last"))

    totals = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("k"), total(k).alias("t")))
    out = out.withColumn("_totals", totals)
    fits = F.filter("_totals", lambda x: (x["t"] <= F.lit(budget)) | (x["k"] == n - 1))
    out = out.withColumn("_pick", fits.getItem(0))
    kept = F.slice(pairs, F.col("_pick.k") + 1, n)
    return out.select(
        "conv_id",
        F.col("_pick.k").cast("bigint").alias("start_pair"),
        F.size(kept).cast("bigint").alias("n_pairs"),
        F.col("_pick.t").cast("bigint").alias("n_tokens"),
        multi_turn_prompt(kept, F.col("system")).alias("prompt"),
    )


def history_prompts(records: DataFrame, system: str = K.INFER_DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """P13 (+P15): per pair, the single-turn prompt whose system text is prefixed by the earlier turns.

    HISTORY grows by '{q} [/INST] {answer} [INST] ' per turn; a blank input ends the session.
    """
    pairs = pairs_of(F.col("msgs"))
    blank = F.array_position(F.transform(pairs, lambda p: py_strip(p["u"]) == F.lit("")), F.lit(True))
    live = F.when(blank > 0, F.slice(pairs, 1, blank - 1)).otherwise(pairs)
    hist = lambda i: F.concat_ws("", F.transform(F.slice(live, 1, i), lambda p: F.concat(
        p["u"], F.lit(" [/INST] "), py_strip(p["a"]), F.lit(" [INST] "))))
    prompts = F.transform(live, lambda p, i: F.struct(
        i.cast("bigint").alias("pair_no"),
        single_turn_prompt(p["u"], F.concat(hist(i), F.lit(system))).alias("prompt")))
    return records.select("conv_id", F.explode(prompts).alias("x")).select("conv_id", "x.pair_no", "x.prompt")


def answer_after_inst(output: Column) -> Column:
    """Text after the last '[/INST]', stripped (whole text when absent)."""
    return py_strip(substring_after_last(output, K.CHAT_INST_MARKER))


def answer_after_assistant(output: Column) -> Column:
    """``s[s.rfind('ASSISTANT: ') + 11:]`` (drops 10 characters when the marker is absent)."""
    return rfind_slice(output, K.ASSISTANT_MARKER)
