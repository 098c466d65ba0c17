"""Dialogue records: turn table -> nested record, cleaning, validation.

A dialogue record is ``(conv_id, system, image, msgs)`` with ``msgs`` an
ARRAY<STRUCT<from STRING, value STRING>> in turn order.  The turn table is
grouped once on ``conv_id`` (one shuffle, partial aggregation impossible for
collect_list but each group is one dialogue); every later step is a row-local
higher-order-function expression on the array, so no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import py_strip, word_count

HUMAN, GPT = "human", "gpt"
ROLE_MAP = {"user": HUMAN, "assistant": GPT}


def system_text(turn: str = "turn", role: str = "role", text: str = "text") -> Column:
    """Aggregate: the texts of a conversation's system turns in turn order, joined by line breaks; null without any."""
    said = F.array_sort(F.collect_list(F.when((F.col(role) == "system") & F.col(text).isNotNull(),
                                              F.struct(F.col(turn).alias("turn"), F.col(text).alias("text")))))
    return F.when(F.size(said) > 0, F.array_join(F.transform(said, lambda m: m["text"]), "\n"))


def records_from_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """(key, turn, role, text) -> (key, system, msgs); the system turns become the system prompt."""
    role_from = F.when(F.col(role) == "user", F.lit(HUMAN)).when(F.col(role) == "assistant", F.lit(GPT)).otherwise(
        F.col(role)
    )
    msg = F.when(F.col(role) != "system", F.struct(F.col(turn).alias("turn"), role_from.alias("from"),
                                                  F.col(text).alias("value")))
    grouped = turns.groupBy(key).agg(
        system_text(turn, role, text).alias("system"),
        F.array_sort(F.collect_list(msg)).alias("_msgs"),
    )
    return grouped.select(
        key, "system",
        F.transform("_msgs", lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("msgs"),
    )


def attach_image(records: DataFrame, has_image: Column, image_path: Column) -> DataFrame:
    """Give a record an image and put ``<image>`` after its first human message text."""
    first_human = F.array_position(F.transform("msgs", lambda m: m["from"]), HUMAN)
    msgs = F.transform(
        "msgs",
        lambda m, i: F.when(has_image & ((i + 1) == first_human),
                            F.struct(m["from"].alias("from"),
                                     F.concat(m["value"], F.lit("\n" + K.IMAGE_TOKEN)).alias("value"))).otherwise(m),
    )
    return records.withColumn("msgs", msgs).withColumn("image", F.when(has_image, image_path))


def drop_leading_non_human(records: DataFrame) -> DataFrame:
    """Skip the first message when it is not from the human."""
    m = F.col("msgs")
    return records.withColumn(
        "msgs",
        F.when((F.size(m) > 0) & (m.getItem(0)["from"] != F.lit(HUMAN)), F.slice(m, 2, 1 << 30)).otherwise(m),
    )


def role_alternation_ok(msgs: Column) -> Column:
    """Message j must come from roles[j % 2] (human, gpt)."""
    return F.forall(
        F.transform(msgs, lambda m, j: m["from"] == F.when(j % 2 == 0, F.lit(HUMAN)).otherwise(F.lit(GPT))),
        lambda ok: ok,
    )


def rejected_records(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, reason) of the records that cannot be rendered or sampled, after P5 and P7 (see ``turns.rejected``)."""
    r = drop_leading_non_human(normalise_image_placeholder(records))
    said = F.transform("msgs", lambda m: F.coalesce(m["value"], F.lit("")))
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce(role_alternation_ok(F.col("msgs")), F.lit(False)), F.lit("role_order")),
        F.when(F.try_element_at(said, F.lit(1)) == "", F.lit("empty_first")),
        F.when(~F.exists(said, lambda v: word_count(v) > 0), F.lit("no_words"))))
    return r.select(key, F.explode(reasons).alias("reason"))


def normalise_image_placeholder(records: DataFrame) -> DataFrame:
    """P5: for records with an image, a message holding ``<image>`` becomes '<image>\\n' + stripped rest."""
    tok = K.IMAGE_TOKEN

    def fix(m):
        v = m["value"]
        moved = py_strip(F.concat(F.lit(tok + "\n"), py_strip(F.replace(v, F.lit(tok), F.lit("")))))
        return F.struct(m["from"].alias("from"),
                        F.when(F.col("image").isNotNull() & (F.instr(v, tok) > 0), moved).otherwise(v).alias("value"))

    return records.withColumn("msgs", F.transform("msgs", fix))


def preprocess_family(model_id: Column) -> Column:
    """P10: which preprocessing a model id selects."""
    low = F.lower(model_id)
    return F.when(low.contains("llama-3"), F.lit("llama_3")).when(low.contains("llama-2"), F.lit("llama_2")).otherwise(
        F.lit("default"))


def turn_pairs(records: DataFrame, key: str = "conv_id", offset: int = 0) -> DataFrame:
    """From ``offset``, message pairs (even, odd) -> (key, pair_no, user, assistant); missing answer null."""
    msgs = F.slice(F.col("msgs"), offset + 1, 1 << 30) if offset else F.col("msgs")
    n_pairs = F.floor((F.size(msgs) + 1) / 2)
    pairs = F.transform(
        F.sequence(F.lit(0), (n_pairs - 1).cast("int")),
        lambda p: F.struct(
            p.cast("bigint").alias("pair_no"),
            F.element_at(msgs, p * 2 + 1)["value"].alias("user"),
            F.try_element_at(msgs, p * 2 + 2)["value"].alias("assistant"),
        ),
    )
    return records.filter(F.size(msgs) > 0).select(key, "system", F.explode(pairs).alias("p")).select(
        key, "system", "p.pair_no", "p.user", "p.assistant")


def conversation_json(records: DataFrame, template: tuple, key: str = "conv_id") -> DataFrame:
    """C11: export (system, roles, messages, offset, sep, sep2) as JSON text."""
    system, roles, _, offset, _, sep, sep2, _ = template
    messages = F.transform(
        "msgs", lambda m, i: F.array(F.when(i % 2 == 0, F.lit(roles[0])).otherwise(F.lit(roles[1])), m["value"]))
    body = F.struct(
        F.coalesce(F.col("system"), F.lit(system)).alias("system"),
        F.array(*[F.lit(r) for r in roles]).alias("roles"),
        messages.alias("messages"),
        F.lit(offset).alias("offset"),
        F.lit(sep).alias("sep"),
        F.lit(sep2).cast("string").alias("sep2"),
    )
    return records.select(key, F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))
