"""Conversation rendering by separator style (C1-C9), as one row-local expression.

``render_prompt`` turns a message array into the prompt string of a template:
``concat_ws('', transform(msgs, (m, i) -> piece))`` with the template's
literals folded into the plan.  No shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators.dialogue import HUMAN


def template(name: str) -> tuple:
    """Template object registered under ``name``."""
    return K.TEMPLATE_OBJECTS[K.TEMPLATE_NAMES[name]]


def registry_frame(spark) -> DataFrame:
    """C7 as a small table: one row per registered name."""
    rows = []
    for name, key in K.TEMPLATE_NAMES.items():
        system, roles, msgs, offset, style, sep, sep2, version = K.TEMPLATE_OBJECTS[key]
        rows.append((name, key, system, list(roles), len(msgs), offset, style, sep, sep2, version))
    return spark.createDataFrame(
        rows,
        "name string, object string, system string, roles array<string>, n_messages int, offset int, "
        "sep_style string, sep string, sep2 string, version string",
    )


def _nonempty(v: Column) -> Column:
    return v.isNotNull() & (v != F.lit(""))


def with_fewshot(msgs: Column, tmpl: tuple) -> Column:
    """The template's example messages before the dialogue's."""
    shots = tmpl[2]
    if not shots:
        return msgs
    roles = tmpl[1]
    lits = [F.struct(F.lit(HUMAN if r == roles[0] else "gpt").alias("from"), F.lit(v).alias("value"))
            for r, v in shots]
    return F.concat(F.array(*lits), msgs)


def mmtag_rewrite(msgs: Column, has_image: Column, tmpl: tuple) -> Column:
    """First message of an image chat: strip '<image>', then mmtag turns or an '<image>\\n' prefix."""
    version = tmpl[7]
    first = msgs.getItem(0)
    stripped = F.regexp_replace(F.replace(first["value"], F.lit(K.IMAGE_TOKEN), F.lit("")),
                                r"^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$", "")
    if "mmtag" in version:
        head = F.array(
            F.struct(F.lit(HUMAN).alias("from"), F.lit("<Image><image></Image>").alias("value")),
            F.struct(F.lit("gpt").alias("from"), F.lit("Received.").alias("value")),
            F.struct(first["from"].alias("from"), stripped.alias("value")),
        )
    else:
        head = F.array(F.struct(first["from"].alias("from"),
                                F.concat(F.lit(K.IMAGE_TOKEN + "\n"), stripped).alias("value")))
    rewritten = F.concat(head, F.slice(msgs, 2, 1 << 30))
    return F.when(has_image & (F.size(msgs) > 0), rewritten).otherwise(msgs)


def style_parts(system: Column, tmpl: tuple):
    """(head, piece) of ``tmpl``: the prompt is head + the pieces of messages 0, 1, ... concatenated.

    ``piece(m, i)`` takes a message struct (``from``, ``value``) and its position.
    """
    _, roles, _, _, style, sep, sep2, _ = tmpl
    if sep2 is None and style in ("TWO", "PLAIN"):
        sep2 = sep  # the registered plain template has no sep2 (Q8)

    def role_of(m):
        return F.when(m["from"] == F.lit(HUMAN), F.lit(roles[0])).otherwise(F.lit(roles[1]))

    def seps(i):
        return F.when(i % 2 == 0, F.lit(sep)).otherwise(F.lit(sep2))

    if style == "SINGLE":
        head = F.concat(system, F.lit(sep))
        piece = lambda m, i: F.when(_nonempty(m["value"]), F.concat(role_of(m), F.lit(": "), m["value"], F.lit(sep))) \
            .otherwise(F.concat(role_of(m), F.lit(":")))
    elif style == "TWO":
        head = F.concat(system, F.lit(sep))
        piece = lambda m, i: F.when(_nonempty(m["value"]), F.concat(role_of(m), F.lit(": "), m["value"], seps(i))) \
            .otherwise(F.concat(role_of(m), F.lit(":")))
    elif style == "MPT":
        head = F.concat(system, F.lit(sep))
        piece = lambda m, i: F.when(_nonempty(m["value"]), F.concat(role_of(m), m["value"], F.lit(sep))) \
            .otherwise(role_of(m))
    elif style == "PLAIN":
        head = system
        piece = lambda m, i: F.when(_nonempty(m["value"]), F.concat(m["value"], seps(i))).otherwise(F.lit(""))
    elif style == "LLAMA_2":
        head = F.lit("")
        wrap_sys = F.when(F.length(system) > 0, F.concat(F.lit("<<SYS>>\n"), system, F.lit("\n<</SYS>>\n\n"))) \
            .otherwise(system)

        def piece(m, i):
            v = m["value"]
            body = F.when(i % 2 == 0, F.concat(F.lit(sep + "[INST] "), v, F.lit(" [/INST]"))) \
                .otherwise(F.concat(F.lit(" "), v, F.lit(" " + sep2)))
            return F.when(_nonempty(v), F.concat(F.when(i == 0, wrap_sys).otherwise(F.lit("")), body)) \
                .otherwise(F.lit(""))
    elif style == "LLAMA_3":
        head = F.lit("")
        wrap_sys = F.when(F.length(system) > 0, F.concat(
            F.lit("<|begin_of_text|><|start_header_id|>system<|end_header_id|>"), system, F.lit("<|eot_id|>"))) \
            .otherwise(system)

        def piece(m, i):
            v = m["value"]
            body = F.when(i % 2 == 0, F.concat(F.lit("<|start_header_id|>user<|end_header_id|>"), v,
                                               F.lit("<|eot_id|>"))) \
                .otherwise(F.concat(F.lit(" <|start_header_id|>assistant<|end_header_id|>"), v, F.lit(" " + sep2)))
            return F.when(_nonempty(v), F.concat(F.when(i == 0, wrap_sys).otherwise(F.lit("")), body)) \
                .otherwise(F.lit(""))
    else:
        raise ValueError(f"Invalid style: {style}")
    return head, piece


def render_prompt(msgs: Column, system: Column, tmpl: tuple) -> Column:
    """Prompt text of ``tmpl`` for a message array."""
    head, piece = style_parts(system, tmpl)
    return F.concat(head, F.concat_ws("", F.transform(msgs, piece)))


def render(records: DataFrame, name: str, out_col: str = "prompt", fewshot: bool = False,
           mmtag: bool = False) -> DataFrame:
    """Render every record with the template registered as ``name``."""
    tmpl = template(name)
    system = F.coalesce(F.col("system"), F.lit(tmpl[0]))
    msgs = F.col("msgs")
    if mmtag:
        msgs = mmtag_rewrite(msgs, F.col("image").isNotNull(), tmpl)
    if fewshot:
        msgs = with_fewshot(msgs, tmpl)
    return records.withColumn(out_col, render_prompt(msgs, system, tmpl))
