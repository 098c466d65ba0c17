"""Chat, image-geometry and metric queries (with their oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.tokens import ids_to_string
from corpusloom.operators import chat, collate, images, metrics
from corpusloom.operators.index import contiguous_index
from corpusloom.operators.joins import bounded_broadcast
from corpusloom.plans import corpus
from corpusloom.plans.dialogue import MODEL_MAX_LENGTH, _message_pairs, _messages, _sft_labelled, clean_records
from corpusloom.plans.dialogue_sql import RECORDS, SFT, WIDE, instead, lit, ntok, strip
from corpusloom.plans.corpus import _HASH32, _PACK
from corpusloom.plans.sqlfrag import ids_str
from corpusloom.sources.testdata import table

NUM_PATCHES = 576  # (336 / 14)^2 patch features per image, class token dropped
MM_BATCH = 4
MODES = ["Pad", "Default", "Crop", "Resize"]


# ---------------------------------------------------------------- chat
def chat_prompt(spark, sf):
    h = chat.chat_history(clean_records(spark, sf))
    return h.select("conv_id", F.size("pairs").cast("bigint").alias("n_pairs"),
                    chat.multi_turn_prompt(F.col("pairs"), F.col("system")).alias("prompt"))


def chat_prompt_pieces(spark, sf):
    """C13 as pair pieces: no chat is gathered into one row."""
    from corpusloom.operators import turns

    return turns.chat_prompt_pieces(*_messages(spark, sf))


def history_trim(spark, sf):
    """H1 at pair level: only the kept pairs of a chat (within the budget) are gathered."""
    from corpusloom.operators import turns

    return turns.trim_history_messages(*_messages(spark, sf), K.CHAT_TOKEN_BUDGET)


def history_trim_records(spark, sf):
    """H1 on dialogue records (the whole chat as one row)."""
    return chat.trim_history(chat.chat_history(clean_records(spark, sf)), K.CHAT_TOKEN_BUDGET)


def history_prompt(spark, sf):
    return chat.history_prompts(clean_records(spark, sf))


def _pairs(spark, sf, said=None):
    p = _message_pairs(spark, sf, said)
    return p.select("conv_id", "pair_no", F.col("user").alias("u"), F.coalesce("assistant", F.lit("")).alias("a"))


def answer_inst(spark, sf, said=None):
    p = _pairs(spark, sf, said).filter(chat.py_strip(F.col("u")) != "")  # P15
    full = chat.single_turn_prompt(F.col("u"), F.lit(K.INFER_DEFAULT_SYSTEM_PROMPT))
    out = F.array(F.struct(F.lit("full").alias("kind"), F.concat(full, F.lit(" "), F.col("a")).alias("o")),
                  F.struct(F.lit("bare").alias("kind"), F.col("a").alias("o")))
    return p.select("conv_id", "pair_no", F.explode(out).alias("x")).select(
        "conv_id", "pair_no", "x.kind", chat.answer_after_inst(F.col("x.o")).alias("answer"))


def answer_inst_wide(spark, sf):
    """P11 and P15 on texts between wide spaces."""
    from corpusloom.plans.dialogue import wide_turns

    return answer_inst(spark, sf, wide_turns(spark, sf))


def answer_assistant(spark, sf):
    p = _pairs(spark, sf)
    full = F.concat(F.lit("USER: "), F.col("u"), F.lit(" ASSISTANT: "), F.col("a"))
    out = F.array(F.struct(F.lit("full").alias("kind"), full.alias("o")),
                  F.struct(F.lit("bare").alias("kind"), F.col("a").alias("o")))
    return p.select("conv_id", "pair_no", F.explode(out).alias("x")).select(
        "conv_id", "pair_no", "x.kind", chat.answer_after_assistant(F.col("x.o")).alias("answer"))


def chat_images(spark, sf):
    """Images of the even (user) turns of image chats."""
    m = _messages(spark, sf)[0].filter(F.col("has_img"))
    return m.filter((F.col("pos") % 2 == 0) & F.col("value").contains(K.IMAGE_TOKEN)).select(
        "conv_id", F.col("pos").cast("bigint").alias("turn"),
        F.concat(F.lit("images/"), F.col("conv_id").cast("string"), F.lit(".jpg")).alias("image"))


# ---------------------------------------------------------------- images
def _manifest(spark, sf):
    """Image folder listing: one computed size per conversation id (no image files ship with the data)."""
    r = table(spark, sf, "conversations").select("conv_id").distinct()
    return r.select("conv_id", F.concat(F.lit("images/"), F.col("conv_id").cast("string"), F.lit(".jpg")).alias("image"),
                    (F.lit(200) + F.pmod(F.col("conv_id") * 37, F.lit(2000))).cast("bigint").alias("w"),
                    (F.lit(200) + F.pmod(F.col("conv_id") * 91, F.lit(2000))).cast("bigint").alias("h"))


def pad_geometry(spark, sf):
    return images.pad_to_square(_manifest(spark, sf)).select("conv_id", "w", "h", "side", "offset_x", "offset_y",
                                                             "background")


def resize_geometry(spark, sf):
    m = _manifest(spark, sf).withColumn("mode", F.element_at(F.array(*[F.lit(x) for x in MODES]),
                                                             (F.pmod("conv_id", F.lit(4)) + 1).cast("int")))
    return images.process_geometry(m).select("conv_id", "mode", "w", "h", "out_w", "out_h")


def _in_batches(spark, sf, rows):
    """Rows of one per conversation with ``batch_id`` and ``pos``: batches of ``MM_BATCH`` by conversation id."""
    # positions come from the conversation ids alone (one row per conversation, a unique join key):
    # the rows themselves are neither indexed nor written
    keys = contiguous_index(table(spark, sf, "conversations").select("conv_id").distinct(), ["conv_id"], "_idx")
    return rows.join(bounded_broadcast(keys), "conv_id").withColumn(
        "batch_id", F.floor(F.col("_idx") / F.lit(MM_BATCH)).cast("bigint")).withColumn(
        "pos", F.pmod("_idx", F.lit(MM_BATCH)).cast("bigint")).drop("_idx")


def _mm_batches(spark, sf, keep_tokens=None):
    """Training rows of the llama-2 family in batches of ``MM_BATCH`` by conversation id.

    The rows come from the message-level masks; with ``keep_tokens`` (the collator's cut) only the pieces starting
    inside the first ``keep_tokens`` ids of a dialogue are gathered, so no row grows with the dialogue.  Without it
    the row of an image dialogue holds all its ids.
    """
    from corpusloom.operators import turns

    m = turns.training_rows(*_messages(spark, sf), "llama_2", MODEL_MAX_LENGTH, keep_tokens=keep_tokens)
    m = m.withColumn("image", F.when(F.col("has_img"), F.concat(
        F.lit("images/"), F.col("conv_id").cast("string"), F.lit(".jpg"))))
    return _in_batches(spark, sf, m.select("conv_id", "image", "input_ids", "labels"))


def collate_mm(spark, sf):
    b = collate.collate_pad(_mm_batches(spark, sf, keep_tokens=MODEL_MAX_LENGTH), K.PAD_ID, max_length=MODEL_MAX_LENGTH)
    # text-only rows never enter the join, where they would all meet on one null key
    sizes = _manifest(spark, sf).select("image", "w", "h")
    none = b.filter(F.col("image").isNull()).withColumns({c: F.lit(None).cast(sizes.schema[c].dataType) for c in ("w", "h")})
    b = b.filter(F.col("image").isNotNull()).join(sizes, "image", "left").unionByName(none)
    c = collate.collate_images(b)
    return c.select("batch_id", "pos", "conv_id", F.size("input_ids").cast("bigint").alias("n_tokens"), "is_blank",
                    F.col("img_h").cast("bigint").alias("img_h"), F.col("img_w").cast("bigint").alias("img_w"),
                    "stackable", ids_to_string("input_ids").alias("input_ids"), ids_to_string("labels").alias("labels"))


def image_expand_plan(spark, sf):
    """G5's plan slot by slot: labels, attention and position ids over all slots of every row."""
    b = collate.collate_pad(_mm_batches(spark, sf), K.PAD_ID)
    e = images.expand_image_tokens(b, NUM_PATCHES)
    return e.select("batch_id", "pos", "n_images", "count_ok", "max_embed_dim", "left_padding", "nb_image_pad",
                    ids_to_string("final_labels").alias("final_labels"),
                    ids_to_string("final_attention").alias("final_attention"),
                    ids_to_string("position_ids").alias("position_ids"))


def image_expand_runs(spark, sf):
    """G5's plan run by run, from message rows: no slot arrays, no row that holds a dialogue."""
    from corpusloom.operators import turns

    cuts, rows = turns.image_rows(*_messages(spark, sf), "llama_2", MODEL_MAX_LENGTH)
    return images.image_runs(cuts, _in_batches(spark, sf, rows), NUM_PATCHES, "conv_id")


def image_count_check(spark, sf):
    """G5's check over the collated batches: a row without an image brings a blank one (B12), so a batch that holds a
    text-only row has more images than image ids and fails."""
    b = collate.collate_pad(_mm_batches(spark, sf, keep_tokens=MODEL_MAX_LENGTH), K.PAD_ID, max_length=MODEL_MAX_LENGTH)
    return images.image_count_check(b.withColumn("n_given", F.lit(1).cast("bigint")))


# ---------------------------------------------------------------- metrics
def eval_loss_masked(spark, sf):
    """M3 with shift and mask: vectors in sequences of eight as scores, every fifth position masked out."""
    e = table(spark, sf, "embeddings")
    rows = e.select(F.floor(F.col("vec_id") / 8).cast("bigint").alias("seq"), F.pmod("vec_id", F.lit(8)).alias("pos"),
                    "embedding", "label", (F.pmod("vec_id", F.lit(5)) > 0).cast("int").alias("mask"))
    out = metrics.shifted_loss(rows, "seq", "pos", "embedding", "label", "mask")
    return out.select(F.round("loss", 6).alias("loss"), "n_tokens")


def accuracy_forms(spark, sf):
    """M2's other forms: hits as a count, weighted by the pair's number, without unsupervised positions."""
    t = _sft_labelled(spark, sf).withColumn("w", F.col("pair_no") + 1)
    forms = {"count": dict(normalize=False), "weighted": dict(weight="w"), "supervised": dict(ignore_index=K.IGNORE_INDEX)}
    out = None
    for name, how in forms.items():
        a = metrics.token_accuracy(t, "input_ids", "labels", **how).select(
            F.lit(name).alias("form"), F.round("accuracy", 6).alias("value"), F.col("n_positions").cast("bigint").alias("n"))
        out = a if out is None else out.unionByName(a)
    return out


def eval_argmax(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").cast("bigint").alias("label"), metrics.argmax(F.col("embedding")).alias("pred"))


def token_accuracy(spark, sf):
    t = _sft_labelled(spark, sf)
    a = metrics.token_accuracy(t, "labels", "labels")
    return a.select(F.round("accuracy", 6).alias("accuracy"), F.col("n_positions").cast("bigint").alias("n_positions"))


def _loss(spark, sf):
    return metrics.masked_loss(table(spark, sf, "embeddings"), "embedding", "label")


def eval_loss(spark, sf):
    return _loss(spark, sf).select(F.round("loss", 6).alias("loss"), "n_tokens")


def eval_perplexity(spark, sf):
    return _loss(spark, sf).select(F.round(metrics.perplexity(F.col("loss")), 6).alias("perplexity"))


def metrics_table(spark, sf):
    blocks = corpus.split_hash(spark, sf)
    counts = blocks.agg(F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).alias("n_train"),
                        F.sum(F.when(F.col("split") == "eval", 1).otherwise(0)).alias("n_eval"))
    loss = _loss(spark, sf)
    c_rows = metrics.metric_rows([("train", "train_samples", F.col("n_train")),
                                  ("eval", "eval_samples", F.col("n_eval"))], counts)
    l_rows = metrics.metric_rows([("eval", "eval_loss", F.col("loss")),
                                  ("eval", "perplexity", metrics.perplexity(F.col("loss")))], loss)
    return c_rows.unionByName(l_rows).withColumn("value", F.round("value", 6))


QUERIES = {
    "chat_prompt": chat_prompt,
    "history_trim": history_trim,
    "chat_prompt_pieces": chat_prompt_pieces,
    "history_trim_records": history_trim_records,
    "history_prompt": history_prompt,
    "answer_inst": answer_inst,
    "answer_assistant": answer_assistant,
    "chat_images": chat_images,
    "pad_geometry": pad_geometry,
    "resize_geometry": resize_geometry,
    "collate_mm": collate_mm,
    "image_expand_plan": image_expand_plan,
    "image_expand_runs": image_expand_runs,
    "eval_argmax": eval_argmax,
    "token_accuracy": token_accuracy,
    "eval_loss": eval_loss,
    "eval_perplexity": eval_perplexity,
    "metrics_table": metrics_table,
    "answer_inst_wide": answer_inst_wide,
    "image_count_check": image_count_check,
    "eval_loss_masked": eval_loss_masked,
    "accuracy_forms": accuracy_forms,
}

# ---------------------------------------------------------------- oracle SQL
SYS_OPEN, SYS_CLOSE = lit(K.CHAT_SYS_OPEN), lit(K.CHAT_SYS_CLOSE)
_CHAT = f"""{RECORDS},
pr AS (SELECT u.conv_id, CAST(u.pos // 2 AS BIGINT) AS pair_no, u.value AS u, coalesce(a.value, '') AS a0
       FROM clean u LEFT JOIN clean a ON a.conv_id = u.conv_id AND a.pos = u.pos + 1 WHERE u.pos % 2 = 0),
np AS (SELECT conv_id, max(pair_no) + 1 AS n FROM pr GROUP BY conv_id),
ch AS (SELECT pr.conv_id, pr.pair_no, pr.u, CASE WHEN pr.pair_no = np.n - 1 THEN '' ELSE pr.a0 END AS a, np.n,
              CASE WHEN coalesce(length(s.system), 0) = 0 THEN {lit(K.CHAT_DEFAULT_SYSTEM_PROMPT)} ELSE s.system END AS sys
       FROM pr JOIN np ON pr.conv_id = np.conv_id LEFT JOIN sys s ON s.conv_id = pr.conv_id)"""
RESP = "CASE WHEN length(a) > 0 THEN ' ' || a ELSE '' END"


_TRIM_PIECES = f"""pl AS (SELECT ch.*, max(CASE WHEN pair_no = n - 1 THEN u END) OVER (PARTITION BY conv_id) AS u_last,
              {ntok(f"{SYS_OPEN} || sys || {SYS_CLOSE} || u || ' [/INST]' || {RESP} || '</s>'")} AS lf,
              {ntok(f"'<s>[INST] ' || u || ' [/INST]' || {RESP} || '</s>'")} AS lm FROM ch),
pl2 AS (SELECT *, {ntok("'<s>[INST] ' || u_last || ' [/INST]'")} AS ll,
               {ntok(f"{SYS_OPEN} || sys || {SYS_CLOSE} || u_last || ' [/INST]'")} AS ls,
               coalesce(sum(CASE WHEN pair_no < n - 1 THEN lm END) OVER (PARTITION BY conv_id ORDER BY pair_no
                        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS mids FROM pl),
tot AS (SELECT conv_id, pair_no AS k, n, 1 + CASE WHEN pair_no = n - 1 THEN ls ELSE lf + mids + ll END AS t FROM pl2),
pick AS (SELECT conv_id, min(k) AS k FROM tot WHERE t <= {K.CHAT_TOKEN_BUDGET} OR k = n - 1 GROUP BY conv_id)"""

ORACLE = {
    "chat_prompt": f"""WITH {_CHAT},
cl AS (SELECT ch.*, max(CASE WHEN pair_no = n - 1 THEN u END) OVER (PARTITION BY conv_id) AS u_last FROM ch)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_pairs,
       CASE WHEN max(n) = 1 THEN {SYS_OPEN} || max(sys) || {SYS_CLOSE} || max(u_last) || ' [/INST]'
       ELSE string_agg(CASE WHEN pair_no = 0 THEN {SYS_OPEN} || sys || {SYS_CLOSE} || u || ' [/INST]' || {RESP} || '</s>'
                            WHEN pair_no < n - 1 THEN '<s>[INST] ' || u || ' [/INST]' || {RESP} || '</s>'
                            ELSE '<s>[INST] ' || u || ' [/INST]' END, '' ORDER BY pair_no) END AS prompt
FROM cl GROUP BY conv_id""",
    "history_trim": f"""WITH {_CHAT}, {_TRIM_PIECES},
kept AS (SELECT pl2.*, pick.k FROM pl2 JOIN pick ON pl2.conv_id = pick.conv_id WHERE pl2.pair_no >= pick.k)
SELECT kept.conv_id, CAST(max(kept.k) AS BIGINT) AS start_pair, CAST(max(kept.n) - max(kept.k) AS BIGINT) AS n_pairs,
       CAST(max(tot.t) AS BIGINT) AS n_tokens,
       CASE WHEN max(kept.n) - max(kept.k) = 1 THEN {SYS_OPEN} || max(kept.sys) || {SYS_CLOSE} || max(kept.u_last) || ' [/INST]'
       ELSE string_agg(CASE WHEN kept.pair_no = kept.k THEN {SYS_OPEN} || kept.sys || {SYS_CLOSE} || kept.u || ' [/INST]'
                                 || CASE WHEN length(kept.a) > 0 THEN ' ' || kept.a ELSE '' END || '</s>'
                            WHEN kept.pair_no < kept.n - 1 THEN '<s>[INST] ' || kept.u || ' [/INST]'
                                 || CASE WHEN length(kept.a) > 0 THEN ' ' || kept.a ELSE '' END || '</s>'
                            ELSE '<s>[INST] ' || kept.u || ' [/INST]' END, '' ORDER BY kept.pair_no) END AS prompt
FROM kept JOIN tot ON tot.conv_id = kept.conv_id AND tot.k = kept.k GROUP BY kept.conv_id""",
    "history_prompt": f"""WITH {RECORDS},
pr AS (SELECT u.conv_id, CAST(u.pos // 2 AS BIGINT) AS pair_no, u.value AS u, coalesce(a.value, '') AS a
       FROM clean u LEFT JOIN clean a ON a.conv_id = u.conv_id AND a.pos = u.pos + 1 WHERE u.pos % 2 = 0),
bl AS (SELECT conv_id, min(pair_no) AS b FROM pr WHERE {strip('u')} = '' GROUP BY conv_id),
lv AS (SELECT pr.* FROM pr LEFT JOIN bl ON pr.conv_id = bl.conv_id WHERE bl.b IS NULL OR pr.pair_no < bl.b),
hs AS (SELECT conv_id, pair_no, u,
              coalesce(string_agg(u || ' [/INST] ' || {strip('a')} || ' [INST] ', '') OVER (PARTITION BY conv_id ORDER BY pair_no
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS hist FROM lv)
SELECT conv_id, pair_no, {SYS_OPEN} || hist || {lit(K.INFER_DEFAULT_SYSTEM_PROMPT)} || {SYS_CLOSE} || u || ' [/INST]' AS prompt
FROM hs""",
    "answer_inst": f"""WITH {RECORDS},
pr AS (SELECT u.conv_id, CAST(u.pos // 2 AS BIGINT) AS pair_no, u.value AS u, coalesce(a.value, '') AS a
       FROM clean u LEFT JOIN clean a ON a.conv_id = u.conv_id AND a.pos = u.pos + 1 WHERE u.pos % 2 = 0),
o AS (SELECT conv_id, pair_no, 'full' AS kind,
             {SYS_OPEN} || {lit(K.INFER_DEFAULT_SYSTEM_PROMPT)} || {SYS_CLOSE} || u || ' [/INST]' || ' ' || a AS o
      FROM pr WHERE {strip('u')} <> ''
      UNION ALL SELECT conv_id, pair_no, 'bare', a FROM pr WHERE {strip('u')} <> '')
SELECT conv_id, pair_no, kind, {strip("string_split(o, '[/INST]')[-1]")} AS answer FROM o""",
    "answer_assistant": f"""WITH {RECORDS},
pr AS (SELECT u.conv_id, CAST(u.pos // 2 AS BIGINT) AS pair_no, u.value AS u, coalesce(a.value, '') AS a
       FROM clean u LEFT JOIN clean a ON a.conv_id = u.conv_id AND a.pos = u.pos + 1 WHERE u.pos % 2 = 0),
o AS (SELECT conv_id, pair_no, 'full' AS kind, 'USER: ' || u || ' ASSISTANT: ' || a AS o FROM pr
      UNION ALL SELECT conv_id, pair_no, 'bare', a FROM pr)
SELECT conv_id, pair_no, kind,
       CASE WHEN contains(o, 'ASSISTANT: ') THEN string_split(o, 'ASSISTANT: ')[-1] ELSE substr(o, 11) END AS answer FROM o""",
    "chat_images": f"""WITH {RECORDS}
SELECT conv_id, pos AS turn, 'images/' || CAST(conv_id AS VARCHAR) || '.jpg' AS image FROM clean
WHERE has_img AND pos % 2 = 0 AND contains(value, '<image>')""",
    "pad_geometry": """SELECT conv_id, w, h, greatest(w, h) AS side,
       CAST(CASE WHEN h > w THEN (h - w) // 2 ELSE 0 END AS BIGINT) AS offset_x,
       CAST(CASE WHEN w > h THEN (w - h) // 2 ELSE 0 END AS BIGINT) AS offset_y, '122,116,104' AS background
FROM (SELECT DISTINCT conv_id, CAST(200 + (conv_id * 37) % 2000 AS BIGINT) AS w, CAST(200 + (conv_id * 91) % 2000 AS BIGINT) AS h
      FROM conversations)""",
    "resize_geometry": f"""WITH m AS (
  SELECT DISTINCT conv_id, CAST(200 + (conv_id * 37) % 2000 AS BIGINT) AS w, CAST(200 + (conv_id * 91) % 2000 AS BIGINT) AS h,
         ['Pad', 'Default', 'Crop', 'Resize'][conv_id % 4 + 1] AS mode FROM conversations),
a AS (SELECT *, CASE mode WHEN 'Pad' THEN greatest(w, h) WHEN 'Resize' THEN 336 ELSE w END AS w1,
             CASE mode WHEN 'Pad' THEN greatest(w, h) WHEN 'Resize' THEN 336 ELSE h END AS h1 FROM m),
b AS (SELECT *, greatest(w1, h1) AS mx, least(w1, h1) AS mn, greatest(w1, h1)::DOUBLE / least(w1, h1)::DOUBLE AS ratio FROM a),
c AS (SELECT *, CAST(trunc(least({K.IMAGE_MAX_LEN} / ratio, {float(K.IMAGE_MIN_LEN)}, mn::DOUBLE)) AS BIGINT) AS sh FROM b),
d AS (SELECT *, CAST(trunc(sh::DOUBLE * ratio) AS BIGINT) AS lo FROM c)
SELECT conv_id, mode, w, h,
       CAST(CASE WHEN mx > {K.IMAGE_MAX_LEN} THEN (CASE WHEN h1 > w1 THEN sh ELSE lo END) ELSE w1 END AS BIGINT) AS out_w,
       CAST(CASE WHEN mx > {K.IMAGE_MAX_LEN} THEN (CASE WHEN h1 > w1 THEN lo ELSE sh END) ELSE h1 END AS BIGINT) AS out_h FROM d""",
    "eval_argmax": "SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS pred FROM embeddings",
    "token_accuracy": f"""WITH {RECORDS}, {SFT},
z AS (SELECT labels, unnest(generate_series(1, len(labels) - 1)) AS i FROM lab WHERE len(labels) > 1)
SELECT round(avg(CASE WHEN labels[i] = labels[i + 1] THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n_positions FROM z""",
    "eval_loss": """WITH s AS (SELECT list_transform(embedding, lambda x: x::DOUBLE) AS e, label FROM embeddings WHERE label <> -100),
n AS (SELECT list_max(e) + ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) - e[label + 1] AS nll FROM s)
SELECT round(avg(nll), 6) AS loss, CAST(count(nll) AS BIGINT) AS n_tokens FROM n""",
    "eval_perplexity": """WITH s AS (SELECT list_transform(embedding, lambda x: x::DOUBLE) AS e, label FROM embeddings WHERE label <> -100),
n AS (SELECT list_max(e) + ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) - e[label + 1] AS nll FROM s)
SELECT round(exp(avg(nll)), 6) AS perplexity FROM n""",
}

_LOSS = """s AS (SELECT list_transform(embedding, lambda x: x::DOUBLE) AS e, label FROM embeddings WHERE label <> -100),
nl AS (SELECT list_max(e) + ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) - e[label + 1] AS nll FROM s)"""
ORACLE["metrics_table"] = f"""WITH {_PACK}, {_LOSS},
sp AS (SELECT CASE WHEN {_HASH32} % 10000 < 500 THEN 'eval' ELSE 'train' END AS split FROM blocks_meta)
SELECT 'train' AS split, 'train_samples' AS metric, round(CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE), 6) AS value FROM sp
UNION ALL SELECT 'eval', 'eval_samples', round(CAST(count(*) FILTER (WHERE split = 'eval') AS DOUBLE), 6) FROM sp
UNION ALL SELECT 'eval', 'eval_loss', round(avg(nll), 6) FROM nl
UNION ALL SELECT 'eval', 'perplexity', round(exp(avg(nll)), 6) FROM nl"""

# collate_mm / image_expand_plan / image_expand_runs: llama_2 masked rows, batches of MM_BATCH in conv_id order
from corpusloom.plans.dialogue_sql import mask_ctes  # noqa: E402

_MM = f"""{mask_ctes('llama_2', MODEL_MAX_LENGTH, True)},
ml AS (SELECT lb.conv_id, list(lb.lab ORDER BY lb.j) AS labels FROM lb GROUP BY lb.conv_id),
mb AS (SELECT tk.conv_id, tk.ids, ml.labels,
              CAST((row_number() OVER (ORDER BY tk.conv_id) - 1) // {MM_BATCH} AS BIGINT) AS batch_id,
              CAST((row_number() OVER (ORDER BY tk.conv_id) - 1) % {MM_BATCH} AS BIGINT) AS pos
       FROM tk JOIN ml ON tk.conv_id = ml.conv_id),
pd AS (SELECT batch_id, pos, conv_id,
              len(ids) AS n_ids,
              list_concat(ids, list_transform(range(max(len(ids)) OVER (PARTITION BY batch_id) - len(ids)), lambda x: {K.PAD_ID})) AS ids,
              list_concat(labels, list_transform(range(max(len(ids)) OVER (PARTITION BY batch_id) - len(labels)), lambda x: -100)) AS labels
       FROM mb)"""

ORACLE["collate_mm"] = f"""WITH {_MM},
geo AS (SELECT pd.*, pd.conv_id % 3 <> 0 AS is_blank,
               CAST(CASE WHEN pd.conv_id % 3 = 0 THEN 200 + (pd.conv_id * 91) % 2000 ELSE 336 END AS BIGINT) AS img_h,
               CAST(CASE WHEN pd.conv_id % 3 = 0 THEN 200 + (pd.conv_id * 37) % 2000 ELSE 336 END AS BIGINT) AS img_w
        FROM pd)
SELECT batch_id, pos, conv_id, CAST(len(ids[1:{MODEL_MAX_LENGTH}]) AS BIGINT) AS n_tokens, is_blank, img_h, img_w,
       (min(img_h) OVER b = max(img_h) OVER b AND min(img_w) OVER b = max(img_w) OVER b
        AND count(DISTINCT img_h * 100000 + img_w) OVER b = 1) AS stackable,
       {ids_str(f'ids[1:{MODEL_MAX_LENGTH}]')} AS input_ids, {ids_str(f'labels[1:{MODEL_MAX_LENGTH}]')} AS labels
FROM geo WINDOW b AS (PARTITION BY batch_id)"""

ORACLE["image_expand_plan"] = f"""WITH {_MM},
mt AS (SELECT *, len(list_filter(ids, lambda x: x = {K.IMAGE_TOKEN_ID})) AS nimg FROM pd),
m2 AS (SELECT *, max(nimg) OVER (PARTITION BY batch_id) * {NUM_PATCHES - 1} + len(ids) AS max_embed_dim,
              NOT bool_or(ids[-1] = {K.PAD_ID}) OVER (PARTITION BY batch_id) AS left_padding FROM mt),
m3 AS (SELECT *, max_embed_dim - len(ids) - nimg * {NUM_PATCHES - 1} AS nb_image_pad FROM m2),
tok AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad,
               unnest(generate_series(1, len(ids))) AS j, unnest(ids) AS id, unnest(labels) AS lab FROM m3),
sl AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad, j,
              unnest(CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN list_transform(range({NUM_PATCHES}), lambda x: x) ELSE [0] END) AS sub,
              CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN -100 ELSE lab END AS l,
              CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN 0 WHEN id <> {K.PAD_ID} THEN 1 ELSE 0 END AS m,
              id <> {K.IMAGE_TOKEN_ID} AS wr FROM tok),
fl AS (SELECT DISTINCT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad FROM m3),
fill AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad,
                CASE WHEN left_padding THEN -1 ELSE 1000000000 END AS j, unnest(range(nb_image_pad)) AS sub,
                -100 AS l, 0 AS m, false AS wr FROM fl),
al AS (SELECT *, row_number() OVER (PARTITION BY batch_id, pos ORDER BY j, sub) - 1 AS q FROM
       (SELECT * FROM sl UNION ALL SELECT * FROM fill)),
im AS (SELECT *, (NOT wr) AND (sum(CASE WHEN wr THEN 0 ELSE 1 END) OVER w - 1 >= nb_image_pad) AS img
       FROM al WINDOW w AS (PARTITION BY batch_id, pos ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
atn AS (SELECT *, CASE WHEN img THEN 1 ELSE m END AS att FROM im),
ps AS (SELECT *, CASE WHEN att = 0 THEN 1 ELSE sum(att) OVER w - 1 END AS pid
       FROM atn WINDOW w AS (PARTITION BY batch_id, pos ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT batch_id, pos, CAST(max(nimg) AS BIGINT) AS n_images,
       sum(CASE WHEN img THEN 1 ELSE 0 END) = max(nimg) * {NUM_PATCHES} AS count_ok,
       CAST(max(max_embed_dim) AS BIGINT) AS max_embed_dim, bool_or(left_padding) AS left_padding,
       CAST(max(nb_image_pad) AS BIGINT) AS nb_image_pad,
       string_agg(CAST(l AS VARCHAR), ',' ORDER BY q) AS final_labels,
       string_agg(CAST(att AS VARCHAR), ',' ORDER BY q) AS final_attention,
       string_agg(CAST(pid AS VARCHAR), ',' ORDER BY q) AS position_ids
FROM ps GROUP BY batch_id, pos"""

ORACLE["image_expand_runs"] = f"""WITH {_MM},
mt AS (SELECT *, len(list_filter(ids, lambda x: x = {K.IMAGE_TOKEN_ID})) AS nimg FROM pd),
m2 AS (SELECT *, max(nimg) OVER (PARTITION BY batch_id) * {NUM_PATCHES - 1} + len(ids) AS max_embed_dim,
              NOT bool_or(ids[-1] = {K.PAD_ID}) OVER (PARTITION BY batch_id) AS left_padding FROM mt),
m3 AS (SELECT *, max_embed_dim - len(ids) - nimg * {NUM_PATCHES - 1} AS nb_image_pad FROM m2),
tok AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad, n_ids,
               unnest(generate_series(1, len(ids))) AS j, unnest(ids) AS id, unnest(labels) AS lab FROM m3),
sl AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad, j, id = {K.PAD_ID} AND j > n_ids AS tail,
              unnest(CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN list_transform(range({NUM_PATCHES}), lambda x: x) ELSE [0] END) AS sub,
              CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN -100 ELSE lab END AS l,
              CASE WHEN id = {K.IMAGE_TOKEN_ID} THEN 0 WHEN id <> {K.PAD_ID} THEN 1 ELSE 0 END AS m,
              id <> {K.IMAGE_TOKEN_ID} AS wr FROM tok),
fl AS (SELECT DISTINCT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad FROM m3),
fill AS (SELECT batch_id, pos, nimg, max_embed_dim, left_padding, nb_image_pad,
                CASE WHEN left_padding THEN -1 ELSE 1000000000 END AS j, false AS tail, unnest(range(nb_image_pad)) AS sub,
                -100 AS l, 0 AS m, false AS wr FROM fl),
al AS (SELECT *, row_number() OVER (PARTITION BY batch_id, pos ORDER BY j, sub) - 1 AS q FROM
       (SELECT * FROM sl UNION ALL SELECT * FROM fill)),
im AS (SELECT *, (NOT wr) AND (sum(CASE WHEN wr THEN 0 ELSE 1 END) OVER w - 1 >= nb_image_pad) AS img
       FROM al WINDOW w AS (PARTITION BY batch_id, pos ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
atn AS (SELECT *, CASE WHEN img THEN 1 ELSE m END AS att FROM im),
ps AS (SELECT *, CASE WHEN att = 0 THEN 1 ELSE sum(att) OVER w - 1 END AS pid
       FROM atn WINDOW w AS (PARTITION BY batch_id, pos ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kd AS (SELECT *, CASE WHEN wr AND m = 0 THEN 'pad' WHEN wr THEN 'text' WHEN img THEN 'image' ELSE 'gap' END AS kind,
              wr AND l <> -100 AS sup FROM ps),
-- runs: text as far as it is alike, each image or pad id by itself, the padding as one
rk AS (SELECT *, kind || sup::VARCHAR || CASE WHEN kind = 'text' THEN '' WHEN tail THEN 'tail' ELSE j::VARCHAR END AS alike FROM kd),
bg AS (SELECT *, (alike IS DISTINCT FROM lag(alike) OVER (PARTITION BY batch_id, pos ORDER BY q))::INT AS begins FROM rk),
rn AS (SELECT *, sum(begins) OVER (PARTITION BY batch_id, pos ORDER BY q) AS run FROM bg)
SELECT batch_id, pos, min(q)::BIGINT AS start, count(*) AS length, any_value(kind) AS kind, bool_and(att = 1) AS attended,
       min(pid)::BIGINT AS position, CASE WHEN any_value(kind) IN ('text', 'pad') THEN (min(j) - 1)::BIGINT END AS source,
       any_value(sup) AS supervised, max(max_embed_dim)::BIGINT AS max_embed_dim, bool_or(left_padding) AS left_padding,
       max(nb_image_pad)::BIGINT AS nb_image_pad
FROM rn GROUP BY batch_id, pos, run"""

ORACLE["history_trim_records"] = ORACLE["history_trim"]
ORACLE["chat_prompt_pieces"] = f"""WITH {_CHAT}
SELECT conv_id, pair_no,
       CASE WHEN n = 1 THEN {SYS_OPEN} || sys || {SYS_CLOSE} || u || ' [/INST]'
            WHEN pair_no = 0 THEN {SYS_OPEN} || sys || {SYS_CLOSE} || u || ' [/INST]' || {RESP} || '</s>'
            WHEN pair_no < n - 1 THEN '<s>[INST] ' || u || ' [/INST]' || {RESP} || '</s>'
            ELSE '<s>[INST] ' || u || ' [/INST]' END AS piece
FROM ch"""

ORACLE["answer_inst_wide"] = instead("wide", WIDE, ORACLE["answer_inst"])
ORACLE["image_count_check"] = f"""WITH q AS ({ORACLE['collate_mm']})
SELECT batch_id, CAST(sum(len(list_filter(string_split(input_ids, ','), lambda x: x = '{K.IMAGE_TOKEN_ID}'))) AS BIGINT)
         AS n_image_tokens, count(*) AS n_given,
       sum(len(list_filter(string_split(input_ids, ','), lambda x: x = '{K.IMAGE_TOKEN_ID}'))) = count(*) AS count_ok
FROM q GROUP BY batch_id"""
ORACLE["eval_loss_masked"] = """WITH t AS (
  SELECT list_transform(embedding, lambda x: x::DOUBLE) AS e,
         lead(label) OVER w AS label, lead(vec_id % 5 > 0) OVER w AS seen
  FROM embeddings WINDOW w AS (PARTITION BY vec_id // 8 ORDER BY vec_id % 8)),
n AS (SELECT list_max(e) + ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) - e[label + 1] AS nll
      FROM t WHERE seen AND label <> -100)
SELECT round(avg(nll), 6) AS loss, count(nll) AS n_tokens FROM n"""
ORACLE["accuracy_forms"] = f"""WITH {RECORDS}, {SFT},
z AS (SELECT pair_no + 1.0::DOUBLE AS w, ids[i] AS p, labels[i + 1] AS l
      FROM (SELECT *, unnest(generate_series(1, len(labels) - 1)) AS i FROM lab WHERE len(labels) > 1))
SELECT 'count' AS form, round(sum(CASE WHEN p = l THEN 1.0::DOUBLE ELSE 0 END), 6) AS value, count(*) AS n FROM z
UNION ALL SELECT 'weighted', round(sum(CASE WHEN p = l THEN w ELSE 0 END) / sum(w), 6), CAST(sum(w) AS BIGINT) FROM z
UNION ALL SELECT 'supervised', round(avg(CASE WHEN p = l THEN 1.0::DOUBLE ELSE 0 END), 6), count(*) FROM z WHERE l <> -100"""
