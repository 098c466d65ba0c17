"""Dialogues at message level: no conversation is ever gathered into one row.

``dialogue.records_from_turns`` groups a conversation into one array row,
which is the natural form for ordinary dialogues.  This module does the same
work one message per row so that a single conversation holding a large share
of all turns is spread over many tasks:

* ``index_messages``: a global position ``g`` in (conversation, turn) order
  from ``contiguous_index`` (range partitioning on unique keys, so a hot
  conversation covers many partitions).  Its checkpoint holds the message
  rows themselves and serves as the materialized message table that every
  later branch reads (indexing only the keys and joining the text back was
  measured slower: each branch then re-reads and re-shuffles the text).
* per-conversation values (first message, system text, ...) are partial
  aggregates; they travel back to the messages by ``spread_back``, a join on
  (bucket of ``g``, conversation): each join group holds at most one bucket
  of messages.
* running sums and "next message" lookups inside a conversation use
  ``segmented_scan``: windows over (bucket, conversation), at most
  ``BUCKET_ROWS`` rows each, plus a carry table with one row per
  (bucket, conversation).

The rendered prompt is kept as pieces ``(conv_id, pos, piece)`` whose
concatenation in ``pos`` order is the prompt of ``render.render`` (template
messages of C8/C9 included); the label masks of the llama-2, llama-3 and
two-separator formats are computed from separator events located in those
pieces (``mask_from_pieces``) and reported as a per-conversation summary plus
the supervised token ranges.  Pairs (C10), word counts (B1), the multi-turn
chat prompt (C13) and history trimming (H1) work on pair rows the same way;
trimming gathers only the pairs it keeps, which the token budget bounds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import py_strip, regex_quote, word_count
from corpusloom.functions.tokens import _SPECIAL_PIECE_PATTERN, _SPECIAL_STRINGS, n_tokens
from corpusloom.operators.dialogue import GPT, HUMAN, system_text
from corpusloom.operators.index import contiguous_index
from corpusloom.operators.masks import FAMILIES
from corpusloom.operators.render import style_parts, template
from corpusloom.session import checkpoint_root

BUCKET_ROWS = 1 << 16


def _bucket(c: str) -> Column:
    return F.floor(F.col(c) / F.lit(BUCKET_ROWS)).cast("bigint")


def spread_back(rows: DataFrame, key: str, bucket: str, per_key: DataFrame) -> DataFrame:
    """Join one row per ``key`` back onto ``rows`` without a hot join key.

    The per-key values are first joined to the distinct (bucket, key) pairs
    of ``rows`` (a hot key has one pair per bucket it spans), then to the rows
    on (bucket, key), where a group holds at most one bucket of rows.
    """
    pairs = rows.select(bucket, key).distinct()
    return rows.join(pairs.join(per_key, key), [bucket, key])


def segmented_scan(df: DataFrame, key: str, order: str, sums: list[str], ahead: str | None = None) -> DataFrame:
    """Per ``key`` in ``order`` order: ``<s>_before`` = exclusive running sum of each column of ``sums``,
    and ``<ahead>_next`` = the next non-null value of ``ahead`` (null at the end).

    ``order`` is a BIGINT position.  Inside (bucket of ``BUCKET_ROWS`` positions,
    key) the windows are bounded; across buckets a carry table with one row per
    (bucket, key) adds the earlier buckets' totals and the later buckets' first
    non-null ``ahead``.
    """
    x = df.withColumn("_sb", _bucket(order))
    w = Window.partitionBy("_sb", key).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    aggs = [F.sum(s).alias(f"_t_{s}") for s in sums]
    for s in sums:
        x = x.withColumn(f"_in_{s}", F.coalesce(F.sum(s).over(before), F.lit(0)))
    if ahead:
        x = x.withColumn("_in_ahead", F.first(ahead, ignorenulls=True).over(after))
        aggs.append(F.min(F.when(F.col(ahead).isNotNull(), F.struct(F.col(order).alias("o"), F.col(ahead).alias("a"))))
                    ["a"].alias("_t_ahead"))
    carry = df.withColumn("_sb", _bucket(order)).groupBy("_sb", key).agg(*aggs)
    # one row per (bucket, key): a key spanning many buckets has one row per bucket here
    wk = Window.partitionBy(key).orderBy("_sb")
    cols = [F.coalesce(F.sum(f"_t_{s}").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            .alias(f"_c_{s}") for s in sums]
    if ahead:
        cols.append(F.first("_t_ahead", ignorenulls=True).over(wk.rowsBetween(1, Window.unboundedFollowing))
                    .alias("_c_ahead"))
    carry = carry.select("_sb", key, *cols)
    out = x.join(carry, ["_sb", key])
    for s in sums:
        out = out.withColumn(f"{s}_before", (F.col(f"_c_{s}") + F.col(f"_in_{s}")).cast("bigint"))
    if ahead:
        out = out.withColumn(f"{ahead}_next", F.coalesce("_in_ahead", "_c_ahead"))
    drop = ["_sb", "_in_ahead", "_c_ahead"] + [f"_in_{s}" for s in sums] + [f"_c_{s}" for s in sums]
    return out.drop(*drop)


# ---------------------------------------------------------------------------
# messages
# ---------------------------------------------------------------------------

def index_messages(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Non-system turns -> (key, g, from, value, _b); ``g`` = global position in (key, turn) order."""
    frm = F.when(F.col(role) == "user", F.lit(HUMAN)).when(F.col(role) == "assistant", F.lit(GPT)).otherwise(
        F.col(role))
    m = turns.filter(F.col(role) != "system").select(key, turn, frm.alias("from"), F.col(text).alias("value"))
    return contiguous_index(m, [key, turn], "g").withColumn("_b", _bucket("g")).drop(turn)


STAGES = ("raw", "placeholder", "clean")


def conversation_messages(turns: DataFrame, has_image, key: str = "conv_id",
                          stage: str = "clean") -> tuple[DataFrame, DataFrame]:
    """Messages one row each: the image mark of the fixture rule, then P5, then P7.

    ``stage`` stops after the mark (``raw``), after P5 (``placeholder``) or
    after P7 (``clean``).  ``has_image(key_col)`` is a row-local rule.
    Returns ``(msgs, convs)``: ``msgs`` = (key, g, pos, from, value, has_img,
    n_msgs, _b) with ``pos`` the 0-based position among the kept messages and
    ``n_msgs`` their number in the conversation; ``convs`` = (key, system,
    has_img), one row per conversation (also those without messages).
    """
    if stage not in STAGES:
        raise ValueError(stage)
    idx = index_messages(turns, key)
    stats = idx.groupBy(key).agg(
        F.min("g").alias("_g0"),
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct("g", "from"))["from"].alias("_first_from"),
        F.min(F.when(F.col("from") == HUMAN, F.col("g"))).alias("_fh"),
    )
    m = spread_back(idx, key, "_b", stats)
    img = has_image(F.col(key))
    tok = K.IMAGE_TOKEN
    # the fixture rule: '\n<image>' after the first human message of an image conversation
    v = F.when(img & (F.col("g") == F.col("_fh")), F.concat("value", F.lit("\n" + tok))).otherwise(F.col("value"))
    if stage != "raw":  # P5
        moved = py_strip(F.concat(F.lit(tok + "\n"), py_strip(F.replace(v, F.lit(tok), F.lit("")))))
        v = F.when(img & (F.instr(v, tok) > 0), moved).otherwise(v)
    # The first message is skipped when it is not from the human
    drop = F.when(F.col("_first_from") != HUMAN, F.lit(1)).otherwise(F.lit(0)) if stage == "clean" else F.lit(0)
    msgs = (m.withColumn("value", v).withColumn("has_img", img)
            .filter(F.col("g") >= F.col("_g0") + drop)
            .withColumn("pos", (F.col("g") - F.col("_g0") - drop).cast("bigint"))
            .withColumn("n_msgs", (F.col("_n") - drop).cast("bigint"))
            .select(key, "g", "pos", "from", "value", "has_img", "n_msgs", "_b"))
    convs = turns.groupBy(key).agg(system_text().alias("system")) \
        .withColumn("has_img", img)
    return msgs, convs


def rejected(msgs: DataFrame, convs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Why a conversation cannot be rendered or sampled: (key, reason), one row per reason.

    ``role_order`` (P8): message j is not from roles[j % 2]; ``empty_first`` (C4 / C5): the first
    message is empty or null; ``no_words`` (B3): no message holds a word.  All are partial
    aggregates per conversation; the message texts are not gathered.
    """
    want = F.when(F.col("pos") % 2 == 0, F.lit(HUMAN)).otherwise(F.lit(GPT))
    first_empty = (F.col("pos") == 0) & (F.coalesce(F.col("value"), F.lit("")) == "")
    per = msgs.groupBy(key).agg(
        F.coalesce(F.bool_and(F.col("from").eqNullSafe(want)), F.lit(True)).alias("order_ok"),
        F.max(first_empty).alias("first_empty"),
        F.sum(word_count(F.coalesce(F.col("value"), F.lit("")))).alias("words"))
    found = convs.select(key).join(per, key, "left")
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce("order_ok", F.lit(True)), F.lit("role_order")),
        F.when(F.col("first_empty"), F.lit("empty_first")),
        F.when(F.coalesce("words", F.lit(0)) == 0, F.lit("no_words"))))
    return found.select(key, F.explode(reasons).alias("reason"))


def message_pairs(msgs: DataFrame, convs: DataFrame, key: str = "conv_id", offset: int = 0) -> DataFrame:
    """C10 at message level: (key, pair_no, user, assistant, system); missing answer null.

    ``offset`` leaves out that many messages in front (a template's examples).
    Message 2p and message 2p + 1 meet on (key, pair_no): at most one row per
    side and key.  The system text arrives by ``spread_back``.
    """
    if offset:
        msgs = msgs.filter(F.col("pos") >= offset).withColumn("pos", F.col("pos") - F.lit(offset))
    pair = F.floor(F.col("pos") / 2).cast("bigint").alias("pair_no")
    users = msgs.filter(F.col("pos") % 2 == 0).select(key, pair, F.col("value").alias("user"), "_b")
    answers = msgs.filter(F.col("pos") % 2 == 1).select(key, pair, F.col("value").alias("assistant"))
    pairs = users.join(answers, [key, "pair_no"], "left")
    return spread_back(pairs, key, "_b", convs.select(key, "system")).select(
        key, "pair_no", "user", "assistant", "system")


def conversation_word_counts(msgs: DataFrame, convs: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, has_image, words): whitespace words over all messages, a partial aggregate per conversation."""
    words = msgs.groupBy(key).agg(F.sum(word_count(F.col("value"))).alias("words"))
    return convs.join(words, key, "left").select(key, F.col("has_img").alias("has_image"),
                                                 F.coalesce("words", F.lit(0)).cast("bigint").alias("words"))


# ---------------------------------------------------------------------------
# rendering
# ---------------------------------------------------------------------------

def render_pieces(msgs: DataFrame, convs: DataFrame, name: str, key: str = "conv_id") -> DataFrame:
    """(key, pos, g, piece): pos -1 is the head, then one piece per message.

    Only the first message's piece reads the system text; that join has one
    row per conversation on each side.
    """
    tmpl = template(name)
    system = F.coalesce(F.col("system"), F.lit(tmpl[0]))
    head, piece = style_parts(system, tmpl)
    m = F.struct(F.col("from").alias("from"), F.col("value").alias("value"))
    first = msgs.filter(F.col("pos") == 0).join(convs.select(key, "system"), key)
    rest = msgs.filter(F.col("pos") > 0).withColumn("system", F.lit(None).cast("string"))
    body = first.unionByName(rest).select(key, "pos", "g", piece(m, F.col("pos")).alias("piece"), "has_img")
    heads = convs.select(key, F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("bigint").alias("g"),
                         head.alias("piece"), "has_img")
    return heads.unionByName(body)


def template_messages(msgs: DataFrame, convs: DataFrame, name: str, mmtag: bool = False, fewshot: bool = False,
                      key: str = "conv_id") -> DataFrame:
    """C8 / C9 at message level: the template's extra messages in front, later positions shifted.

    ``mmtag``: in an image conversation the first message loses '<image>' and is
    stripped; mmtag versions put two fixed turns before it, the others prefix
    it with '<image>\\n'.  ``fewshot``: the template's example messages come
    first in every conversation.  Added rows come from one row per
    conversation (its first message, or the conversation table).
    """
    tmpl = template(name)
    cols = [key, "g", "pos", "from", "value", "has_img"]
    out = msgs.select(*cols)
    if mmtag:
        tagged = "mmtag" in tmpl[7]
        img_first = (F.col("pos") == 0) & F.col("has_img")
        stripped = py_strip(F.replace(F.col("value"), F.lit(K.IMAGE_TOKEN), F.lit("")))
        value = F.when(img_first, stripped if tagged else F.concat(F.lit(K.IMAGE_TOKEN + "\n"), stripped)) \
            .otherwise(F.col("value"))
        shift = F.when(F.col("has_img"), F.lit(2 if tagged else 0)).otherwise(F.lit(0))
        out = out.withColumn("value", value).withColumn("pos", (F.col("pos") + shift).cast("bigint"))
        if tagged:
            firsts = msgs.filter((F.col("pos") == 0) & F.col("has_img")).select(key, "has_img")
            for i, (frm, text) in enumerate([(HUMAN, "<Image><image></Image>"), (GPT, "Received.")]):
                out = out.unionByName(firsts.select(key, F.lit(None).cast("bigint").alias("g"),
                                                    F.lit(i).cast("bigint").alias("pos"), F.lit(frm).alias("from"),
                                                    F.lit(text).alias("value"), "has_img"))
    if fewshot and tmpl[2]:
        shots = tmpl[2]
        out = out.withColumn("pos", (F.col("pos") + F.lit(len(shots))).cast("bigint"))
        for i, (role, text) in enumerate(shots):
            frm = HUMAN if role == tmpl[1][0] else GPT
            out = out.unionByName(convs.select(key, F.lit(None).cast("bigint").alias("g"),
                                               F.lit(i).cast("bigint").alias("pos"), F.lit(frm).alias("from"),
                                               F.lit(text).alias("value"), "has_img"))
    return out


# ---------------------------------------------------------------------------
# label masks from pieces (llama-2 / llama-3 formats)
# ---------------------------------------------------------------------------

def literal_tokens(s: str) -> int:
    """Token count of a literal under the byte tokenizer (special strings are one token)."""
    return sum(1 if p in _SPECIAL_STRINGS else len(p.encode("utf-8"))
               for p in re.findall(_SPECIAL_PIECE_PATTERN.replace("\\z", ""), s))


def _occurrences(text: Column, look: Column, sep: str) -> Column:
    """ARRAY<STRUCT<c, t>>: char and token offsets (0-based) of the occurrences of ``sep`` that start in
    ``text``; ``look`` is the text that follows (so that an occurrence may run past the end)."""
    parts = F.split(F.concat(text, F.coalesce(look, F.lit(""))), regex_quote(sep), -1)
    sep_c, sep_t = len(sep), literal_tokens(sep)
    zero = F.struct(F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("t"),
                    F.array().cast("array<struct<c:int,t:bigint>>").alias("occ"))

    def step(acc, pt):
        c = acc["c"] + F.length(pt)
        t = acc["t"] + n_tokens(pt)
        return F.struct((c + F.lit(sep_c)).alias("c"), (t + F.lit(sep_t)).alias("t"),
                        F.concat(acc["occ"], F.array(F.struct(c.alias("c"), t.alias("t")))).alias("occ"))

    walked = F.aggregate(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), zero, step)
    return F.filter(walked["occ"], lambda o: o["c"] < F.length(text))


def _check_template(name: str, sep2: str, inst: str) -> int:
    """Lookahead width for the instruction separator, after checking the piece shapes it relies on.

    Pieces end with a fixed literal (message pieces of the llama-2/3 formats;
    pair pieces, user + answer, of the two-separator format); when no proper
    prefix of the round separator (or of ``<pad>``) ends that literal, those
    strings never run across two pieces.  The instruction separator may (it
    spans the user/assistant boundary), so each piece looks at the first
    characters of the next non-empty piece, which is never shorter than the
    lookahead.
    """
    tmpl = template(name)
    style, roles, sep = tmpl[4], tmpl[1], tmpl[5]
    if style == "LLAMA_2":
        endings, shortest = [" [/INST]", " " + sep2], len("  " + sep2) + 1
    elif style == "LLAMA_3":
        endings, shortest = ["<|eot_id|>", " " + sep2], len(" <|start_header_id|>assistant<|end_header_id|>")
    elif style == "TWO":
        # a pair piece ends with the answer's sep2, an empty answer 'ROLE:', or (last pair only) the user's sep
        endings, shortest = [sep2, ":", sep], len(roles[0]) + len(roles[1]) + 2
    else:
        raise ValueError(f"message-level masks cover the llama-2/3 and two-separator formats, not {style}")
    for s in (sep2, K.PAD_TOKEN):
        if any(e.endswith(s[:j]) for e in endings for j in range(1, len(s))):
            raise ValueError(f"{s!r} may run across two pieces")
    width = len(inst) - 1
    if shortest < width:
        raise ValueError("a piece may be shorter than the separator lookahead")
    return width


def mask_from_pieces(pieces: DataFrame, convs: DataFrame, family: str, model_max_length: int,
                     legacy: bool = True, key: str = "conv_id", with_pieces: bool = False):
    """The label walk of ``masks.apply_mask`` on message pieces.

    Returns ``(summary, segments)``: summary = (key, n_tokens, n_supervised,
    status) per conversation; segments = (key, round, lo, hi) the supervised
    label positions [lo, hi) of each round (ids positions, BOS = 0), none for
    rejected rows.  Text-only conversations are cut to ``model_max_length``.
    ``with_pieces`` also returns the located pieces (their text, token offset
    and round numbers) for ``training_rows``.

    Rounds are the text between round-separator events; an instruction
    separator event belongs to the round open at its position.  All positions
    are token offsets: piece offset (running sum) + offset inside the piece.
    """
    from corpusloom.operators.masks import _inst_sep

    name, _, minus = FAMILIES[family]
    sep2 = template(name)[6]
    inst = _inst_sep(family)
    width = _check_template(name, sep2, inst)
    sep2_t, inst_t = literal_tokens(sep2), literal_tokens(inst)
    mx = F.lit(model_max_length)

    # heads are empty (llama-2/3) or folded into pair 0; pieces in message order
    p = (pieces.filter(F.col("pos") >= 0)
         .withColumn("ntok", n_tokens(F.col("piece")))
         .withColumn("_s2", _occurrences(F.col("piece"), F.lit(""), sep2))
         .withColumn("nsep", F.size("_s2").cast("bigint"))
         .withColumn("_head", F.when(F.length("piece") > 0, F.substring("piece", 1, width))))
    p = segmented_scan(p, key, "g", ["ntok", "nsep"], ahead="_head")
    p = p.withColumn("_in", _occurrences(F.col("piece"), F.col("_head_next"), inst)) \
        .withColumn("_pad", _occurrences(F.col("piece"), F.lit(""), K.PAD_TOKEN))
    # the located pieces feed three branches (round bounds, instruction events, totals): written once
    checkpoint_root(p.sparkSession)
    kept_cols = [key, "has_img", "ntok", "ntok_before", "nsep", "nsep_before", "_s2", "_in", "_pad"]
    p = p.select(*kept_cols, *(["pos", "piece"] if with_pieces else [])).checkpoint(eager=True)
    off = F.col("ntok_before")
    nul = F.lit(None).cast("bigint")

    # the k-th round-separator event of a piece ends round nsep_before + k and starts the next one
    sep_rows = p.select(key, "nsep_before", "ntok_before", F.posexplode("_s2").alias("k", "o"))
    ev_t = off + F.col("o.t")
    rnd = F.col("nsep_before") + F.col("k")
    bounds = sep_rows.select(key, rnd.alias("round"), nul.alias("start"), ev_t.alias("end"),
                             F.lit(0).alias("n_inst"), nul.alias("inst_end")).unionByName(
        sep_rows.select(key, (rnd + 1).alias("round"), (ev_t + F.lit(sep2_t)).alias("start"), nul.alias("end"),
                        F.lit(0).alias("n_inst"), nul.alias("inst_end")))
    inst_rows = p.select(key, "_s2", "nsep_before", "ntok_before", F.explode("_in").alias("o")).select(
        key, (F.col("nsep_before") + F.size(F.filter("_s2", lambda s: s["c"] < F.col("o.c")))).alias("round"),
        nul.alias("start"), nul.alias("end"), F.lit(1).alias("n_inst"),
        (off + F.col("o.t") + F.lit(inst_t)).alias("inst_end"))

    # per conversation: total tokens, sep2 count, pads inside the kept ids (partial aggregates)
    trunc = ~F.col("has_img")
    pads_in = F.size(F.filter("_pad", lambda o: ~trunc | (F.lit(1) + off + o["t"] < mx)))
    totals = p.groupBy(key).agg(F.sum("ntok").alias("total"), F.sum("nsep").alias("nsep"),
                                F.sum(pads_in).alias("pads"))
    conv = convs.select(key, "has_img").join(totals, key, "left").select(
        key, "has_img", F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
        F.coalesce("nsep", F.lit(0)).cast("bigint").alias("nsep"), F.coalesce("pads", F.lit(0)).alias("pads"))
    # first round starts at 0, the last one ends at the total (one row per conversation each)
    edges = conv.select(key, F.lit(0).cast("bigint").alias("round"), F.lit(0).cast("bigint").alias("start"),
                        F.lit(None).cast("bigint").alias("end"), F.lit(0).alias("n_inst"),
                        F.lit(None).cast("bigint").alias("inst_end")).unionByName(
        conv.select(key, F.col("nsep").alias("round"), F.lit(None).cast("bigint").alias("start"),
                    F.col("total").alias("end"), F.lit(0).alias("n_inst"), F.lit(None).cast("bigint").alias("inst_end")))
    rounds = bounds.unionByName(inst_rows).unionByName(edges).groupBy(key, "round").agg(
        F.max("start").alias("start"), F.max("end").alias("end"), F.sum("n_inst").alias("n_inst"),
        F.min("inst_end").alias("inst_end"))

    r = F.col("round")
    if family == "default" and not legacy:
        adj, adj_before = F.when(r != 0, F.lit(-1)).otherwise(F.lit(0)), -F.greatest(r - 1, F.lit(0))
    elif family == "llama_3" and legacy:
        adj, adj_before = F.when(r != 0, F.lit(1)).otherwise(F.lit(0)), F.greatest(r - 1, F.lit(0))
    else:
        adj, adj_before = F.lit(0), F.lit(0)
    rounds = rounds.select(
        key, "round",
        ((F.col("end") > F.col("start")) & (F.col("n_inst") == 1)).alias("ok"),
        (F.lit(1) + F.col("end") - F.col("start") + adj).alias("rl"),
        (F.lit(1) + F.col("inst_end") - F.col("start") - F.lit(minus) + adj).alias("il"),
        (F.lit(1) + F.col("start") + adj_before).alias("cur"),
    )
    rounds = rounds.checkpoint(eager=True)  # read by the walk summary and by the kept ranges
    walk = rounds.groupBy(key).agg(
        F.min(F.when(~F.col("ok"), F.struct("round", "cur"))).alias("_fb"),
        F.sum("rl").alias("_all"),
    )
    summary = conv.join(walk, key, "left").select(
        key, "has_img", F.col("_fb.round").alias("first_bad"),
        F.coalesce(F.col("_fb.cur"), F.lit(1) + F.coalesce("_all", F.lit(0))).alias("cur_len"),
        F.when(F.col("has_img"), F.lit(1) + F.col("total")).otherwise(F.least(F.lit(1) + F.col("total"), mx))
        .cast("bigint").alias("n_tokens"),
        "pads")
    summary = summary.withColumn(
        "rejected", (F.col("cur_len") < mx) & (F.col("cur_len") != F.col("n_tokens") - F.col("pads")))
    # supervised ranges of the rounds walked before the first bad one
    kept = rounds.filter(F.col("ok")).withColumn("_rb", _bucket("round"))
    info = summary.select(key, "first_bad", "n_tokens", "rejected")
    kept = spread_back(kept, key, "_rb", info).filter(
        ~F.col("rejected") & (F.col("first_bad").isNull() | (F.col("round") < F.col("first_bad"))))
    segments = kept.select(
        key, F.col("round").cast("bigint").alias("round"),
        F.greatest(F.col("cur") + F.col("il"), F.lit(0)).cast("bigint").alias("lo"),
        F.least(F.col("cur") + F.col("rl"), F.col("n_tokens")).cast("bigint").alias("hi"),
    ).filter(F.col("hi") > F.col("lo"))
    sup = segments.groupBy(key).agg(F.sum(F.col("hi") - F.col("lo")).alias("_sup"))
    out = summary.join(sup, key, "left").select(
        key, "n_tokens", F.coalesce("_sup", F.lit(0)).cast("bigint").alias("n_supervised"),
        F.when(F.col("rejected"), F.lit("mismatch")).otherwise(F.lit("ok")).alias("status"))
    return (out, segments, p) if with_pieces else (out, segments)


def training_rows(msgs: DataFrame, convs: DataFrame, family: str, model_max_length: int, legacy: bool = True,
                  keep_tokens: int | None = None, key: str = "conv_id") -> DataFrame:
    """(key, has_img, input_ids, labels): the token rows of ``masks.mask_dialogues``, built from pieces.

    Each piece is tokenized on its own (its first token sits at 1 + the
    running token count); its labels keep the ids inside the supervised
    ranges of the rounds it touches (an equi-join on (key, round)).  Only the
    pieces that start inside the kept ids are gathered per dialogue: the first
    ``keep_tokens`` tokens of every row when given (the collator's cut),
    otherwise ``model_max_length`` for text rows and everything for image rows.
    """
    from corpusloom.functions.tokens import encode_with_specials

    name = FAMILIES[family][0]
    style = template(name)[4]
    cut_pieces = render_pieces if style in ("LLAMA_2", "LLAMA_3") else render_pair_pieces
    summary, segments, located = mask_from_pieces(cut_pieces(msgs, convs, name, key), convs, family,
                                                  model_max_length, legacy, key, with_pieces=True)
    start = F.lit(1) + F.col("ntok_before")
    if keep_tokens is not None:
        cut = F.lit(keep_tokens)
    else:
        cut = F.when(F.col("has_img"), F.lit(None).cast("bigint")).otherwise(F.lit(model_max_length))
    lp = located.withColumn("_start", start).withColumn("_cut", cut) \
        .filter(F.col("_cut").isNull() | (F.col("_start") < F.col("_cut")))
    touched = lp.select(key, "pos", F.explode(F.sequence("nsep_before", F.col("nsep_before") + F.col("nsep")))
                        .alias("round"))
    segs = touched.join(segments, [key, "round"]).groupBy(key, "pos").agg(
        F.collect_list(F.struct("lo", "hi")).alias("_segs"))
    lp = lp.join(segs, [key, "pos"], "left")
    ids = encode_with_specials(F.col("piece"), bos=False)
    lp = lp.withColumn("_ids", ids).withColumn("_labels", F.transform("_ids", lambda x, j: F.when(
        F.exists(F.coalesce("_segs", F.array().cast("array<struct<lo:bigint,hi:bigint>>")),
                 lambda sg: (F.col("_start") + j >= sg["lo"]) & (F.col("_start") + j < sg["hi"])), x)
        .otherwise(F.lit(K.IGNORE_INDEX))))
    # bounded by the kept tokens (or the whole dialogue for an uncut image row, which is that row's size)
    rows = lp.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "_ids", "_labels"))).alias("_p"))
    body = convs.select(key, "has_img").join(rows, key, "left")
    ids_all = F.concat(F.array(F.lit(K.BOS_ID)), F.flatten(F.transform(
        F.coalesce("_p", F.array().cast(rows.schema["_p"].dataType)), lambda x: x["_ids"])))
    labels_all = F.concat(F.array(F.lit(K.IGNORE_INDEX)), F.flatten(F.transform(
        F.coalesce("_p", F.array().cast(rows.schema["_p"].dataType)), lambda x: x["_labels"])))
    cut_all = F.lit(keep_tokens) if keep_tokens is not None else F.when(
        F.col("has_img"), F.size(ids_all)).otherwise(F.lit(model_max_length))
    return body.select(key, "has_img", F.slice(ids_all, 1, cut_all).alias("input_ids"),
                       F.slice(labels_all, 1, cut_all).alias("labels"))


def image_rows(msgs: DataFrame, convs: DataFrame, family: str, model_max_length: int, legacy: bool = True,
               key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """``(cuts, rows)`` for ``images.image_runs`` from message pieces: rows = (key, n_ids, n_images, n_pads,
    ends_in_pad) of the training examples of ``training_rows``, without their ids.

    An image or pad string of a piece is one id at the piece's token offset; text-only dialogues are cut to
    ``model_max_length``, image dialogues are not.
    """
    from corpusloom.operators.images import cuts_of_events

    name = FAMILIES[family][0]
    cut_pieces = render_pieces if template(name)[4] in ("LLAMA_2", "LLAMA_3") else render_pair_pieces
    summary, ranges, located = mask_from_pieces(cut_pieces(msgs, convs, name, key), convs, family, model_max_length,
                                                legacy, key, with_pieces=True)

    def places(occurrences: Column) -> DataFrame:
        at = (F.lit(1) + F.col("ntok_before") + F.col("o.t")).cast("bigint")
        found = located.select(key, "has_img", "ntok_before", F.explode(occurrences).alias("o"))
        return found.select(key, "has_img", at.alias("at")).filter(F.col("has_img") | (F.col("at") < F.lit(model_max_length)))

    marked, pads = places(_occurrences(F.col("piece"), F.lit(""), K.IMAGE_TOKEN)), places(F.col("_pad"))
    n_images = marked.groupBy(key).agg(F.count(F.lit(1)).alias("n_images"))
    n_pads = pads.groupBy(key).agg(F.count(F.lit(1)).alias("n_pads"), F.max("at").alias("_last"))
    rows = summary.select(key, F.col("n_tokens").alias("n_ids")).join(n_images, key, "left").join(n_pads, key, "left").select(
        key, "n_ids", F.coalesce("n_images", F.lit(0)).cast("bigint").alias("n_images"),
        F.coalesce("n_pads", F.lit(0)).cast("bigint").alias("n_pads"),
        F.coalesce(F.col("_last") == F.col("n_ids") - 1, F.lit(False)).alias("ends_in_pad"))
    return cuts_of_events(key, rows.select(key), ranges.select(key, "lo", "hi"), marked.select(key, "at"), pads.select(key, "at")), rows


def render_pair_pieces(msgs: DataFrame, convs: DataFrame, name: str, key: str = "conv_id") -> DataFrame:
    """(key, pos, g, piece, has_img): one piece per message pair (user piece + answer piece), the head
    folded into pair 0; a conversation without messages is its head alone.

    The two messages of a pair meet on (key, pair): at most one row per side.
    """
    pieces = render_pieces(msgs, convs, name, key)
    heads = pieces.filter(F.col("pos") == -1).select(key, F.col("piece").alias("_head"), "has_img")
    body = pieces.filter(F.col("pos") >= 0).withColumn("_pair", F.floor(F.col("pos") / 2).cast("bigint"))
    users = body.filter(F.col("pos") % 2 == 0).select(key, "_pair", "g", F.col("piece").alias("_u"), "has_img")
    answers = body.filter(F.col("pos") % 2 == 1).select(key, "_pair", F.col("piece").alias("_a"))
    pairs = users.join(answers, [key, "_pair"], "left").select(
        key, F.col("_pair").alias("pos"), "g", F.concat("_u", F.coalesce("_a", F.lit(""))).alias("piece"), "has_img")
    first = pairs.filter(F.col("pos") == 0).join(heads.drop("has_img"), key).withColumn(
        "piece", F.concat("_head", "piece")).drop("_head")
    lone = heads.join(pairs.filter(F.col("pos") == 0).select(key), key, "left_anti").select(
        key, F.lit(0).cast("bigint").alias("pos"), F.lit(-1).cast("bigint").alias("g"), F.col("_head").alias("piece"),
        "has_img")
    return first.unionByName(pairs.filter(F.col("pos") > 0)).unionByName(lone)


def mask_messages(msgs: DataFrame, convs: DataFrame, family: str, model_max_length: int, legacy: bool = True,
                  key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Label masks of ``family`` from message rows: message pieces for llama-2/3, pair pieces otherwise."""
    name = FAMILIES[family][0]
    style = template(name)[4]
    cut = render_pieces if style in ("LLAMA_2", "LLAMA_3") else render_pair_pieces
    return mask_from_pieces(cut(msgs, convs, name, key), convs, family, model_max_length, legacy, key)


# ---------------------------------------------------------------------------
# chat history trimming (H1) at pair level
# ---------------------------------------------------------------------------

def trim_history_messages(msgs: DataFrame, convs: DataFrame, budget: int = K.CHAT_TOKEN_BUDGET,
                          key: str = "conv_id") -> DataFrame:
    """H1 on message rows: the output of ``chat.trim_history(chat.chat_history(records))``.

    Per pair: its token length as the first kept pair and as a middle pair.
    One scan in descending pair order gives, for every start pair k, the
    middle lengths after it and the last pair's length; the first k that fits
    is a partial aggregate.  Only the kept pairs (at most ``budget`` tokens,
    or the last pair alone) are gathered to render the prompt.
    """
    from corpusloom.operators import chat

    pair = F.floor(F.col("pos") / 2).cast("bigint").alias("pair_no")
    n_pairs = F.ceil(F.col("n_msgs") / 2).cast("bigint").alias("_n")
    users = msgs.filter(F.col("pos") % 2 == 0).select(key, pair, F.col("value").alias("u"), "g", "_b", n_pairs)
    answers = msgs.filter(F.col("pos") % 2 == 1).select(key, pair, F.col("value").alias("a"))
    p = users.join(answers, [key, "pair_no"], "left")
    p = spread_back(p, key, "_b", convs.select(key, chat.default_system(F.col("system")).alias("system")))
    last = F.col("pair_no") == F.col("_n") - 1
    p = p.withColumn("a", F.when(last, F.lit("")).otherwise(F.coalesce("a", F.lit(""))))  # the turn to generate
    sysb = chat._sys_block(F.col("system"))
    close = F.lit(K.CHAT_INST_CLOSE)
    first_len = n_tokens(F.concat(sysb, F.col("u"), close, chat._resp(F.col("a")), F.lit(K.EOS_TOKEN)))
    mid_len = n_tokens(F.concat(F.lit(K.BOS_TOKEN + K.CHAT_INST_OPEN), F.col("u"), close, chat._resp(F.col("a")),
                                F.lit(K.EOS_TOKEN)))
    last_len = n_tokens(F.concat(F.lit(K.BOS_TOKEN + K.CHAT_INST_OPEN), F.col("u"), close))
    single_len = n_tokens(F.concat(sysb, F.col("u"), close))
    p = (p.withColumn("_mid", F.when(last, F.lit(0)).otherwise(mid_len))
         .withColumn("_lastlen", F.when(last, last_len).otherwise(F.lit(0)))
         .withColumn("_rev", -F.col("g")))
    # descending order: "before" = the pairs after this one (the last pair comes first)
    p = segmented_scan(p, key, "_rev", ["_mid", "_lastlen"])
    total = F.lit(1) + F.when(last, single_len).otherwise(first_len + F.col("_mid_before") + F.col("_lastlen_before"))
    p = p.withColumn("_t", total.cast("bigint")).withColumn("_fits", (F.col("_t") <= F.lit(budget)) | last)
    # the scanned pairs feed the pick and the kept pairs: written once
    checkpoint_root(p.sparkSession)
    p = p.select(key, "_b", "pair_no", "u", "a", "system", "_n", "_t", "_fits").checkpoint(eager=True)
    pick = p.groupBy(key).agg(F.min(F.when(F.col("_fits"), F.struct(F.col("pair_no").alias("k"), F.col("_t").alias("t"))))
                              .alias("_pick"))
    kept = spread_back(p.select(key, "_b", "pair_no", "u", "a", "system", "_n"), key, "_b", pick) \
        .filter(F.col("pair_no") >= F.col("_pick.k"))
    # at most `budget` tokens of pairs per chat (or its last pair alone)
    grouped = kept.groupBy(key, "system", "_n", "_pick").agg(
        F.array_sort(F.collect_list(F.struct("pair_no", "u", "a"))).alias("_kept"))
    pairs = F.transform("_kept", lambda x: F.struct(x["u"].alias("u"), x["a"].alias("a")))
    return grouped.select(
        key,
        F.col("_pick.k").cast("bigint").alias("start_pair"),
        (F.col("_n") - F.col("_pick.k")).cast("bigint").alias("n_pairs"),
        F.col("_pick.t").cast("bigint").alias("n_tokens"),
        chat.multi_turn_prompt(pairs, F.col("system")).alias("prompt"),
    )


def chat_prompt_pieces(msgs: DataFrame, convs: DataFrame, key: str = "conv_id") -> DataFrame:
    """C13 as pair pieces (key, pair_no, piece): in pair order they concatenate to ``chat.multi_turn_prompt``
    of ``chat.chat_history`` (the last answer is the turn to generate).

    A piece depends on its pair, the pair count (carried by every message row)
    and, for the first pair only, the system text (one row per chat on each side).
    """
    from corpusloom.operators import chat

    pair = F.floor(F.col("pos") / 2).cast("bigint").alias("pair_no")
    n_pairs = F.ceil(F.col("n_msgs") / 2).cast("bigint").alias("_n")
    users = msgs.filter(F.col("pos") % 2 == 0).select(key, pair, F.col("value").alias("u"), n_pairs)
    answers = msgs.filter(F.col("pos") % 2 == 1).select(key, pair, F.col("value").alias("a"))
    p = users.join(answers, [key, "pair_no"], "left")
    first = p.filter(F.col("pair_no") == 0).join(
        convs.select(key, chat.default_system(F.col("system")).alias("system")), key)
    p = first.unionByName(p.filter(F.col("pair_no") > 0).withColumn("system", F.lit(None).cast("string")))
    last = F.col("pair_no") == F.col("_n") - 1
    u, a, system = F.col("u"), F.when(last, F.lit("")).otherwise(F.coalesce("a", F.lit(""))), F.col("system")
    bos, eos = F.lit(K.BOS_TOKEN), F.lit(K.EOS_TOKEN)
    piece = (F.when(F.col("_n") == 1, chat.single_turn_prompt(u, system))
             .when(F.col("pair_no") == 0, F.concat(chat.single_turn_prompt(u, system, a), eos))
             .when(~last, F.concat(bos, chat.single_turn_prompt(u, None, a), eos))
             .otherwise(F.concat(bos, chat.single_turn_prompt(u, None))))
    return p.select(key, "pair_no", piece.alias("piece"))
