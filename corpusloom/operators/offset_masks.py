"""Label masks for tokenizers that are not additive (L2-L4): by character offsets, not by running token lengths.

A token table gives every token the characters it stands for; supervised text is a table of character ranges; labels come
from an interval join of the two.  Nothing assumes that the tokens of a text are those of its parts, so a subword
tokenizer needs no correction per round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import WHITESPACE, regex_quote
from corpusloom.functions.tokens import _SPECIAL_STRINGS
from corpusloom.operators.joins import bounded_broadcast
from corpusloom.operators.turns import segmented_scan

SPAN = 1 << 12  # characters of a dialogue that meet on one join key

#: Special strings, white space (kept for the offsets, no token), words without "<", a lone "<".
WORD_SPLIT = "|".join(regex_quote(s) for s in _SPECIAL_STRINGS) + f"|[{WHITESPACE}]+|[^<{WHITESPACE}]+|<"


def split_words(text: Column) -> Column:
    """Consecutive parts that make up the text; parts of white space are no tokens."""
    return F.regexp_extract_all(text, F.lit(WORD_SPLIT), 0)


def is_token(part: Column) -> Column:
    return ~part.rlike(f"^[{WHITESPACE}]")


def token_offsets(pieces: DataFrame, split=split_words, keep=is_token, key: str = "conv_id") -> DataFrame:
    """``(key, g, pos, has_img, tok_no, start, stop, token)``: each token's number in its prompt (from 1; 0 is BOS) and
    the characters it stands for, counted from the prompt's beginning.

    ``pieces`` = (key, g, pos, piece, has_img), one per message, ``g`` a position unique over all pieces.  ``split``
    gives the consecutive parts of a text, ``keep`` says which of them are tokens; no token may cross the border of two
    pieces (a template's pieces begin and end with special strings or white space).  Lengths and token counts before a
    piece are running sums over pieces, bucket by bucket; the window inside a piece is bounded by the message.
    """
    p = pieces.withColumn("parts", split(F.col("piece"))).withColumns({
        "nchar": F.length("piece").cast("bigint"), "ntok": F.size(F.filter("parts", keep)).cast("bigint")})
    p = segmented_scan(p.select(key, "g", "pos", "has_img", "parts", "nchar", "ntok"), key, "g", ["nchar", "ntok"])
    t = p.select(key, "g", "pos", "has_img", "nchar_before", "ntok_before", F.posexplode("parts").alias("i", "token"))
    before = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({"start": F.col("nchar_before") + F.coalesce(F.sum(F.length("token")).over(before), F.lit(0)),
                       "tok_no": F.col("ntok_before") + 1 + F.coalesce(F.sum(keep(F.col("token")).cast("int")).over(before), F.lit(0))})
    return t.filter(keep(F.col("token"))).select(
        key, "g", "pos", "has_img", F.col("tok_no").cast("bigint").alias("tok_no"), F.col("start").cast("bigint").alias("start"),
        (F.col("start") + F.length("token")).cast("bigint").alias("stop"), "token")


def piece_ranges(pieces: DataFrame, supervised: Column, key: str = "conv_id") -> DataFrame:
    """``(key, lo, hi)``: the characters of the pieces for which ``supervised`` holds, counted in their prompt."""
    p = segmented_scan(pieces.withColumn("nchar", F.length("piece").cast("bigint")), key, "g", ["nchar"])
    return p.filter(supervised & (F.col("nchar") > 0)).select(
        key, F.col("nchar_before").alias("lo"), (F.col("nchar_before") + F.col("nchar")).alias("hi"))


def in_ranges(tokens: DataFrame, ranges: DataFrame, key: str = "conv_id", out: str = "supervised") -> DataFrame:
    """``tokens`` with whether their first character lies in one of the key's ranges [lo, hi), which may not overlap.

    An interval join: a range is listed under every span of ``SPAN`` characters it touches, a token under the one it
    begins in; they meet on (key, span), so neither a long dialogue nor a long range is one join key.
    """
    t = tokens.withColumn("_span", F.floor(F.col("start") / F.lit(SPAN)))
    r = ranges.filter(F.col("hi") > F.col("lo")).select(key, "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / F.lit(SPAN)), F.floor((F.col("hi") - 1) / F.lit(SPAN)))).alias("_span"))
    on = [t[key] == r[key], t["_span"] == r["_span"], t["start"] >= r["lo"], t["start"] < r["hi"]]
    return t.join(r, on, "left").select(*[t[c] for c in tokens.columns], r["lo"].isNotNull().alias(out))


def masked_tokens(pieces: DataFrame, convs: DataFrame, supervised: Column, vocab: DataFrame, model_max_length: int,
                  split=split_words, keep=is_token, key: str = "conv_id", unk_id: int = K.UNK_ID) -> DataFrame:
    """``(key, tok_no, start, stop, id, label)``: the training tokens of every dialogue, BOS first (it stands for no
    characters).

    ``vocab(id, piece)`` gives the ids, special strings have their own, unknown tokens ``unk_id``.  A label is the
    token's id if the token begins in a supervised range, else the ignored one.  Text-only dialogues keep their first
    ``model_max_length`` tokens.
    """
    t = token_offsets(pieces, split, keep, key).filter(F.col("has_img") | (F.col("tok_no") < F.lit(model_max_length)))
    t = in_ranges(t, piece_ranges(pieces, supervised, key), key)
    special = F.lit(None).cast("int")
    for s in _SPECIAL_STRINGS:
        special = F.when(F.col("token") == F.lit(s), F.lit(K.SPECIAL_IDS[s])).otherwise(special)
    known = bounded_broadcast(vocab.select(F.col("piece").alias("token"), F.col("id").alias("_id")))
    t = t.join(known, "token", "left").withColumn("id", F.coalesce(special, "_id", F.lit(unk_id)).cast("int"))
    t = t.select(key, "tok_no", "start", "stop", "id",
                 F.when(F.col("supervised"), F.col("id")).otherwise(F.lit(K.IGNORE_INDEX)).alias("label"))
    zero = F.lit(0).cast("bigint")
    return t.unionByName(convs.select(key, zero.alias("tok_no"), zero.alias("start"), zero.alias("stop"),
                                      F.lit(K.BOS_ID).cast("int").alias("id"), F.lit(K.IGNORE_INDEX).alias("label")))
