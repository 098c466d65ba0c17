"""Byte tokenizer as Spark expressions.

Our reference tokenizer (the real ones are pretrained files that are not
available): id = UTF-8 byte + 3, ids 0/1/2 = <unk>/<s>/</s>, and the added
special strings of ``constants.ADDED_SPECIALS`` are single ids >= 259.

It is additive over concatenation (tokens(a + b) = tokens(a) + tokens(b) when
no special string straddles the cut), which is what the mask arithmetic of the
dialogue formats relies on.  All expressions here are JVM built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import col_or_lit, regex_quote

# Specials recognised inside rendered text, longest first is not needed:
# no special string is a prefix of another.
_SPECIAL_STRINGS = ["<s>", "</s>"] + K.ADDED_SPECIALS
_SPECIAL_PIECE_PATTERN = "|".join(regex_quote(s) for s in _SPECIAL_STRINGS) + r"|[^<\[]+|[<\[]"


def byte_ids(c) -> Column:
    """ARRAY<INT>: one id per UTF-8 byte (no specials, no BOS)."""
    hexed = F.hex(F.encode(col_or_lit(c), "UTF-8"))
    return F.transform(
        F.regexp_extract_all(hexed, F.lit(".."), 0),
        lambda h: F.conv(h, 16, 10).cast("int") + F.lit(K.BYTE_OFFSET),
    )


def encode_bytes(c, bos: bool = True) -> Column:
    """Plain text to ids; ``bos`` = the tokenizer's default special-token call."""
    ids = byte_ids(c)
    return F.concat(F.array(F.lit(K.BOS_ID)), ids) if bos else ids


def encode_with_specials(c, bos: bool = True) -> Column:
    """Rendered text to ids; special strings inside the text become one id."""
    pieces = F.regexp_extract_all(col_or_lit(c), F.lit(_SPECIAL_PIECE_PATTERN), 0)

    def piece_ids(p):
        expr = None
        for s in _SPECIAL_STRINGS:
            cond = p == F.lit(s)
            val = F.array(F.lit(K.SPECIAL_IDS[s]))
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        return expr.otherwise(byte_ids(p))

    ids = F.flatten(F.transform(pieces, piece_ids))
    return F.concat(F.array(F.lit(K.BOS_ID)), ids) if bos else ids


def n_tokens(c, bos: bool = False) -> Column:
    """Length of ``encode_with_specials`` computed arithmetically (no array)."""
    c = col_or_lit(c)
    n = F.octet_length(c)
    for s in _SPECIAL_STRINGS:
        width = len(s.encode("utf-8"))
        occ = (F.octet_length(c) - F.octet_length(F.replace(c, F.lit(s), F.lit("")))) / F.lit(width)
        n = n - occ.cast("int") * F.lit(width - 1)
    n = n.cast("bigint")
    return n + F.lit(1) if bos else n


def decode_bytes(ids) -> Column:
    """ids -> text, skipping special ids (``skip_special_tokens=True``)."""
    ids = col_or_lit(ids)
    kept = F.filter(ids, lambda x: (x >= F.lit(K.BYTE_OFFSET)) & (x < F.lit(K.BYTE_OFFSET + 256)))
    hexed = F.concat_ws("", F.transform(kept, lambda x: F.lpad(F.hex(x - F.lit(K.BYTE_OFFSET)), 2, "0")))
    return F.decode(F.unhex(hexed), "UTF-8")


def ids_to_string(ids) -> Column:
    """ARRAY<INT> -> '1,2,3' (the form the SQL oracle compares)."""
    return F.array_join(col_or_lit(ids).cast("array<string>"), ",")
