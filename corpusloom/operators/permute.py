"""A keyed permutation of [0, n) by arithmetic: a row's place follows from its index alone, nothing is sorted by a hash.

The index is a pair (left, right) of a grid of ``a * b`` cells, ``a = floor(sqrt(n)) + 1`` and ``b = ceil(n / a)``, so
fewer than ``a`` cells lie beyond n.  Rounds in turn add a keyed hash of one half to the other, modulo that half's
size: each is one-to-one, whatever the hash, and so are all together (an unbalanced Feistel network).  A place beyond n
goes through the rounds again until it lies below n (cycle walking), which is one-to-one on [0, n) too.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 4
# A walk visits only cells beyond n before it ends: at most ``a`` of them, below 64 while n < 4,096.  Above that a step
# stays beyond n with a probability under 1/64, and a walk that is not over after 64 steps raises.
WALK = 64


def round_keys(seed: int) -> list[str]:
    return [hashlib.md5(f"{seed}:{r}".encode()).hexdigest()[:8] for r in range(ROUNDS)]


def _hash(key: str, half: Column) -> Column:
    """32 bits of md5 (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(key), half.cast("string"))), 1, 8), 16, 10).cast("bigint")


def _once(x: Column, a: Column, b: Column, keys: list[str]) -> Column:
    right = F.pmod(x, b)
    left = F.round((x - right) / b).cast("bigint")
    for r, key in enumerate(keys):
        if r % 2 == 0:
            left = F.pmod(left + _hash(key, right), a)
        else:
            right = F.pmod(right + _hash(key, left), b)
    return left * b + right


def with_place(rows: DataFrame, idx: Column, n: Column, out: str, seed: int = 0) -> DataFrame:
    """Add ``out``: the place of index ``idx`` (0 .. n - 1) in the permutation of [0, n) that ``seed`` names.

    A null index or count has a null place.  Every round is a projection of its own, so that each hash is taken once;
    only the few places beyond n go into the walk.
    """
    a, b, left, right = (F.col(c) for c in ("_a", "_b", "_l", "_r"))
    keys, kept = round_keys(seed), rows.columns
    rows = rows.withColumns({"_n": n.cast("bigint"), "_i": idx.cast("bigint")})
    rows = rows.withColumn("_a", F.floor(F.sqrt(F.col("_n").cast("double"))).cast("bigint") + 1)
    rows = rows.withColumn("_b", F.expr("(_n + _a - 1) div _a"))
    rows = rows.withColumns({"_l": F.expr("_i div _b"), "_r": F.pmod("_i", b)})
    for r, key in enumerate(keys):
        rows = rows.withColumn(*(("_l", F.pmod(left + _hash(key, right), a)) if r % 2 == 0 else
                                 ("_r", F.pmod(right + _hash(key, left), b))))
    rows = rows.withColumn("_x", left * b + right)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_x"),
                         lambda x, _: F.when(x < F.col("_n"), x).otherwise(_once(x, a, b, keys)))
    rows = rows.withColumn("_x", F.when(F.col("_x") >= F.col("_n"), walked).otherwise(F.col("_x")))
    at = F.when(F.col("_x") >= F.col("_n"), F.raise_error(F.lit("a cycle walk did not end")).cast("bigint")).otherwise(F.col("_x"))
    return rows.select(*kept, at.alias(out))


def place_sql(src: str, idx: str, n: str, seed: int = 0) -> str:
    """SELECT of ``src`` (columns ``idx`` and ``n`` among its own) with ``place``: the same rounds in SQL."""
    step = f"SELECT *, x // b AS l, x % b AS r FROM (SELECT * FROM walk WHERE x >= {n} OR fresh)"
    for i, key in enumerate(round_keys(seed)):
        half, other, size = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        mixed = f"({half} + ('0x' || substr(md5('{key}' || CAST({other} AS VARCHAR)), 1, 8))::BIGINT) % {size}"
        step = f"SELECT * REPLACE ({mixed} AS {half}) FROM ({step})"
    return f"""WITH RECURSIVE walk AS (
  SELECT s.*, {idx}::BIGINT AS x, true AS fresh, floor(sqrt({n}::DOUBLE))::BIGINT + 1 AS a,
         ({n} + floor(sqrt({n}::DOUBLE))::BIGINT) // (floor(sqrt({n}::DOUBLE))::BIGINT + 1) AS b FROM {src} s
  UNION ALL
  SELECT * EXCLUDE (l, r) REPLACE (l * b + r AS x, false AS fresh) FROM ({step}))
SELECT * EXCLUDE (x, fresh, a, b), x AS place FROM walk WHERE NOT fresh AND x < {n}"""
