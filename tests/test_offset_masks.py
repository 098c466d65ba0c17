"""Masks by character offsets, and word lookup under skew."""

import random

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import offset_masks, tokenize, turns


def test_interval_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(offset_masks, "SPAN", 8)
    rng = random.Random(1)
    tokens, ranges = [], []
    for k in range(5):
        tokens += [(k, i, rng.randint(0, 120)) for i in range(60)]
        at = 0
        while at < 110:
            lo = at + rng.randint(0, 12)
            at = lo + rng.choice([0, 1, 5, 40])
            ranges.append((k, lo, at))
    t = spark.createDataFrame(tokens + [(9, 0, 3)], "conv_id long, i int, start long")
    r = spark.createDataFrame(ranges, "conv_id long, lo long, hi long")
    got = {(x.conv_id, x.i): x.supervised for x in offset_masks.in_ranges(t, r).collect()}
    assert got == {(k, i): any(k == q and lo <= s < hi for q, lo, hi in ranges) for k, i, s in tokens + [(9, 0, 3)]}


def _pieces(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, g long, pos long, piece string, has_img boolean")


def test_tokens_cover_what_they_stand_for(spark, monkeypatch):
    """A dialogue over many buckets; offsets read off the whole prompt, white space and specials among them."""
    monkeypatch.setattr(turns, "BUCKET_ROWS", 3)
    rng = random.Random(2)
    texts = [rng.choice(["<s>[INST] a  b\n [/INST]", " é中 c<d <image>", " x</s>", "", "<s> <", " tab\there 🙂 "]) for _ in range(40)]
    rows = [(1, i, i, t, True) for i, t in enumerate(texts)] + [(2, 100, 0, "<s>one two", False)]
    got = sorted(offset_masks.token_offsets(_pieces(spark, rows)).collect(), key=lambda r: (r.conv_id, r.tok_no))
    prompt = {1: "".join(texts), 2: "<s>one two"}
    for r in got:
        assert prompt[r.conv_id][r.start : r.stop] == r.token and not r.token.isspace()
    one = [r for r in got if r.conv_id == 1]
    assert [r.tok_no for r in one] == list(range(1, len(one) + 1))
    assert "".join(r.token for r in one) == "".join(prompt[1].split())


def test_a_tokenizer_that_is_not_additive(spark):
    """Pairs of letters, counted from a word's beginning: the tokens of a text are not those of its parts."""
    split = lambda c: F.regexp_extract_all(c, F.lit(r"\s+|\S\S?"), 0)
    pieces = _pieces(spark, [(1, 0, 0, "<s>abc ", False), (1, 1, 1, " xyz", False), (1, 2, 2, " q", False), (1, 3, 3, " rstuv", False)])
    convs = spark.createDataFrame([(1,), (2,)], "conv_id long")
    vocab = spark.createDataFrame([(10, "xy"), (11, "z"), (12, "rs"), (13, "tu"), (14, "v"), (15, "q")], "id int, piece string")
    out = offset_masks.masked_tokens(pieces, convs, F.col("pos") % 2 == 1, vocab, 100, split=split)
    rows = sorted(out.filter("conv_id = 1").collect(), key=lambda r: r.tok_no)
    n = K.IGNORE_INDEX
    assert [r.id for r in rows] == [1, 0, 0, 0, 10, 11, 15, 12, 13, 14]  # BOS, then <s, >a, bc unknown
    assert [r.label for r in rows] == [n, n, n, n, 10, 11, n, 12, 13, 14]
    cut = offset_masks.masked_tokens(pieces, convs, F.col("pos") % 2 == 1, vocab, 5, split=split)
    assert sorted(r.tok_no for r in cut.collect()) == [0, 0, 1, 2, 3, 4]


def test_lookup_without_broadcast_keeps_common_values_out_of_the_shuffle(spark):
    """The broadcast bound at 1 row, one word at half of all: equal rows, and no partition holds the common word."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choice(words) if rng.random() < 0.5 else "hot" for _ in range(40))) for i in range(600)] + [(1000, ""), (1001, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    vocab = spark.createDataFrame([(i + 3, w) for i, w in enumerate(words[::2] + ["hot"])], "id int, piece string")
    want = sorted(map(str, tokenize.tokenize_words(df, ["id"], "text", vocab).collect()))
    assert sorted(map(str, tokenize.tokenize_words(df, ["id"], "text", vocab, max_broadcast_rows=1).collect())) == want
    toks = tokenize.tokenize_words(df, ["id"], "text", vocab, bos=False)
    back = [sorted(map(str, tokenize.detokenize_words(toks, ["id"], "input_ids", vocab, **how).collect())) for how in ({}, {"max_broadcast_rows": 1})]
    assert back[0] == back[1]
    exploded = df.select(F.explode(F.split("text", " ")).alias("piece")).filter("piece <> ''")
    hot = {r.piece for r in tokenize.heavy_hitters(exploded, "piece", 5).collect()}
    assert "hot" in hot and len(hot) == 5
    rest = exploded.join(F.broadcast(tokenize.heavy_hitters(exploded, "piece", 50)), "piece", "left_anti")
    sizes = sorted(rest.repartition(8, "piece").select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"])
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
