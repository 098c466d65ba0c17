from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import tokens as T
from corpusloom.functions.text import py_strip, rfind_slice, substring_after_last, text_lines, words


def test_specials_are_single_ids(spark):
    df = spark.createDataFrame([("hé<s>x</s>[PAD]<image>a<b",)], "t string")
    r = df.select(T.encode_with_specials("t").alias("a"), T.n_tokens("t", True).alias("n")).first()
    exp = [1] + [b + 3 for b in "hé".encode()] + [1, ord("x") + 3, 2, K.SFT_PAD_ID, K.IMAGE_TOKEN_ID,
                                                   ord("a") + 3, ord("<") + 3, ord("b") + 3]
    assert r.a == exp
    assert r.n == len(exp)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=30))
def test_decode_encode_roundtrip(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts) if "\x00" not in t]
    if not rows:
        return
    df = spark.createDataFrame(rows, "i int, t string")
    out = df.select("i", "t", T.decode_bytes(T.encode_bytes("t")).alias("d"),
                    F.size(T.encode_bytes("t", bos=False)).alias("n")).collect()
    for r in out:
        assert r.d == r.t
        assert r.n == len(r.t.encode("utf-8"))


def test_python_string_rules(spark):
    cases = ["  a b \n", "x", "", "\tmid dle\n\n", "a\nb\n"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    out = df.select("s", py_strip("s").alias("st"), words("s").alias("w"), text_lines("s").alias("l"),
                    substring_after_last("s", "[/INST]").alias("after"),
                    rfind_slice("s", "ASSISTANT: ").alias("rf")).collect()
    for r in out:
        assert r.st == r.s.strip()
        assert r.w == r.s.split()
        assert r.l == (r.s.splitlines() if r.s.splitlines() else [""])
        assert r.after == r.s.split("[/INST]")[-1]
        assert r.rf == r.s[r.s.rfind("ASSISTANT: ") + len("ASSISTANT: "):]


def test_answer_markers(spark):
    outs = ["[INST] q [/INST] the answer ", "no marker here", "a [/INST] b [/INST]  c"]
    df = spark.createDataFrame([(o,) for o in outs], "o string")
    got = [r[0] for r in df.select(py_strip(substring_after_last("o", "[/INST]"))).collect()]
    assert got == [o.split("[/INST]")[-1].strip() for o in outs]
