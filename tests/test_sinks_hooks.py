import os
import warnings

from pyspark.sql import functions as F

from corpusloom.operators import metrics, packing, tokenize, vocab
from corpusloom.sources import files


def test_block_size_clamp():
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert packing.clamp_block_size(4096, 2048) == 2048
        assert w
    assert packing.clamp_block_size(512, 2048) == 512


def test_metrics_sink_appends(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "metrics")
    base = spark.createDataFrame([(3, 0.5)], "n long, loss double")
    rows = metrics.metric_rows([("eval", "eval_samples", F.col("n")), ("eval", "eval_loss", F.col("loss"))], base)
    files.write_metrics(rows, path)
    files.write_metrics(rows, path)
    got = spark.read.parquet(path)
    assert got.count() == 4
    assert sorted(r.metric for r in got.distinct().collect()) == ["eval_loss", "eval_samples"]


def test_vocab_merge_sink_and_guard(spark, tmpdir_path):
    base = vocab.specials_frame(spark).unionByName(
        spark.createDataFrame([(3, "a", 1.0), (4, "b", 1.0)], "id int, piece string, score double"))
    ext = vocab.specials_frame(spark).unionByName(
        spark.createDataFrame([(3, "c", 9.0), (4, "a", 8.0), (5, "d", 7.0)], "id int, piece string, score double"))
    merged = vocab.merge_vocab(base, ext)
    assert [(r.id, r.piece, r.score) for r in merged.orderBy("id").collect()][3:] == [
        (3, "a", 1.0), (4, "b", 1.0), (5, "c", 0.0), (6, "d", 0.0)]
    path = os.path.join(tmpdir_path, "vocab")
    vocab.write_vocab(merged, path)
    assert spark.read.parquet(path).count() == 7
    g = vocab.vocab_guard(merged, 8).first()
    assert (g.tokenizer_size, g.ok, g.rows_to_add) == (7, False, 0)
    sp = vocab.register_specials(merged, vocab.sft_specials(None) + vocab.mm_specials("<pad>"))
    assert [r.piece for r in sp.orderBy("id").collect()][-2:] == ["[PAD]", "<image>"]


def test_tokenizer_hook_and_words(spark):
    df = spark.createDataFrame([(1, 0, "a b zz"), (1, 1, "")], "k long, pos long, t string")

    def make():
        table = {"a": 7, "b": 8}
        return lambda s: [1] + [table.get(w, 0) for w in s.split()]

    hooked = {(r.k, r.pos): r.input_ids for r in tokenize.tokenize_with(df, "t", make).collect()}
    assert hooked[(1, 0)] == [1, 7, 8, 0] and hooked[(1, 1)] == [1]
    v = spark.createDataFrame([(3, "a"), (4, "b")], "id int, piece string")
    w = {(r.k, r.pos): r.input_ids for r in tokenize.tokenize_words(df, ["k", "pos"], "t", v).collect()}
    assert w[(1, 0)] == [1, 3, 4, 0] and w[(1, 1)] == [1]
    back = {(r.k, r.pos): r.text for r in tokenize.detokenize_words(
        tokenize.tokenize_words(df, ["k", "pos"], "t", v), ["k", "pos"], "input_ids", v).collect()}
    assert back[(1, 0)] == "a b" and back[(1, 1)] == ""


def test_arrow_byte_tokenizer_matches_expression(spark):
    from corpusloom.functions.tokens import encode_bytes

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["", "abc", "héllo wörld", "日本", None])],
                               "i int, t string")
    a = {r.i: r.input_ids for r in tokenize.tokenize_bytes_arrow(df, "t").collect()}
    b = {r.i: r.x for r in df.select("i", encode_bytes("t").alias("x")).collect()}
    assert a == b


def test_merge_counts_equals_merge_over_the_ranked_extension(spark):
    from corpusloom.operators import vocab

    base = vocab.vocab_from_text(spark.createDataFrame([("a b b c",)], "text string"), "text")
    ext_text = spark.createDataFrame([("d e e f f b a <s> g g",), ("e d h",)], "text string")
    want = vocab.merge_vocab(base, vocab.vocab_from_text(ext_text, "text"))
    got = vocab.merge_counts(base, vocab.word_counts(ext_text, "text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 3 + 3 + 5  # specials, base pieces a b c, new pieces d e f g h


def test_word_lookup_beyond_any_broadcast_makes_no_row_per_word(spark):
    """whatever the vocabulary's size, words meet it once a block; results are those of str.split()."""
    odd = [None, "", "   ", "a  b\tc", "x　y\x1cz\x85", "a " * 300 + "zz", "​w a\n\nb ", "é\xa0é", "</s> a"]
    df = spark.createDataFrame([(i if i else None, 0, t) for i, t in enumerate(odd)], "k long, pos int, t string")
    pieces = ["<unk>", "<s>", "</s>", "a", "b", "c", "x", "y", "z", "é", "​w"]
    v = spark.createDataFrame(list(enumerate(pieces)), "id int, piece string")
    toks = tokenize.tokenize_words(df, ["k", "pos"], "t", v)
    ids = {r.k: r.input_ids for r in toks.collect()}
    number = {p: i for i, p in enumerate(pieces)}
    assert ids == {i if i else None: [1] + [number.get(w, 0) for w in (t or "").split()] for i, t in enumerate(odd)}
    back = {r.k: r.text for r in tokenize.detokenize_words(toks, ["k", "pos"], "input_ids", v).collect()}
    assert back == {i if i else None: " ".join(w for w in (t or "").split() if number.get(w, 0) >= 3) for i, t in enumerate(odd)}
    for how in ({}, {"max_broadcast_rows": 1}):
        plan = tokenize.tokenize_words(df, ["k", "pos"], "t", v, **how)._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "Union" not in plan


def test_word_lookup_merges_rows_of_one_key(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "b a"), (2, "c")], "k long, t string")
    v = spark.createDataFrame([(3, "a"), (4, "b"), (5, "c")], "id int, piece string")
    toks = tokenize.tokenize_words(df, ["k"], "t", v)
    assert {r.k: r.input_ids for r in toks.collect()} == {1: [1, 3, 4, 3, 4, 5], 2: [1, 5]}
    twice = spark.createDataFrame([(1, [1, 3, 4]), (1, [4]), (2, None)], "k long, ids array<int>")
    assert {r.k: r.text for r in tokenize.detokenize_words(twice, ["k"], "ids", v).collect()} == {1: "b a b", 2: ""}


def test_word_counts_shuffle_different_pieces(spark):
    """one row a piece of a slice leaves the task, not one a word."""
    from collections import Counter

    texts = ["a b a\n\na", None, "", " c\x1fa </s>", "b " * 50]
    counts = vocab.word_counts(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert {r.piece: r.cnt for r in counts.collect()} == Counter(w for t in texts for w in (t or "").split() if w != "</s>")
    assert "explode" not in counts._jdf.queryExecution().optimizedPlan().toString()


def test_image_files_are_dealt_over_tasks(spark, tmpdir_path):
    """every image file is found; the files are written by more than one task."""
    import glob

    from corpusloom.plans import io
    from corpusloom.session import checkpoint_root

    rows = [(c, t, "user", f"text {c}") for c in range(720) for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    folders = lambda: set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/images-*"))
    before = folders()
    got = {r.conv_id: (r.image, r.found) for r in io.image_manifest_join(spark, tmpdir_path).collect()}
    assert got == {c: (f"images/{c}.jpg", True) if c % 3 == 0 else (None, False) for c in range(720)}
    (folder,) = folders() - before
    files = glob.glob(f"{folder}/image=*/*.txt")
    assert len(files) == 240 and len({f.rsplit("/", 1)[1].split("-")[1] for f in files}) > 1
